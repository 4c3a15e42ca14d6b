"""Weekly demand series, features, backtest and recursive forecast.

A series is keyed by ``series`` (the literal 'ALL' for the global series,
or e.g. the branch).  After the first aggregate every frame holds
#series x #weeks rows -- bounded by the calendar, not by the data -- so the
per-series windows below are cheap; they are partitioned by series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from servicelens.functions.calendar import week_calendar
from servicelens.functions.exprs import MONEY, closing_monday, half_even, money
from servicelens.params import Params
from servicelens.session import cut_lineage

LAGS = (1, 2, 3, 4, 8, 12)
CALENDAR_COLS = ("week_of_year", "month", "is_year_end", "payday_week", "pre_holiday_4w", "holiday_week")
FEATURE_COLS = tuple(f"lag_{k}" for k in LAGS) + ("roll4_mean", "roll8_mean") + CALENDAR_COLS
METHOD_GBT = "gradient-boosted trees + lag features + calendar exog"
METHOD_NAIVE = "naive trailing 4-week mean"
Z95 = 1.96


def _series_key(series_cols: Sequence[str]) -> Column:
    if not series_cols:
        return F.lit("ALL")
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in series_cols])


def weekly_demand(visits: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """F1-F2 (+F17): visits, anchor visits and revenue per closing-Monday week, densified.

    Weeks with no visit between a series' first and last week get zeros: each
    week also stands for the empty weeks up to the next one, so the visits are
    read once.
    """
    v = visits.where(F.col("visit_date").isNotNull()).withColumn("series", _series_key(series_cols))
    g = (v.groupBy("series", closing_monday("visit_date").alias("week"))
         .agg(F.count(F.lit(1)).alias("visits"),
              F.count_if(F.col("has_anchor")).alias("anchor_visits"),
              F.sum(money("visit_revenue")).alias("revenue")))
    after = F.lead("week").over(Window.partitionBy("series").orderBy("week"))
    until = F.coalesce(F.date_sub(after, 7), F.col("week"))
    filled = (g.withColumn("until", until).withColumnRenamed("week", "own")
              .withColumn("week", F.explode(F.sequence("own", "until", F.expr("INTERVAL 7 DAYS")))))
    here = F.col("week") == F.col("own")
    return filled.select("series", "week",
                         F.when(here, F.col("visits")).otherwise(F.lit(0)).alias("visits"),
                         F.when(here, F.col("anchor_visits")).otherwise(F.lit(0)).alias("anchor_visits"),
                         F.coalesce(F.when(here, F.col("revenue")), F.lit(0).cast(MONEY)).alias("revenue"))


def calendar_features(weekly: DataFrame, params: Params) -> DataFrame:
    """ISO week, month, year-end, payday and holiday flags of each week label."""
    feats = week_calendar(F.col("week"), params.holidays, params.legacy_holiday_distance)
    return weekly.select("series", "week", *[c.alias(n) for n, c in feats.items()])


def lag_features(weekly: DataFrame, params: Params) -> DataFrame:
    """Lags, trailing means (NULL until complete), calendar; incomplete rows dropped."""
    w = Window.partitionBy("series").orderBy("week")
    out = weekly
    for k in LAGS:
        out = out.withColumn(f"lag_{k}", F.lag("visits", k).over(w).cast("double"))
    for k in (4, 8):
        frame = w.rowsBetween(-k, -1)
        out = out.withColumn(f"roll{k}_mean", F.when(F.count("visits").over(frame) == k,
                                                     F.avg(F.col("visits").cast("double")).over(frame)))
    feats = week_calendar(F.col("week"), params.holidays, params.legacy_holiday_distance)
    for n, c in feats.items():
        out = out.withColumn(n, c)
    out = out.withColumn("y", F.col("visits").cast("double"))
    return out.dropna(subset=list(FEATURE_COLS))


def time_split(frame: DataFrame) -> DataFrame:
    """F8: the last min(12, max(4, n // 6)) weeks of each series are the test set."""
    n = F.count(F.lit(1)).over(Window.partitionBy("series"))
    test_size = F.least(F.lit(12), F.greatest(F.lit(4), F.floor(n / 6)))
    rk = F.row_number().over(Window.partitionBy("series").orderBy(F.desc("week")))
    return frame.withColumn("is_test", rk <= test_size)


def naive_baseline(split: DataFrame) -> DataFrame:
    """per series, the mean of the last 4 training weeks (NULL with fewer than 4)."""
    tr = split.where(~F.col("is_test"))
    rk = F.row_number().over(Window.partitionBy("series").orderBy(F.desc("week")))
    last4 = tr.withColumn("rk", rk).where(F.col("rk") <= 4)
    return last4.groupBy("series").agg(F.when(F.count(F.lit(1)) == 4, F.avg("y")).alias("naive"))


def mape(y: Column, p: Column) -> Column:
    """mean |y - p| / |y| over non-zero actuals."""
    return F.avg(F.when(y != 0, F.abs(y - p) / F.abs(y)))


def naive_backtest(split: DataFrame) -> DataFrame:
    """F10-F12 for the baseline: test weeks, actual, rounded prediction, MAPE per series."""
    test = split.where(F.col("is_test")).join(naive_baseline(split), "series", "left")
    m = test.groupBy("series").agg(mape(F.col("y"), F.col("naive")).alias("mape_naive"))
    return (test.join(m, "series", "left")
            .select("series", "week", F.col("visits").alias("actual_visits"),
                    half_even(F.col("naive"), 0).cast("bigint").alias("pred_visits_naive"), "mape_naive"))


def _assembler():
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(FEATURE_COLS), outputCol="features")


def fit_gbt(train: DataFrame, params: Params):
    """gradient-boosted trees on the feature frame (squared loss)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor

    gbt = GBTRegressor(featuresCol="features", labelCol="y", maxIter=params.gbt_iters, stepSize=0.04,
                       maxDepth=3, seed=params.seed, lossType="squared")
    held = train.persist(StorageLevel.MEMORY_AND_DISK)
    model = Pipeline(stages=[_assembler(), gbt]).fit(held)
    held.unpersist()
    return model


def gbt_backtest(split: DataFrame, params: Params) -> DataFrame:
    """GBT fitted on the training weeks, scored on the test weeks, next to the baseline."""
    split = split.persist()
    model = fit_gbt(split.where(~F.col("is_test")), params)
    test = model.transform(split.where(F.col("is_test"))).withColumn("pred", F.greatest(F.col("prediction"), F.lit(0.0)))
    test = test.join(naive_baseline(split), "series", "left")
    m = test.groupBy("series").agg(mape(F.col("y"), F.col("pred")).alias("mape_model"),
                                   mape(F.col("y"), F.col("naive")).alias("mape_naive"),
                                   F.stddev_samp(F.col("y") - F.col("pred")).alias("residual_sd"))
    return (test.join(m, "series", "left")
            .select("series", "week", F.col("visits").alias("actual_visits"), F.col("pred").alias("pred_model_raw"),
                    half_even(F.col("pred"), 0).cast("bigint").alias("pred_visits_model"),
                    half_even(F.col("naive"), 0).cast("bigint").alias("pred_visits_naive"),
                    F.lit(METHOD_GBT).alias("method"), "mape_model", "mape_naive", "residual_sd"))


def backtest_by_model(backtest: DataFrame) -> DataFrame:
    """F16: one MAPE row per model and series."""
    m = backtest.groupBy("series").agg(F.first("mape_naive").alias("naive"), F.first("mape_model").alias("model"))
    return m.select("series", F.inline(F.array(
        F.struct(F.lit(METHOD_NAIVE).alias("model"), F.col("naive").alias("test_mape")),
        F.struct(F.lit(METHOD_GBT).alias("model"), F.col("model").alias("test_mape")))))


def recursive_forecast(weekly: DataFrame, params: Params, model=None) -> DataFrame:
    """``horizon_weeks`` steps, each prediction fed back into the lags.

    State per series is its visit history as an array (bounded by the
    calendar), so every step is one narrow transform over #series rows for
    all series at once; nothing is collected.  ``model`` is a fitted
    pipeline on ``FEATURE_COLS`` (F9); None uses the naive trailing mean.
    A series shorter than a lag uses its mean for that lag.
    """
    hist = (weekly.groupBy("series")
            .agg(F.array_sort(F.collect_list(F.struct("week", F.col("visits").cast("double").alias("v")))).alias("h"),
                 F.max("week").alias("last_week"),
                 F.sum("visits").alias("tv"), F.sum("anchor_visits").alias("ta"), F.sum("revenue").alias("tr"))
            .select("series", F.transform("h", lambda s: s["v"]).alias("h"), "last_week", "tv", "ta", "tr"))
    if model is None:
        state = _naive_recursion(hist, params.horizon_weeks)
    else:
        state = _model_recursion(hist, params, model)
    return translated(state.select("series", "tv", "ta", "tr", F.inline("preds")), METHOD_NAIVE if model is None else METHOD_GBT)


def translated(out: DataFrame, method: str, *more: str) -> DataFrame:
    """forecast visits, anchor visits and revenue of ``pred`` from the series' totals (tv, ta, tr)."""
    fv = half_even(F.col("pred"), 0).cast("bigint")
    tv = F.greatest(F.col("tv").cast("double"), F.lit(1.0))
    anchor_rate = F.col("ta").cast("double") / tv
    aov = F.col("tr").cast("double") / tv
    return out.select(
        "series", "week", F.col("pred").alias("forecast_mean"), fv.alias("forecast_visits"),
        half_even(fv * anchor_rate, 0).cast("bigint").alias("forecast_anchor_visits"),
        half_even(fv * aov, 0).cast("bigint").alias("forecast_revenue"),
        F.lit(method).alias("method"), *more,
    )


def _tail_mean(arr: Column, k: int) -> Column:
    tail = F.slice(arr, -F.least(F.size(arr), F.lit(k)), k)
    return F.aggregate(tail, F.lit(0.0), lambda a, x: a + x) / F.size(tail)


def _naive_recursion(hist: DataFrame, horizon: int) -> DataFrame:
    """Baseline recursion as ONE array expression: fold ``horizon`` steps over the history."""
    grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("h"),
                        lambda acc, i: F.concat(acc, F.array(F.greatest(_tail_mean(acc, 4), F.lit(0.0)))))
    preds = F.slice(grown, F.size("h") + 1, horizon)
    weeks = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda i: F.date_add(F.col("last_week"), i * 7))
    return hist.select("series", "tv", "ta", "tr",
                       F.arrays_zip(weeks.alias("week"), preds.alias("pred")).alias("preds"))


def _model_recursion(hist: DataFrame, params: Params, model) -> DataFrame:
    """Fitted-model recursion: one ``model.transform`` per step over #series rows.

    Each step reads the previous step's array several times; the state (one
    row per series) is checkpointed between steps so that the optimizer sees it as a leaf instead
    of inlining all steps into one exponentially growing expression.
    """
    state = hist.withColumn("preds", F.array().cast("array<struct<week:date,pred:double>>"))
    for step in range(1, params.horizon_weeks + 1):
        wk = F.date_add(F.col("last_week"), 7 * step)
        mean_h = F.aggregate("h", F.lit(0.0), lambda a, x: a + x) / F.size("h")
        feats = {}
        for k in LAGS:
            feats[f"lag_{k}"] = F.when(F.size("h") >= k, F.element_at("h", -k)).otherwise(mean_h)
        for k in (4, 8):
            feats[f"roll{k}_mean"] = _tail_mean(F.col("h"), k)
        for n, c in week_calendar(wk, params.holidays, params.legacy_holiday_distance).items():
            feats[n] = c
        cur = model.transform(state.select("*", *[c.alias(n) for n, c in feats.items()]))
        cur = cur.withColumn("p", F.greatest(F.col("prediction"), F.lit(0.0)))
        state = cur.select("series", F.concat("h", F.array("p")).alias("h"), "last_week", "tv", "ta", "tr",
                           F.concat("preds", F.array(F.struct(wk.alias("week"), F.col("p").alias("pred")))).alias("preds"))
        state = cut_lineage(state)
    return state


def prediction_interval(forecast: DataFrame, backtest: DataFrame) -> DataFrame:
    """point +/- 1.96 x the backtest residual standard deviation of the series."""
    sd = backtest.groupBy("series").agg(F.first("residual_sd").alias("sd"))
    f = forecast.join(sd, "series", "left")
    return f.select("*", (F.col("forecast_mean") - F.lit(Z95) * F.col("sd")).alias("lower_95"),
                    (F.col("forecast_mean") + F.lit(Z95) * F.col("sd")).alias("upper_95")).drop("sd")
