"""M1-M9: service-interval models on the episodes (Spark ML)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from servicelens.functions.stats import exact_median, grouped_median
from servicelens.operators.survival import TABLE, AftFit, Design, fit_weibull
from servicelens.params import Params
from servicelens.session import cut_lineage, ensure_checkpoint_dir

NUM_COLS = ("km_per_month", "interval_km", "car_age", "gap_km")
CAT_COLS = ("fuel", "drive", "oil_type", "segment")
OLS_NUM = ("log_km_per_month", "log_interval_km", "model_year")
PRED_MIN, PRED_MAX = 10.0, 500.0
#: Episodes that a task of the boosted trees reads in each of the passes, three for a tree.
EPISODES_A_TASK = 50_000


def training_frame(episodes: DataFrame) -> DataFrame:
    """M1: episodes with target and every covariate present."""
    return episodes.dropna(subset=["gap_days", *NUM_COLS, *CAT_COLS])


def _one_hot(cats, drop_first: bool):
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    # treatment coding: alphabetically first level is the reference (dropped);
    # "keep" would add an unknown slot that dropLast removes instead
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="error" if drop_first else "keep",
                         stringOrderType="alphabetDesc" if drop_first else "alphabetAsc") for c in cats]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_oh" for c in cats],
                        dropLast=True, handleInvalid="keep" if not drop_first else "error")
    return idx, ohe


def _feature_names(df: DataFrame, col: str) -> list[str]:
    meta = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    return [names[i] for i in sorted(names)]


def trend_scored(episodes: DataFrame) -> DataFrame:
    """Episodes with a closed-form prediction: exp of the segment's regression of log gap on log km/month.

    Clipped to 10..500 days like the fitted models' medians; SQL can follow it,
    so it checks the tables that are fed by predictions.
    """
    x = F.log("km_per_month")
    fit = episodes.groupBy("segment").agg(F.regr_slope("log_gap_days", x).alias("__slope"),
                                          F.regr_intercept("log_gap_days", x).alias("__icpt"))
    pred = F.exp(F.col("__icpt") + F.col("__slope") * x)
    return (episodes.join(fit, "segment")
            .withColumn("pred_gap_days", F.least(F.greatest(pred, F.lit(PRED_MIN)), F.lit(PRED_MAX)))
            .drop("__slope", "__icpt"))


def independent_columns(frame: DataFrame, vec: str, width: int) -> list[int]:
    """Columns of a design (beside a constant) that no earlier column makes up.

    One aggregate gives the cross products; sweeping them in order leaves what
    each column has beyond those before it.
    """
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    a = frame.select(vector_to_array(vec).alias("a"))
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    got = a.agg(F.count(F.lit(1)), *[F.sum(F.col("a")[i]) for i in range(width)],
                *[F.sum(F.col("a")[i] * F.col("a")[j]) for i, j in pairs]).first()
    n, sums = got[0], np.array([x or 0.0 for x in got[1:1 + width]])
    left = np.zeros((width, width))
    for (i, j), v in zip(pairs, got[1 + width:]):
        left[i, j] = left[j, i] = (v or 0.0) - sums[i] * sums[j] / max(n, 1)
    total = np.diag(left).copy() + sums ** 2 / max(n, 1)
    keep = []
    for j in range(width):
        if left[j, j] > 1e-9 * max(total[j], 1e-300):
            keep.append(j)
            left = left - np.outer(left[:, j], left[j, :]) / left[j, j]
    return keep


def log_ols(episodes: DataFrame, params: Params) -> tuple[DataFrame, DataFrame, dict]:
    """M5: OLS on log(gap_days); normal-equation solver gives p-values, R², adj. R².

    Categoricals are treatment coded against their alphabetically first
    level.  Columns that others make up (aliased) leave the fit and keep a
    NULL coefficient.  Returns (scored episodes, coefficient table, summary dict).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler, VectorSlicer
    from pyspark.ml.regression import LinearRegression

    t = (training_frame(episodes)
         .withColumn("log_km_per_month", F.log("km_per_month"))
         .withColumn("log_interval_km", F.log(F.col("interval_km").cast("double")))
         .withColumn("model_year", F.col("model_year").cast("double"))).persist()
    idx, ohe = _one_hot(CAT_COLS, drop_first=True)
    asm = VectorAssembler(inputCols=[*OLS_NUM, *[f"{c}_oh" for c in CAT_COLS]], outputCol="features")
    design = Pipeline(stages=[*idx, ohe, asm]).fit(t).transform(t)
    names = _feature_names(design, "features")
    keep = independent_columns(design, "features", len(names))
    design = VectorSlicer(inputCol="features", outputCol="kept", indices=keep).transform(design)
    lr = LinearRegression(featuresCol="kept", labelCol="log_gap_days", solver="normal", fitIntercept=True)
    lrm = lr.fit(design)
    s = lrm.summary
    scored = cut_lineage(lrm.transform(design).withColumn("pred_gap_days", F.exp("prediction")).drop("features", "kept"))
    t.unpersist()
    coefs = [float(x) for x in lrm.coefficients] + [float(lrm.intercept)]
    pvals = [float(x) for x in s.pValues] if s.numInstances > len(coefs) else [None] * len(coefs)
    fitted = dict(zip([names[i] for i in keep] + ["const"], zip(coefs, pvals)))
    rows = [(n, c, None if c is None else "shorter interval" if c < 0 else "longer interval", p)
            for n in [*names, "const"] for c, p in [fitted.get(n, (None, None))]]
    spark = episodes.sparkSession
    coef = spark.createDataFrame(rows, "feature string, coef_log_days double, direction string, p_value double") \
                .orderBy(F.asc_nulls_last("p_value"), "feature")
    sigma = (scored.select(F.sqrt(F.sum((F.col("log_gap_days") - F.col("prediction")) ** 2)
                                  / F.lit(float(max(s.numInstances - len(coefs), 1))))).first()[0])
    med = {"a": grouped_median(scored, [], "gap_days", "m").first()[0],
           "p": grouped_median(scored, [], "pred_gap_days", "m").first()[0]}
    summary = {"n_episodes": int(s.numInstances), "r2": float(s.r2), "r2_adj": float(s.r2adj),
               "residual_sigma": float(sigma), "median_actual_gap_days": float(med["a"]),
               "median_predicted_gap_days": float(med["p"]), "method": "log-normal OLS"}
    return scored, coef, summary


def weibull_aft(episodes: DataFrame, params: Params, leak_free: bool = False,
                censored: DataFrame | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """M2-M4, M8: ridge-penalised Weibull accelerated failure time model.

    Default as in the reference: every episode observed and ``gap_km`` (part
    of the outcome) used as a covariate.  ``leak_free`` drops ``gap_km``;
    ``censored`` (see ``episodes.open_intervals``) appends the open interval
    of every asset as a right-censored row.  Predicted median duration
    clipped to 10..500 days; coefficient table with standard errors, z and p;
    R² of log duration on the observed rows.
    """
    num = [c for c in NUM_COLS if not (leak_free and c == "gap_km")]
    t = training_frame(episodes).withColumn("censor", F.lit(1.0))
    if censored is not None:
        cols = ["asset_id", "visit_id", "gap_days", "gap_km", *NUM_COLS[:3], *CAT_COLS]
        t = t.select(*cols, "censor").unionByName(
            training_frame(censored).select(*cols, F.lit(0.0).alias("censor")), allowMissingColumns=True)
    t = t.persist()
    fit = fit_weibull(t, num, CAT_COLS, "gap_days", "censor")
    scored = cut_lineage(t.withColumn("pred_gap_days", F.least(F.greatest(fit.median(), F.lit(PRED_MIN)), F.lit(PRED_MAX))))
    t.unpersist()
    coef = episodes.sparkSession.createDataFrame(fit.table(), TABLE)
    observed = scored.where(F.col("censor") == 1.0)
    r2 = _r2(observed, F.log(F.col("gap_days").cast("double")), F.log("pred_gap_days"))
    return observed, coef, {"method": "Weibull AFT, ridge", "n_episodes": observed.count(), "r2_log_duration": r2, "passes": fit.steps}


#: Coefficients of no fit, by which SQL can follow the medians (M3): (intercept, log rho), numbers, levels.
GIVEN_AFT = ((4.1, 1.2), (("km_per_month", -0.0002), ("interval_km", 0.00005), ("car_age", 0.01), ("gap_km", 0.00001)),
             (("fuel", "Diesel", -0.05), ("segment", "MACHINERY", 0.1)))


def aft_given(episodes: DataFrame) -> DataFrame:
    """M3 on given coefficients: the median of each training episode, clipped as a fit's, by ``AftFit``."""
    import numpy as np

    free, numbers, levels = GIVEN_AFT
    design = Design(tuple(c for c, _ in numbers), tuple((c, v) for c, v, _ in levels))
    values = np.array([*(b for _, b in numbers), *(b for *_, b in levels), *free])
    median = AftFit(design, values, np.zeros_like(values), 0).median()
    return training_frame(episodes).withColumn("pred_gap_days", F.least(F.greatest(median, F.lit(PRED_MIN)), F.lit(PRED_MAX)))


def gbt_interval(episodes: DataFrame, params: Params) -> tuple[DataFrame, DataFrame, dict]:
    """M6-M8: gradient-boosted trees on log(gap_days) with median imputation and one-hot
    categoricals; prediction = exp(model) (not clipped); feature importances."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    t = training_frame(episodes)
    for c in NUM_COLS:
        t = t.withColumn(c, F.col(c).cast("double"))
    # every level of every tree is a pass: as many tasks as the episodes need, and
    # a checkpoint folder, without which each task carries all trees before it
    ensure_checkpoint_dir(t.sparkSession)
    held = t.persist(StorageLevel.MEMORY_AND_DISK)
    t = held.repartition(max(1, -(-held.count() // EPISODES_A_TASK))).persist(StorageLevel.MEMORY_AND_DISK)
    imp = Imputer(inputCols=list(NUM_COLS), outputCols=[f"{c}_imp" for c in NUM_COLS], strategy="median")
    idx, ohe = _one_hot(CAT_COLS, drop_first=False)
    asm = VectorAssembler(inputCols=[*[f"{c}_imp" for c in NUM_COLS], *[f"{c}_oh" for c in CAT_COLS]],
                          outputCol="features")
    gbt = GBTRegressor(featuresCol="features", labelCol="log_gap_days", maxIter=params.gbt_iters, stepSize=0.04,
                       maxDepth=3, seed=params.seed)
    model = Pipeline(stages=[imp, *idx, ohe, asm, gbt]).fit(t)
    scored = model.transform(t).withColumn("pred_gap_days", F.exp("prediction"))
    names = _feature_names(scored, "features")
    scored = cut_lineage(scored.drop("features", *[f"{c}_oh" for c in CAT_COLS]))
    t.unpersist()
    held.unpersist()
    imp_rows = sorted(zip(names, [float(x) for x in model.stages[-1].featureImportances.toArray()]),
                      key=lambda r: -r[1])
    coef = episodes.sparkSession.createDataFrame(imp_rows, "feature string, importance double")
    r2 = _r2(scored, F.col("log_gap_days"), F.log("pred_gap_days"))
    return scored, coef, {"method": "gradient-boosted trees on log duration", "r2_log_duration": r2}


def _r2(df: DataFrame, y, p) -> float:
    """M8: 1 - SSE/SST from one global aggregate (SST = sum y^2 - (sum y)^2 / n)."""
    r = df.agg(F.count(y).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy"),
               F.sum((y - p) ** 2).alias("sse")).first()
    sst = r["syy"] - r["sy"] ** 2 / r["n"] if r["n"] else 0.0
    return float(1.0 - r["sse"] / sst) if sst else float("nan")


def interval_by_segment(episodes: DataFrame, params: Params, scored: bool = False) -> DataFrame:
    """M9: per segment episode count, mean / median gap days and km, mean utilisation
    (+ mean predicted gap when scored).  Medians are exact -- Spark's map-based
    ``median`` for the integral gap columns (bounded domains), the spill-safe
    ``functions.stats.exact_median`` otherwise -- or approximate when
    ``exact_median`` is off."""
    ep = episodes.where(F.col("segment").isNotNull())
    aggs = [F.count("gap_days").alias("n_episodes"), F.avg("gap_days").alias("avg_gap_days"),
            F.avg("gap_km").alias("avg_gap_km"), F.avg("utilization").alias("avg_utilization")]
    if scored:
        aggs.append(F.avg("pred_gap_days").alias("avg_pred_gap_days"))
    g = ep.groupBy("segment").agg(*aggs)
    if params.exact_median:
        med = ep.groupBy("segment").agg(F.median("gap_days").alias("median_gap_days"),
                                        F.median("gap_km").alias("median_gap_km")) \
            if all(isinstance(ep.schema[c].dataType, T.IntegralType) for c in ("gap_days", "gap_km")) else \
            exact_median(ep, ["segment"], "gap_days", "median_gap_days").join(
                exact_median(ep, ["segment"], "gap_km", "median_gap_km"), "segment")
        g = g.join(med, "segment", "left")
    else:
        approx = ep.groupBy("segment").agg(
            F.percentile_approx("gap_days", 0.5, 10000).cast("double").alias("median_gap_days"),
            F.percentile_approx("gap_km", 0.5, 10000).cast("double").alias("median_gap_km"))
        g = g.join(approx, "segment", "left")
    cols = ["segment", "n_episodes", "avg_gap_days", "median_gap_days", "avg_gap_km", "median_gap_km", "avg_utilization"]
    return (g.select(*cols, *(["avg_pred_gap_days"] if scored else []))
            .orderBy("avg_gap_days"))
