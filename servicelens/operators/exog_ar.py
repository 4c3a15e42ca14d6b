"""F16: calendar regression with autoregressive errors, for all series at once.

Two stages of least squares. The first regresses weekly visits on a trend and
the calendar flags; the second regresses its residuals on their own lags. Both
need only sums of products by series, which are partly aggregated before the
shuffle; a series' small system is then solved by one array expression, so
nothing is collected and no series is fitted on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicelens.functions.exprs import half_even
from servicelens.operators.demand import METHOD_NAIVE, mape, naive_baseline

EXOG = ("is_year_end", "payday_week", "pre_holiday_4w", "holiday_week")
AR_LAGS = (1, 4)
#: A regressor that earlier ones explain but for this share of its square sum gets the coefficient zero.
LEAST_PIVOT = 1e-9
METHOD_EXOG = "calendar regression with autoregressive errors"


def product_sums(xs: Sequence[Column], y: Column) -> Column:
    """Aggregate: the normal equations, one row [sum(x_i x_1) .. sum(x_i x_k), sum(x_i y)] for each x_i."""
    return F.array(*[F.array(*[F.sum((a * b).cast("double")) for b in (*xs, y)]) for a in xs])


def solved(system: str, k: int) -> Column:
    """Coefficients of the ``k`` normal equations in the array column ``system``.

    Gauss-Jordan elimination without a change of order; dependent regressors
    keep the coefficient zero. NULL where the system is NULL or holds a NULL.
    """
    s = F.col(system)

    def step(m: Column, p: Column) -> Column:
        pivot = m[p][p]
        usable = pivot > F.lit(LEAST_PIVOT) * s[p][p]

        def cell(row: Column, i: Column, v: Column, j: Column) -> Column:
            return (F.when((i == p) & usable, v / pivot).when(i == p, F.lit(0.0))
                    .when(usable, v - row[p] * m[p][j] / pivot).otherwise(v))

        return F.transform(m, lambda row, i: F.transform(row, lambda v, j: cell(row, i, v, j)))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), s, step)
    known = ~F.exists(s, lambda row: F.exists(row, lambda v: v.isNull()))
    return F.when(known, F.transform(done, lambda row: row[k]))


def _dot(coefficients: str, xs: Sequence[Column]) -> Column:
    out = F.col(coefficients)[0] * xs[0]
    for i, x in enumerate(xs[1:], 1):
        out = out + F.col(coefficients)[i] * x
    return out


def exog_ar_fit(split: DataFrame, lags: Sequence[int] = AR_LAGS) -> tuple[DataFrame, DataFrame]:
    """(scored, coefficients) of ``split`` (``demand.time_split``).

    Learns from the training weeks only. ``scored`` has each week's regression
    value ``fit`` and the one-step prediction ``pred`` (from the weeks before
    it, at least 0); coefficients (series, beta, rho) has one row a series
    with training weeks. Regressors: 1, the week's number, ``EXOG``.
    """
    order = Window.partitionBy("series").orderBy("week")
    rows = split.withColumn("t", F.row_number().over(order) - 1)
    xs = [F.lit(1), F.col("t"), *[F.col(c) for c in EXOG]]
    learn = F.col("is_test") == F.lit(False)
    beta = (rows.where(learn).groupBy("series").agg(product_sums(xs, F.col("y")).alias("system"))
            .select("series", solved("system", len(xs)).alias("beta")))
    fitted = rows.join(beta, "series", "left").withColumn("fit", _dot("beta", xs)).withColumn("u", F.col("y") - F.col("fit"))
    for k in lags:
        fitted = fitted.withColumn(f"u_{k}", F.lag("u", k).over(order))
    us = [F.col(f"u_{k}") for k in lags]
    rho = (fitted.where(learn & us[-1].isNotNull()).groupBy("series").agg(product_sums(us, F.col("u")).alias("system"))
           .select("series", solved("system", len(us)).alias("rho")))
    steps = _dot("rho", [F.coalesce(u, F.lit(0.0)) for u in us])
    scored = fitted.join(rho, "series", "left").withColumn("pred", F.greatest(F.col("fit") + F.coalesce(steps, F.lit(0.0)), F.lit(0.0)))
    scored = scored.withColumn("pred", F.when(F.col("fit").isNotNull(), F.col("pred")))
    return scored.drop("beta", "rho", "u", *[f"u_{k}" for k in lags]), beta.join(rho, "series", "left")


def exog_ar_backtest(split: DataFrame, lags: Sequence[int] = AR_LAGS) -> DataFrame:
    """F16: test weeks with the model's prediction beside the baseline's, and the MAPE of both by series."""
    test = exog_ar_fit(split, lags)[0].where("is_test").join(naive_baseline(split), "series", "left")
    own = Window.partitionBy("series")
    return test.select(
        "series", "week", F.col("visits").alias("actual_visits"), F.col("pred").alias("pred_exog_raw"),
        half_even(F.col("pred"), 0).cast("bigint").alias("pred_visits_exog"),
        mape(F.col("y"), F.col("pred")).over(own).alias("mape_exog"),
        mape(F.col("y"), F.col("naive")).over(own).alias("mape_naive"))


def mape_rows(backtest: DataFrame) -> DataFrame:
    """F16: (series, model, test_mape) of the baseline and of the regression."""
    m = backtest.groupBy("series").agg(F.first("mape_naive").alias("naive"), F.first("mape_exog").alias("exog"))
    return m.select("series", F.inline(F.array(
        F.struct(F.lit(METHOD_NAIVE).alias("model"), F.col("naive").alias("test_mape")),
        F.struct(F.lit(METHOD_EXOG).alias("model"), F.col("exog").alias("test_mape")))))
