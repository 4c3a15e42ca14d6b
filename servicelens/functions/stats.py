"""Exact grouped medians that stay spill-safe for high-cardinality values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.functions.ranking import global_running_sum


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Per-group median with linear interpolation (= ``percentile(value, 0.5)``).

    ``percentile`` keeps a value->count map per group in memory.  Here the
    rows are first reduced to (group, value, count) -- map-side combined, so
    a hot group costs one row per distinct value -- which are range
    partitioned by (group, value): a group with most of the values is spread
    over many tasks.  Running counts over all of them, less where the group
    begins, give the middle value(s).
    """
    keys = list(keys)
    c = (df.where(F.col(value).isNotNull())
         .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")))
    c = global_running_sum(c, [*keys, value], "__n", "__cum")
    tot = c.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.sum("__n").alias("__tot"), F.max("__cum").alias("__end"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    c = c.join(tot if keys else F.broadcast(tot), same)  # without keys: one row
    at = F.col("__cum") - F.col("__end") + F.col("__tot")
    lo = F.floor((F.col("__tot") + 1) / 2)      # 1-based lower middle position
    hi = F.floor(F.col("__tot") / 2) + 1        # 1-based upper middle position
    g = c.groupBy(*keys).agg(F.min(F.when(at >= lo, F.col(value))).alias("__lo"),
                             F.min(F.when(at >= hi, F.col(value))).alias("__hi"))
    lo_v, hi_v = F.col("__lo").cast("double"), F.col("__hi").cast("double")
    return g.select(*keys, (lo_v + (hi_v - lo_v) * F.lit(0.5)).alias(out))


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact median per group, choosing the plan by the column's domain.

    Integral columns (day gaps, km readings) have a physically bounded
    number of distinct values, so Spark's ``median`` (a value->count map per
    group, map-side combined) is memory-bounded and cheapest; other columns
    (e.g. model predictions, one distinct value per row) use
    ``exact_median``, which sorts and spills instead of holding the map.
    """
    from pyspark.sql import types as T

    if isinstance(df.schema[value].dataType, T.IntegralType):
        if keys:
            return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.median(value).alias(out))
        return df.agg(F.median(value).alias(out))
    return exact_median(df, keys, value, out)
