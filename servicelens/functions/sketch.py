"""Mergeable quantile sketches: counts by logarithmic buckets, kept as plain rows.

A value x falls into bucket ceil(log_g |x|) of its sign with
g = (1 + a) / (1 - a); the bucket's value 2 g^b / (g + 1) is within a * |x| of
all its members (the bucketing of the DDSketch paper, Masson, Rim and Lee,
2019). Sketches are summed by bucket, so those of any parts give just the
sketch of the whole, in any order, and a stored part can be replaced alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _base(accuracy: float) -> float:
    return (1 + accuracy) / (1 - accuracy)


def sketch(df: DataFrame, keys: Sequence[str], value: str, accuracy: float = 0.01) -> DataFrame:
    """(keys, side, bucket, n) of the non-NULL finite values; side is -1, 0 or 1.

    Keys may be NULL. A key has at most 1,420 / log(g) buckets a side, and
    those of its range in fact: 350 for values from 1 to 1,000 at 0.01.
    """
    x = F.col(value).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    bucket = F.when(x == 0, 0).otherwise(F.ceil(F.log(F.abs(x)) / F.lit(math.log(_base(accuracy))))).cast("int")
    return (df.where(finite).groupBy(*keys, F.signum(x).cast("int").alias("side"), bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of finer keys summed to ``keys``."""
    return sketches.groupBy(*keys, "side", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: Sequence[str], probs: dict[str, float], accuracy: float = 0.01) -> DataFrame:
    """(keys, n, one column a name of ``probs``): quantiles, interpolated as ``percentile`` does.

    Each of the two values that ``percentile`` would interpolate is off by at
    most ``accuracy`` of itself; so is their mean if their signs are equal.
    ``accuracy`` must be that of the sketch. The window of a key runs over its
    buckets, whose number does not grow with the rows.
    """
    g = _base(accuracy)
    value = F.col("side") * F.when(F.col("side") == 0, 0.0).otherwise(F.lit(2.0) * F.pow(F.lit(g), F.col("bucket")) / F.lit(g + 1.0))
    w = Window.partitionBy(*keys)
    order = w.orderBy("side", F.col("side") * F.col("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    runs = sketches.select(*keys, value.alias("__v"), F.sum("n").over(order).alias("__to"), F.sum("n").over(w).alias("__n"))

    def at(pos: Column) -> Column:
        return F.min(F.when(F.col("__to") > pos, F.col("__v")))

    out = []
    for name, q in probs.items():
        h = F.lit(q) * (F.col("__n") - 1)
        part = F.max(h - F.floor(h))
        out.append((at(F.floor(h)) + part * (at(F.ceil(h)) - at(F.floor(h)))).alias(name))
    return runs.groupBy(*keys).agg(F.max("__n").alias("n"), *out)


def store(sketches: DataFrame, folder: str, path: str) -> DataFrame:
    """Write sketches as one folder for each value of the column ``folder`` and read all of them back.

    Folders that are written again are replaced, all others stay: take the
    grain at which data is loaded again (a day, or a month that holds the
    sketches of its days; a folder should hold megabytes).
    """
    spark = sketches.sparkSession
    (sketches.repartition(F.col(folder)).write.partitionBy(folder).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    return spark.read.schema(sketches.schema).parquet(path)
