"""Distributed global ranking (no single-partition window over the data).

``global_row_number`` range-partitions the rows on the sort key (Spark
samples the key, so even a value shared by a third of all rows is split
across partitions by the tie-breaker), sorts within partitions and records
each row's partition id and in-partition position.  That frame is
materialised with a reliable checkpoint so the positions are stable data,
and per-partition counts -- one row per partition, a bound given by the
partition count -- are turned into offsets and broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicelens.session import cut_lineage

HOT_SHARE = 1000
_PID_SHIFT = 33  # monotonically_increasing_id() = (partition id << 33) + position


def _range_sorted(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with their partition and their place in it, checkpointed."""
    from pyspark.storagelevel import StorageLevel

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the range partitioner samples its input before shuffling it: persist so
    # the input is computed once for both passes
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    s = cut_lineage(src.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("__pid", F.spark_partition_id())
                    .withColumn("__mid", F.monotonically_increasing_id()))
    src.unpersist()
    return s


def global_running_sum(df: DataFrame, order: Sequence[str | Column], weight: str, out: str) -> DataFrame:
    """Running sum of an integral column over all rows in ``order``.

    Each range partition sums its own rows; the sums of the partitions before
    it -- one row a partition -- are added.
    """
    s = _range_sorted(df, order)
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (s.groupBy("__pid").agg(F.sum(weight).alias("__n"))
               .select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")))
    own = Window.partitionBy("__pid").orderBy("__mid").rowsBetween(Window.unboundedPreceding, 0)
    return (s.join(F.broadcast(offsets), "__pid")
            .withColumn(out, F.col("__off") + F.sum(weight).over(own))
            .drop("__pid", "__mid", "__off"))


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """1-based position of every row in ``order`` (which must be a total order)."""
    s = _range_sorted(df, order, partitions)
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"))
    pos = F.col("__off") + (F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), _PID_SHIFT)) + 1
    return (s.join(F.broadcast(offsets), "__pid")
            .withColumn(out, pos.cast("bigint"))
            .drop("__pid", "__mid", "__off"))


def average_percent_rank(df: DataFrame, value: str, tiebreak: Sequence[str], out: str) -> DataFrame:
    """pandas ``rank(pct=True)``: average rank of ties / number of non-null values.

    Tied values occupy consecutive positions, so their average rank is
    (first + last position) / 2, taken from a map-side combined aggregate
    per value.  NULL values get a NULL rank.

    The ranks go back to the rows by value.  Values that more than one row in
    ``HOT_SHARE`` has number ``HOT_SHARE`` at most: they are broadcast, and
    their rows and those of NULLs are dealt by the tie-breaker, so no task
    gets all rows of one value.
    """
    nn = df.where(F.col(value).isNotNull())
    ranked = global_row_number(nn.select(value, *tiebreak), [value, *tiebreak], "__rn")
    # the count is the last position (read from the checkpointed ranking, no extra pass)
    n = ranked.select(F.max("__rn")).scalar()
    per_value = ranked.groupBy(F.col(value).alias("__v")).agg(
        ((F.min("__rn") + F.max("__rn")) / 2.0).alias("__avg"), F.count(F.lit(1)).alias("__rows"))
    hot = per_value.where(F.col("__rows") * HOT_SHARE > n).select("__v", F.col("__avg").alias("__hot"))
    cold = per_value.where(F.col("__rows") * HOT_SHARE <= n).select("__v", F.lit(0).alias("__salt"), "__avg")
    rows = df.join(F.broadcast(hot), F.col(value) == F.col("__v"), "left").drop("__v")
    key = F.when(F.col("__hot").isNull(), F.col(value))
    rows = rows.withColumn("__key", key).withColumn(
        "__salt", F.when(key.isNull(), F.pmod(F.xxhash64(*tiebreak), F.lit(HOT_SHARE)) + 1).otherwise(0).cast("int"))
    return (rows.join(cold, (F.col("__key") == F.col("__v")) & (rows["__salt"] == cold["__salt"]), "left")
            .withColumn(out, F.coalesce("__hot", "__avg") / n)
            .select(*df.columns, out))


def ntile(row_number: Column, n: Column, k: int) -> Column:
    """SQL NTILE(k) from a 1-based row number and the row count (first n % k buckets one larger)."""
    q = F.floor(n / k)
    r = n % k
    big = r * (q + 1)
    return F.when(row_number <= big, F.floor((row_number - 1) / (q + 1)) + 1) \
            .otherwise(r + F.floor((row_number - 1 - big) / q) + 1).cast("int")
