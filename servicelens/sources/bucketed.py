"""S8 as co-partitioned tables: written once by bucket of a key, joined and grouped by it without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.session import ensure_checkpoint_dir


def write_bucketed(df: DataFrame, key: str, buckets: int = 32, sort: Sequence[str] = (), writers: int = 4,
                   name: str | None = None, path: str | None = None) -> DataFrame:
    """``df`` as a table of ``buckets`` buckets of ``key``, sorted by key and ``sort``, read back.

    ``writers`` tasks share the rows of a bucket, by a hash of the whole row,
    so a key with a third of all rows is written by several and a bucket has
    at most that many files. Rows of equal key are read by one task, as a
    stream: joins and sums by the key do not hold them. A NULL key has a
    bucket like any other. ``buckets`` should be a few times the cores of the
    cluster, and equal for tables that are to be joined.

    Without a name the table gets one of its own, and without a path a folder
    below ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    path = path or f"{ensure_checkpoint_dir(spark)}/{name}"
    writer = F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(writers))
    (df.repartition(buckets * writers, F.pmod(F.hash(key), F.lit(buckets)), writer)
     .write.bucketBy(buckets, key).sortBy(key, *sort).option("path", path).mode("overwrite").format("parquet").saveAsTable(name))
    return spark.table(name)
