"""The corpus pipeline: quality, near-duplicates, benchmark leaks, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``; the last adds
``shard``. Empty tables, NULLs, repeated rows and further columns are handled
as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from servicelens.llm.common import materialise, table
from servicelens.llm.decontaminate import drop_leaks
from servicelens.llm.mixing import MixParams, mixed
from servicelens.llm.quality import keep_good
from servicelens.llm.sharding import ShardParams, with_shard
from servicelens.llm.simhash_dedup import keep_representatives


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects (score under 0.3)."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group within 4 bits of SimHash over 4 words."""
    return keep_representatives(docs, words=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once, those of small sources up to 1.5 times: a row for each time one is drawn."""
    return mixed(docs, MixParams()).drop("__epoch", "__order")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each row."""
    return with_shard(docs, ShardParams())


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
    ("sharding", sharding),
]

#: SQL can express neither the fitted classifier nor XXH64 fingerprints; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
