"""Input columns named like the operators' own, and sums over many partitions."""

import numpy as np
from llm_cases import prose
from pyspark.sql import functions as F

from servicelens.llm.common import block_rows, free_names, joined_blocks, summed_blocks
from servicelens.llm.mixing import MixParams, mixed
from servicelens.llm.sharding import with_shard
from servicelens.llm.simhash_dedup import keep_representatives

OWN = ("__skey", "__dkey", "__tokens", "__n", "__full", "__block", "__cut", "__in", "__slot", "__shard", "__id", "__fp", "__of", "__ID_")


def clashing(spark):
    rows = [(i, prose(i % 9, 40), f"s{i % 3}") for i in range(12)] + [(3, prose(50, 30), "s0"), (None, prose(51, 30), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs, docs.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("text"), F.lit(""))).alias(c) for c in OWN])


def same(plain, other, columns):
    assert sorted(map(str, plain.select(*columns).collect())) == sorted(map(str, other.select(*columns).collect()))
    assert all(r[c] == f"{c} of {r.text}" for r in other.collect() for c in OWN)


def test_clashing_columns_are_kept_and_change_nothing(spark):
    docs, more = clashing(spark)
    same(mixed(docs, MixParams()), mixed(more, MixParams()), ["doc_id", "text", "source", "__epoch", "__order"])
    same(with_shard(docs), with_shard(more), ["doc_id", "text", "shard"])
    same(keep_representatives(docs), keep_representatives(more), ["doc_id", "text"])


def test_columns_named_like_the_results_are_replaced(spark):
    docs, _ = clashing(spark)
    got = mixed(docs.withColumn("__epoch", F.lit("mine")).withColumn("__order", F.lit("mine")), MixParams())
    assert got.columns.count("__epoch") == 1 and got.schema["__epoch"].dataType.simpleString() == "int"
    assert sorted(map(str, got.select("doc_id", "__epoch", "__order").collect())) == sorted(map(str, mixed(docs).select("doc_id", "__epoch", "__order").collect()))


def test_free_names(spark):
    df = spark.range(1).selectExpr("id as A", "id as _a", "id as b")
    assert free_names(df, "a", "c", "b") == ["__a", "c", "_b"]


def test_partition_sums_over_many_partitions(spark):
    def one(batches):
        rows = sum(b.num_rows for b in batches)
        if rows:
            yield block_rows(np.arange(10.0) * rows, 4)

    parts = spark.range(0, 900, 1, 60).mapInArrow(one, "block int, v binary")
    assert np.array_equal(joined_blocks(summed_blocks(parts, fan_in=7), (10,)), np.arange(10.0) * 900)
    assert np.array_equal(joined_blocks(summed_blocks(parts.where("block < 0")), (10,)), np.zeros(10))
