"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) -> (node, label): label is the smallest node reachable.

    Nodes without an edge to another node are not returned. Minima are partly
    aggregated before each shuffle, and each join has two written tables as
    inputs, so a hub with most of all edges is split by adaptive execution.
    Each half step is written to the shared folder; the edges never reach the
    driver, only two counts per round do.
    """
    e = materialise(
        edges.where("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct()
    )
    while True:
        lows = e.groupBy("hi").agg(F.count(F.lit(1)).alias("n"))
        unsettled = (
            lows.where("n > 1").select(F.col("hi").alias("x"))
            .unionByName(e.select(F.col("lo").alias("x")).distinct().join(lows.select(F.col("hi").alias("x")), "x", "left_semi"))
        )
        if unsettled.isEmpty():
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("label")).unionByName(
                e.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct()
            )
        e = _small_star(_large_star(e))


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of u now points to the smallest of u and its neighbours."""
    both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    low = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return materialise(
        both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, now point to the smallest of them."""
    low = materialise(e.groupBy("hi").agg(F.min("lo").alias("m")))
    moved = e.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return materialise(moved.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct())
