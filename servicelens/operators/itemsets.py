"""B3 on weighted patterns: frequent itemsets grown item by item, each distinct basket counted once.

Visits are reduced to their frequent items, rarest first, and equal ones are
merged into a pattern with its number of visits before anything is mined. An
itemset is then kept beside the items that may still follow it (the rest of
the pattern); the next level takes each of these in turn, and equal
(itemset, rest) rows are merged again. Since rare items come first, an item of
most baskets has a short rest wherever it occurs. No task holds the patterns
of an item: levels are grouped sums, combined before they are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.operators.basket import baskets, item_counts
from servicelens.params import Params
from servicelens.session import cut_lineage


def weighted_patterns(b: DataFrame, min_support: float, n: int) -> DataFrame:
    """(rest, w): the frequent items of a basket, rarest first, and the number of baskets that have just these.

    The list of frequent items is bounded by the catalogue and by mean basket
    size / ``min_support``. Baskets without a frequent item are left out.
    """
    frequent = (item_counts(b).where(F.col("visits") / F.lit(n) >= min_support)
                .select(F.transform(F.array_sort(F.collect_list(F.struct("visits", "item"))), lambda x: x["item"])).scalar())
    return (b.select(F.array_intersect(frequent, F.col("items")).alias("rest"))
            .where(F.size("rest") > 0).groupBy("rest").agg(F.count(F.lit(1)).alias("w")))


def grown(state: DataFrame) -> DataFrame:
    """Each itemset with each item of its rest, and what is left of the rest; equal ones merged."""
    longer = state.select("items", "rest", "w", F.posexplode("rest").alias("at", "item"))
    return (longer.select(F.array_append("items", F.col("item")).alias("items"), "w",
                          F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"))
            .groupBy("items", "rest").agg(F.sum("w").alias("w")))


def weighted_itemsets(lines: DataFrame, params: Params) -> DataFrame:
    """(items, freq, size, support) of all itemsets with support >= min_support.

    The rows of ``basket.frequent_itemsets``. Levels are written to the
    checkpoint folder; there are as many as the longest frequent itemset has
    items, and one more that finds nothing. Lines without a visit are left
    out, visits without an item count as baskets. No lines give no rows.
    """
    b = cut_lineage(baskets(lines))
    n = b.count()
    state = cut_lineage(weighted_patterns(b, params.min_support, n)).select(
        F.array().cast("array<string>").alias("items"), "rest", "w")
    found = []
    while True:
        level = cut_lineage(grown(state))
        often = cut_lineage(level.groupBy("items").agg(F.sum("w").alias("freq")).where(F.col("freq") / F.lit(n) >= params.min_support))
        found.append(often)
        if often.isEmpty():
            break
        state = level.where(F.size("rest") > 0).join(often.select("items"), "items", "left_semi")
    return (reduce(DataFrame.unionByName, found)
            .select(F.array_sort("items").alias("items"), "freq", F.size("items").alias("size"),
                    (F.col("freq") / F.lit(n)).alias("support")))
