"""Baskets, frequent itemsets, association rules, attach rates.

Pair co-occurrence is counted on *basket patterns*: visits are first reduced
to their sorted set of frequent items and grouped by that set (pre-aggregated
before any pair is formed), then each distinct pattern contributes its
ordered item pairs weighted by the number of visits carrying it.  The work
after the first aggregate depends on the number of distinct patterns and on
the catalogue, not on the number of visits, and no row-level self join is
planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens.functions.exprs import half_even, money_avg, money_sum
from servicelens.params import Params
from servicelens.session import cut_lineage

#: Baskets that a task of the miner makes its trees of.
BASKETS_A_TASK = 250_000


def _rule_sort():
    return (F.desc("estimated_rule_revenue"), F.desc("lift"), F.desc("confidence"))


def transaction_count(lines: DataFrame) -> Column:
    """Number of baskets (visits) as a scalar subquery."""
    return lines.where(F.col("visit_id").isNotNull()).select("visit_id").distinct().select(F.count(F.lit(1))).scalar()


def baskets(lines: DataFrame) -> DataFrame:
    """B1: visit -> sorted distinct items (bounded by the catalogue per visit)."""
    return (lines.where(F.col("visit_id").isNotNull())
            .groupBy("visit_id").agg(F.array_sort(F.collect_set("item")).alias("items")))


def item_prices(lines: DataFrame) -> DataFrame:
    """Mean line price per item."""
    return lines.where(F.col("item").isNotNull()).groupBy("item").agg(money_avg("price").alias("avg_price"))


# ------------------------------------------------------------------ FP-Growth
def frequent_itemsets(lines: DataFrame, params: Params) -> DataFrame:
    """FP-Growth (Spark ML, parallel FP-growth) itemsets with support >= min_support."""
    from pyspark.ml.fpm import FPGrowth

    b = cut_lineage(baskets(lines))  # counted, and read by each pass of the miner
    n = b.select(F.count(F.lit(1))).scalar()
    # a task of the miner makes trees of its own baskets, which share the more of their paths the more baskets it has
    dealt = b.where(F.size("items") > 0).coalesce(max(1, -(-b.count() // BASKETS_A_TASK)))
    model = FPGrowth(itemsCol="items", minSupport=params.min_support, minConfidence=0.0).fit(dealt)
    return cut_lineage(model.freqItemsets
                       .select(F.array_sort("items").alias("items"), F.col("freq"))
                       .withColumn("size", F.size("items"))
                       .withColumn("support", F.col("freq") / n)
                       .where(F.col("support") >= params.min_support))  # the miner counts no baskets without an item


def association_rules(lines: DataFrame, params: Params, itemsets: DataFrame | None = None) -> DataFrame:
    """Every non-empty proper subset of a frequent itemset as antecedent.

    Spark's own rule generator emits single-item consequents only; here the
    subsets are enumerated with a bit mask per itemset and the antecedent /
    consequent supports are looked up by joining on the sorted item array.
    """
    fi = itemsets if itemsets is not None else frequent_itemsets(lines, params)
    fi = fi.select("items", "freq", "support")
    n = transaction_count(lines)
    multi = fi.where(F.size("items") >= 2)
    masks = multi.withColumn(
        "mask", F.explode(F.expr("sequence(1L, shiftleft(1L, size(items)) - 2L)")))
    split = masks.select(
        F.col("items").alias("itemset"), F.col("freq"), F.col("support"),
        F.expr("filter(items, (x, i) -> shiftright(mask, i) & 1L = 1L)").alias("antecedent"),
        F.expr("filter(items, (x, i) -> shiftright(mask, i) & 1L = 0L)").alias("consequent"),
    )
    ant = fi.select(F.col("items").alias("antecedent"), F.col("support").alias("antecedent_support"))
    con = fi.select(F.col("items").alias("consequent"), F.col("support").alias("consequent_support"))
    r = split.join(ant, "antecedent").join(con, "consequent")
    conf = F.col("support") / F.col("antecedent_support")
    r = (r.withColumn("confidence", conf)
         .withColumn("lift", F.col("confidence") / F.col("consequent_support"))
         .withColumn("leverage", F.col("support") - F.col("antecedent_support") * F.col("consequent_support"))
         .withColumn("conviction", F.when(F.col("confidence") == 1.0, F.lit(float("inf")))
                     .otherwise((F.lit(1.0) - F.col("consequent_support")) / (F.lit(1.0) - F.col("confidence"))))
         .where(F.col("lift") >= params.min_lift))
    # consequent price = mean of its items' mean prices
    prices = item_prices(lines)
    cprice = (r.select("consequent").distinct()
              .select("consequent", F.explode("consequent").alias("item"))
              .join(prices, "item", "left")
              .groupBy("consequent").agg(F.avg(F.coalesce("avg_price", F.lit(0.0))).alias("consequent_avg_price")))
    r = r.join(cprice, "consequent", "left")
    r = (r.withColumn("support_count", half_even(F.col("support") * n, 0).cast("bigint"))
         .withColumn("estimated_rule_revenue", F.col("support_count") * F.col("confidence") * F.col("consequent_avg_price")))
    return r.select(
        F.array_join("antecedent", " + ").alias("antecedents_txt"),
        F.array_join("consequent", " + ").alias("consequents_txt"),
        "support", "support_count", "confidence", "lift", "leverage", "conviction",
        "consequent_avg_price", "estimated_rule_revenue",
    ).orderBy(*_rule_sort(), "antecedents_txt", "consequents_txt")


# ------------------------------------------------------------------ pairwise
def item_visit_counts(lines: DataFrame) -> DataFrame:
    return item_counts(baskets(lines))


def item_counts(b: DataFrame) -> DataFrame:
    """Visits per item, from the basket table (no second pass over the lines)."""
    return b.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("visits"))


def pair_counts(lines: DataFrame, params: Params, b: DataFrame | None = None) -> DataFrame:
    """Ordered pairs (a, b) of frequent items with their co-occurrence visit count.

    Everything derives from the basket table (one shuffle of the lines):
    the transaction count, the frequent-item list (an array bounded by the
    catalogue, as a scalar subquery), each visit's pattern of frequent items
    and the pattern counts.
    """
    b = b if b is not None else baskets(lines)
    n = b.select(F.count(F.lit(1))).scalar()
    frequent = (item_counts(b).where(F.col("visits") / n >= params.min_support)
                .select(F.array_sort(F.collect_list("item"))).scalar())
    patterns = (b.select(F.array_intersect("items", frequent).alias("p"))
                .where(F.size("p") >= 2)
                .groupBy("p").agg(F.count(F.lit(1)).alias("w")))
    # one side after the other: no array of all pairs of a pattern is built
    pairs = patterns.select("w", "p", F.explode("p").alias("antecedent")).select("w", "antecedent", F.explode("p").alias("consequent"))
    return pairs.where("antecedent <> consequent").groupBy("antecedent", "consequent").agg(F.sum("w").alias("cooccurrence_visits"))


def pairwise_rules(lines: DataFrame, params: Params) -> DataFrame:
    """Single-item -> single-item rules with support and lift thresholds.

    Ratios follow the reference's formulas (support ratios, not count
    ratios).  ``conviction`` is NULL as in the reference's pairwise path.
    """
    b = baskets(lines)
    n = b.select(F.count(F.lit(1))).scalar().cast("double")
    counts = item_counts(b)
    pc = pair_counts(lines, params, b)
    r = (pc.join(counts.select(F.col("item").alias("antecedent"), F.col("visits").alias("antecedent_visits")), "antecedent")
         .join(counts.select(F.col("item").alias("consequent"), F.col("visits").alias("consequent_visits")), "consequent"))
    s_a = F.col("antecedent_visits") / n
    s_b = F.col("consequent_visits") / n
    r = (r.withColumn("support", F.col("cooccurrence_visits") / n)
         .where(F.col("support") >= params.min_support)
         .withColumn("confidence", F.col("support") / s_a)
         .withColumn("lift", F.col("confidence") / s_b)
         .where(F.col("lift") >= params.min_lift)
         .withColumn("leverage", F.col("support") - s_a * s_b)
         .withColumn("conviction", F.lit(None).cast("double")))
    r = r.join(item_prices(lines).select(F.col("item").alias("consequent"), F.col("avg_price").alias("consequent_avg_price")),
               "consequent", "left")
    r = (r.withColumn("consequent_avg_price", F.coalesce("consequent_avg_price", F.lit(0.0)))
         .withColumn("support_count", half_even(F.col("support") * n, 0).cast("bigint"))
         .withColumn("estimated_rule_revenue", F.col("support_count") * F.col("confidence") * F.col("consequent_avg_price"))
         .withColumn("potential_visits_without_consequent", F.col("antecedent_visits") - F.col("cooccurrence_visits"))
         .withColumn("estimated_rule_revenue_if_targeted",
                     F.col("potential_visits_without_consequent") * F.col("confidence") * F.col("consequent_avg_price")))
    return r.select(
        "antecedent", "consequent", "support", "support_count", "confidence", "lift", "leverage", "conviction",
        "antecedent_visits", "cooccurrence_visits", "potential_visits_without_consequent",
        "consequent_avg_price", "estimated_rule_revenue", "estimated_rule_revenue_if_targeted",
    ).orderBy(*_rule_sort(), "antecedent", "consequent")


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    """B2: the n best rules by estimated revenue, labelled ``a → b`` (a top-k report).

    ``rules`` is the table of ``association_rules`` (any number of items on a
    side, as the reference ranks them) or of ``pairwise_rules``.
    """
    if "antecedents_txt" in rules.columns:
        rules = rules.withColumnsRenamed({"antecedents_txt": "antecedent", "consequents_txt": "consequent"})
    return (rules.orderBy(*_rule_sort(), "antecedent", "consequent").limit(n)
            .select(F.concat_ws(" → ", "antecedent", "consequent").alias("rule"), "antecedent", "consequent",
                    "estimated_rule_revenue", "lift", "confidence"))


# ------------------------------------------------------------------ attach
def anchor_visits(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("is_anchor") & F.col("visit_id").isNotNull()).select("visit_id").distinct()


def in_anchor_visits(lines: DataFrame, av: DataFrame, tasks: int | None = None) -> DataFrame:
    """The lines of the visits ``av``, dealt out by visit to ``tasks`` tasks before they are sorted and joined."""
    lines = lines.where(F.col("visit_id").isNotNull())
    return (lines if tasks is None else lines.repartition(tasks, "visit_id")).join(av, "visit_id", "left_semi")


def attach_rates(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """For lines in anchor visits other than the anchor lines, per item:
    visits, attach rate (/ anchor visits), revenue and mean price."""
    av = anchor_visits(lines)
    n_anchor = av.select(F.count(F.lit(1))).scalar()
    sub = in_anchor_visits(lines.where(~F.col("is_anchor") & F.col("item").isNotNull()), av, tasks)
    g = sub.groupBy("item").agg(
        F.count_distinct("visit_id").alias("visits_with_item"),
        money_sum("price").alias("revenue_in_anchor_visits"),
        money_avg("price").alias("avg_price"),
    )
    return (g.withColumn("attach_rate", F.col("visits_with_item") / n_anchor)
            .select("item", "attach_rate", "visits_with_item", "revenue_in_anchor_visits", "avg_price")
            .orderBy(F.desc("revenue_in_anchor_visits"), F.desc("attach_rate"), "item"))


def attach_rates_full(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every item that is not only an anchor line, zeros kept, global mean price."""
    ar = attach_rates(lines, tasks).drop("avg_price")
    items = (lines.where(F.col("item").isNotNull() & ~F.col("is_anchor"))
             .groupBy("item").agg(money_avg("price").alias("avg_price")))
    return (items.join(ar, "item", "left")
            .select("item",
                    F.coalesce("attach_rate", F.lit(0.0)).alias("attach_rate"),
                    F.coalesce("visits_with_item", F.lit(0)).cast("bigint").alias("visits_with_item"),
                    "avg_price",
                    F.coalesce("revenue_in_anchor_visits", F.lit(0.0)).alias("revenue_in_anchor_visits"))
            .orderBy(F.desc("revenue_in_anchor_visits"), F.desc("attach_rate"), "item"))


def conditional_item_rate(lines: DataFrame, params: Params, tasks: int | None = None) -> DataFrame:
    """P(item in visit | anchor visit) for the named probe items."""
    av = anchor_visits(lines)
    n_anchor = av.select(F.count(F.lit(1))).scalar()
    probes = list(params.probe_items)
    sub = in_anchor_visits(lines.where(F.col("item").isin(probes)), av, tasks)
    g = sub.groupBy("item").agg(F.count_distinct("visit_id").alias("anchor_visits_with_item"))
    return g.select("item", "anchor_visits_with_item", (F.col("anchor_visits_with_item") / n_anchor).alias("rate"))
