"""KPI summary, revenue breakdowns and dataset summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servicelens.functions.exprs import MONEY, money, money_avg, money_sum, ratio


def _per_visit(lines: DataFrame) -> DataFrame:
    """One pass over the lines: per-visit partial totals (the NULL visit id is its own group)."""
    price = money("price")
    return lines.groupBy("visit_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("visit_date").alias("dmin"), F.max("visit_date").alias("dmax"),
        F.sum(price).alias("total"),
        F.sum(F.when(F.col("is_anchor"), price)).alias("anchor"),
        F.bool_or("is_anchor").alias("a"),
    )


def kpi_summary(lines: DataFrame, assets: DataFrame) -> DataFrame:
    """K1: one wide row.

    The lines are read once: a per-visit aggregate (map-side combined) is
    folded into the totals; the asset counts come from a scalar subquery.
    """
    pv = _per_visit(lines)
    t = pv.agg(
        F.sum("n").alias("service_item_rows"),
        F.min("dmin").alias("date_min"), F.max("dmax").alias("date_max"),
        F.sum("total").alias("_total"),
        F.sum("anchor").alias("_anchor"),
        F.count("visit_id").alias("visits"),
        F.count_if(F.col("visit_id").isNotNull() & F.col("a")).alias("anchor_visits"),
    )
    a = assets.agg(F.count_distinct("customer_id").alias("customers"),
                   F.count_distinct("asset_id").alias("cars"))
    total = F.col("_total").cast("double")
    anchor = F.coalesce(F.col("_anchor"), F.lit(0).cast(MONEY))
    return t.select(
        a.select("customers").scalar().alias("customers"),
        a.select("cars").scalar().alias("cars"),
        F.col("visits"),
        F.col("service_item_rows"),
        F.col("date_min"), F.col("date_max"),
        total.alias("total_revenue"),
        anchor.cast("double").alias("anchor_revenue"),
        (F.col("_total") - anchor).cast("double").alias("cross_sell_revenue"),
        ratio((F.col("_total") - anchor).cast("double"), total).alias("cross_sell_share"),
        ratio(total, F.col("visits").cast("double")).alias("avg_order_value"),
        F.col("anchor_visits"),
    )


def kpi_long(lines: DataFrame, assets: DataFrame) -> DataFrame:
    """K2: the long ``metric, value`` layout with the extra shares.

    Dates are carried in ``value_text``; every other metric in ``value``.
    """
    return kpi_rows(kpi_summary(lines, assets))


def kpi_rows(k: DataFrame) -> DataFrame:
    """K2 of a KPI summary that is there already."""
    d = "double"
    metrics = [
        ("customers", F.col("customers").cast(d), None),
        ("cars", F.col("cars").cast(d), None),
        ("visits", F.col("visits").cast(d), None),
        ("service_item_rows", F.col("service_item_rows").cast(d), None),
        ("date_min", F.lit(None).cast(d), F.col("date_min").cast("string")),
        ("date_max", F.lit(None).cast(d), F.col("date_max").cast("string")),
        ("total_revenue", F.col("total_revenue"), None),
        ("anchor_revenue", F.col("anchor_revenue"), None),
        ("cross_sell_revenue", F.col("cross_sell_revenue"), None),
        ("anchor_share", ratio(F.col("anchor_revenue"), F.col("total_revenue")), None),
        ("cross_sell_share", F.col("cross_sell_share"), None),
        ("avg_order_value", F.col("avg_order_value"), None),
        ("items_per_visit", ratio(F.col("service_item_rows").cast(d), F.col("visits").cast(d)), None),
        ("anchor_visits", F.col("anchor_visits").cast(d), None),
        ("anchor_visit_share", ratio(F.col("anchor_visits").cast(d), F.col("visits").cast(d)), None),
    ]
    rows = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(name).alias("metric"), val.alias("value"),
                 (txt if txt is not None else F.lit(None).cast("string")).alias("value_text"))
        for i, (name, val, txt) in enumerate(metrics)
    ])
    return k.select(F.inline(rows)).orderBy("ord").drop("ord")


def _revenue_by(lines: DataFrame, key: str, with_avg: bool) -> DataFrame:
    """Revenue, rows, distinct visits (and mean price) per key, plus the share of the total.

    The total is summed over the grouped rows (exact decimals) with a window
    over the aggregate -- one row per key, bounded by the key's domain -- so
    the lines are read once (a scalar subquery would be pruned to a
    different aggregate and re-read them).
    """
    aggs = [
        F.sum(money("price")).alias("_rev"),
        F.count("line_id").alias("rows"),
        F.count_distinct("visit_id").alias("visits"),
    ]
    if with_avg:
        aggs.append(money_avg("price").alias("avg_price"))
    g = lines.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    total = F.sum("_rev").over(Window.partitionBy()).cast("double")
    out = g.withColumn("revenue", F.col("_rev").cast("double"))
    cols = [key, "revenue", "rows", "visits"] + (["avg_price"] if with_avg else [])
    return (out.withColumn("revenue_share", ratio(F.col("revenue"), total))
            .select(*cols, "revenue_share").orderBy(F.desc("revenue"), key))


def revenue_by_category(lines: DataFrame) -> DataFrame:
    """K3: revenue, line rows, distinct visits and share per category."""
    return _revenue_by(lines, "category", with_avg=False)


def revenue_by_item(lines: DataFrame) -> DataFrame:
    """K4 (= B10 item price stats): K3 per item plus the mean line price."""
    return _revenue_by(lines, "item", with_avg=True)


def dataset_summary(lines: DataFrame, assets: DataFrame) -> DataFrame:
    """Counts, date range and revenue of a dataset."""
    t = lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("visit_date").alias("date_min"),
        F.max("visit_date").alias("date_max"),
        money_sum("price").alias("total_revenue"),
    )
    visits = lines.where(F.col("visit_id").isNotNull()).select("visit_id").distinct().select(F.count(F.lit(1))).scalar()
    a = assets.agg(F.count_distinct("customer_id").alias("customers"), F.count_distinct("asset_id").alias("cars"))
    return t.select(a.select("customers").scalar().alias("customers"), a.select("cars").scalar().alias("cars"),
                    visits.alias("visits"), "lines", "date_min", "date_max", "total_revenue")


def executive_summary(kpi_row: DataFrame, rules: DataFrame, forecast: DataFrame, episodes: DataFrame) -> DataFrame:
    """The report's headline numbers in one row: revenue, order value, anchor visit
    share, the best rule by estimated revenue, the forecast totals and the episode count."""
    best = (rules.orderBy(F.desc("estimated_rule_revenue"), F.desc("lift"), F.desc("confidence"), "antecedent",
                          "consequent").limit(1)
            .select(F.concat_ws(" → ", "antecedent", "consequent").alias("best_rule"),
                    F.col("estimated_rule_revenue").alias("best_rule_revenue")))
    fc = forecast.agg(F.sum("forecast_visits").alias("forecast_visits"), F.sum("forecast_revenue").alias("forecast_revenue"))
    return kpi_row.select(
        "total_revenue", "avg_order_value",
        ratio(F.col("anchor_visits").cast("double"), F.col("visits").cast("double")).alias("anchor_visit_share"),
        best.select("best_rule").scalar().alias("best_rule"),
        best.select("best_rule_revenue").scalar().alias("best_rule_revenue"),
        fc.select("forecast_visits").scalar().alias("forecast_visits"),
        fc.select("forecast_revenue").scalar().alias("forecast_revenue"),
        episodes.select(F.count(F.lit(1))).scalar().alias("episodes"),
    )


def segment_distribution(assets: DataFrame) -> DataFrame:
    """Assets per usage segment."""
    return assets.groupBy("segment").agg(F.count(F.lit(1)).alias("assets")).orderBy(F.desc("assets"), "segment")


def top_items(lines: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent items by line count (a top-k report)."""
    return (lines.where(F.col("item").isNotNull()).groupBy("item").agg(F.count(F.lit(1)).alias("lines"))
            .orderBy(F.desc("lines"), "item").limit(n))
