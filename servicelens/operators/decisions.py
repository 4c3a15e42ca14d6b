"""Uplift scenarios and the decision tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servicelens.functions.ranking import global_row_number
from servicelens.params import Params

# The reference's conversion scenarios (name, conversion, cross-sell uplift).
SCENARIOS = (("Conservative", 0.08, 0.03), ("Base Case", 0.14, 0.06), ("Aggressive", 0.22, 0.10))
TARGET_TIERS = ("Warm Reminder", "High Priority", "Critical")
URGENT_TIERS = ("High Priority", "Critical")
TOP_N = (100, 250)


def _targets(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("alert_tier").isin(*TARGET_TIERS))


def uplift_scenarios(alerts: DataFrame, avg_order_value) -> DataFrame:
    """Targetable assets (Warm and above) x conversion x average order value, 3 scenarios.

    ``avg_order_value`` is a scalar column (e.g. a scalar subquery of K1).
    """
    spark = alerts.sparkSession
    n = _targets(alerts).select(F.count(F.lit(1))).scalar()
    sc = spark.createDataFrame(list(SCENARIOS), "scenario string, assumed_conversion_rate double, "
                                                "assumed_cross_sell_uplift double")
    inc_visits = n * F.col("assumed_conversion_rate")
    service = inc_visits * avg_order_value
    cross = service * F.col("assumed_cross_sell_uplift")
    return sc.select("scenario", n.alias("targetable_assets"), "assumed_conversion_rate",
                     inc_visits.alias("incremental_visits"), service.alias("incremental_service_revenue"),
                     "assumed_cross_sell_uplift", cross.alias("incremental_cross_sell_revenue"),
                     (service + cross).alias("total_incremental_revenue"))


def topn_uplift(alerts: DataFrame, visits: DataFrame, params: Params) -> DataFrame:
    """Top-100 / top-250 / High+Critical targets x conversion x mean anchor-visit revenue."""
    spark = alerts.sparkSession
    total = alerts.select(F.count(F.lit(1))).scalar()
    urgent = alerts.where(F.col("alert_tier").isin(*URGENT_TIERS)).select(F.count(F.lit(1))).scalar()
    avg_value = (visits.where(F.col("has_anchor"))
                 .select((F.sum(F.col("visit_revenue")).cast("double") / F.count(F.lit(1))).alias("v")).scalar())
    rows = [(f"Top {k} due reminders", k, i) for i, k in enumerate(TOP_N)] + [("All High/Critical reminders", -1, 2)]
    sc = spark.createDataFrame(rows, "scenario string, k int, ord int")
    target = F.when(F.col("k") < 0, urgent).otherwise(F.least(F.col("k").cast("bigint"), total))
    return sc.select("ord", "scenario", target.alias("target_count"),
                     F.lit(params.uplift_conversion).alias("assumed_conversion"),
                     avg_value.alias("avg_anchor_visit_value"),
                     (target * F.lit(params.uplift_conversion) * avg_value).alias("estimated_incremental_revenue")) \
             .orderBy("ord").drop("ord")


def next_best_offer(alerts: DataFrame, last_anchor: DataFrame, baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """Per targeted asset, the best-ranked rule whose antecedent is in the last anchor
    visit's basket and whose consequent is not (rank: estimated revenue, lift, confidence)."""
    t = (_targets(alerts).select("asset_id", "customer_id", "alert_tier", "priority_score")
         .join(last_anchor.select("asset_id", F.col("last_anchor_visit_id").alias("visit_id")), "asset_id")
         .join(baskets, "visit_id"))
    owned = t.select("asset_id", "items", F.explode("items").alias("antecedent"))
    cand = (owned.join(rules.select("antecedent", "consequent", "estimated_rule_revenue", "lift", "confidence"),
                       "antecedent")
            .where(~F.array_contains("items", F.col("consequent"))))
    w = Window.partitionBy("asset_id").orderBy(F.desc("estimated_rule_revenue"), F.desc("lift"),
                                               F.desc("confidence"), "antecedent", "consequent")
    best = cand.withColumn("rk", F.row_number().over(w)).where(F.col("rk") == 1).drop("rk", "items")
    return t.drop("items").join(best, "asset_id", "left").select(
        "asset_id", "customer_id", "alert_tier", "priority_score", "visit_id",
        F.col("antecedent").alias("offer_because_of"), F.col("consequent").alias("next_best_offer"),
        "estimated_rule_revenue", "lift", "confidence")


def campaign_target_list(alerts: DataFrame, customers: DataFrame) -> DataFrame:
    """D3: Warm-and-above alerts with their owner's value score and segment, most urgent first."""
    c = customers.select("customer_id", "value_score", "value_segment", "action")
    return (_targets(alerts).join(c, "customer_id", "left")
            .orderBy(F.desc_nulls_last("priority_score"), F.desc_nulls_last("value_score"), "asset_id"))


def capacity_schedule(alerts: DataFrame, forecast: DataFrame, params: Params) -> DataFrame:
    """Ranked targets assigned to forecast weeks within the weekly headroom
    (capacity - forecast visits); targets beyond the horizon's headroom stay unscheduled.
    Without a given capacity it is 11/10 of the highest forecast week, rounded up.

    The slot table has one row per forecast week (bounded by the horizon
    parameter), so it is broadcast into a range join.
    """
    most = F.max("forecast_visits").over(Window.partitionBy("series"))  # horizon rows
    capacity = F.floor((most * 11 + 9) / 10) if params.weekly_capacity is None else F.lit(params.weekly_capacity)
    fc = forecast.where(F.col("series") == "ALL").select(
        "week", F.greatest(capacity - F.col("forecast_visits"), F.lit(0)).alias("headroom"))
    w = Window.orderBy("week")
    slots = fc.select("week", F.sum("headroom").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    slots = slots.withColumn("prev", F.coalesce(F.lag("cum").over(w), F.lit(0)))
    ranked = global_row_number(_targets(alerts).select("asset_id", "customer_id", "alert_tier", "priority_score",
                                                       F.coalesce("progress_km", F.lit(-1.0)).alias("_pk")),
                               [F.desc_nulls_last("priority_score"), F.desc("_pk"), F.asc("asset_id")], "target_rank")
    # range join against the horizon-sized slot table (one row per forecast week)
    cond = (F.col("target_rank") > F.col("prev")) & (F.col("target_rank") <= F.col("cum"))
    return ranked.join(F.broadcast(slots), cond, "left").select(
        "asset_id", "customer_id", "alert_tier", "priority_score", "target_rank",
        F.col("week").alias("scheduled_week"))
