"""Customer value, recency risk, value segments and policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.functions.exprs import clip, first_by, money
from servicelens.functions.ranking import average_percent_rank, global_row_number, ntile
from servicelens.params import Params
from servicelens.sources.csv_source import as_of_date

# The reference's scoring constants.
RISK_HORIZON_DAYS = 240.0
MIN_TENURE_DAYS = 30
VALUE_WEIGHT, RISK_WEIGHT = 0.6, 0.4
VALUE_SEGMENTS = ("Low", "Medium", "High", "VIP")  # revenue quartiles, ascending
HIGH_RISK = 0.5  # recency risk from which a customer counts as at risk (policy, ours)


def customer_rollup(visits: DataFrame, lines: DataFrame, params: Params) -> DataFrame:
    """R1-R3 (+R8): per owner: name/phone of the first visit, assets, visits, revenue,
    dates, anchor visits, recency, tenure, annualised revenue and recency risk.

    ``visits`` carries the asset master columns (V4); visits of an unknown
    asset have no owner and drop out.
    """
    as_of = as_of_date(lines, params)
    v = visits.where(F.col("customer_id").isNotNull())
    c = v.groupBy("customer_id").agg(
        first_by("owner_name", "visit_id").alias("customer_name"),
        first_by("phone", "visit_id").alias("phone"),
        F.count_distinct("asset_id").alias("assets"),
        F.count(F.lit(1)).alias("visits"),
        F.sum(money("visit_revenue")).cast("double").alias("revenue"),
        F.min("visit_date").alias("first_visit"),
        F.max("visit_date").alias("last_visit"),
        F.count_if(F.col("has_anchor")).alias("anchor_visits"),
    )
    return (c.withColumn("days_since_last_visit", F.datediff(as_of, F.col("last_visit")))
            .withColumn("tenure_days", F.greatest(F.datediff("last_visit", "first_visit"), F.lit(MIN_TENURE_DAYS)))
            .withColumn("annualized_revenue", F.col("revenue") / F.col("tenure_days") * F.lit(365.0))
            .withColumn("avg_visit_revenue", F.col("revenue") / F.col("visits"))
            .withColumn("recency_risk", clip(F.col("days_since_last_visit") / F.lit(RISK_HORIZON_DAYS), 0.0, 1.0)))


def value_score(customers: DataFrame) -> DataFrame:
    """Percentile value score (average ties), risk score, reactivation priority."""
    out = average_percent_rank(customers, "annualized_revenue", ["customer_id"], "__pct")
    return (out.withColumn("value_score", F.lit(100.0) * F.col("__pct")).drop("__pct")
            .withColumn("risk_score", F.lit(100.0) * F.col("recency_risk"))
            .withColumn("priority_reactivation_score",
                        F.lit(VALUE_WEIGHT) * F.col("value_score") + F.lit(RISK_WEIGHT) * F.col("risk_score")))


def value_segment(customers: DataFrame) -> DataFrame:
    """Revenue quartiles (NTILE(4) ascending, ties by owner id) and the action policy."""
    ranked = global_row_number(customers, ["revenue", "customer_id"], "__rn")
    n = ranked.select(F.max("__rn")).scalar()  # last position = row count, no extra pass
    q = ntile(F.col("__rn"), n, len(VALUE_SEGMENTS))
    seg = None
    for i, name in enumerate(VALUE_SEGMENTS, start=1):
        seg = F.when(q == i, F.lit(name)) if seg is None else seg.when(q == i, F.lit(name))
    out = ranked.withColumn("value_quartile", q).withColumn("value_segment", seg).drop("__rn")
    high_value = F.col("value_segment").isin("High", "VIP")
    at_risk = F.col("recency_risk") >= HIGH_RISK
    action = (F.when(high_value & at_risk, "reactivation campaign")
              .when(high_value, "premium service reminder")
              .when(at_risk, "automated reminder")
              .otherwise("standard reminder"))
    return out.withColumn("action", action)
