"""Due-alert scoring, tiers, reminder text and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens.functions.exprs import LINE_ORDER, clip, first_word, half_even
from servicelens.functions.stats import grouped_median
from servicelens.params import Params
from servicelens.sources.csv_source import as_of_date

# Scoring weights and tier thresholds of the reference.
DAY_WEIGHT, KM_WEIGHT = 0.55, 0.45
LOGISTIC_SLOPE, LOGISTIC_CENTER = 10.0, 0.90
SCORE_PROB_W, SCORE_COMBINED_W, SCORE_KM_W = 0.45, 0.35, 0.20
TIERS = (("Critical", 85.0), ("High Priority", 70.0), ("Warm Reminder", 55.0))
DEFAULT_TIER = "Monitor"
TIER_ORDER = ("Critical", "High Priority", "Warm Reminder", "Monitor")
DAYS_PER_MONTH = 30.0

ALERT_COLUMNS = (
    "customer_id", "owner_name", "phone", "asset_id", "plate", "model", "trim", "fuel", "drive", "oil_type",
    "interval_km", "segment", "last_anchor_date", "last_anchor_km", "days_since_last_anchor",
    "est_km_since_last_anchor", "predicted_interval_days", "progress_day", "progress_km",
    "due_probability", "priority_score", "alert_tier", "reminder_message",
)


def last_anchor(lines: DataFrame) -> DataFrame:
    """A1: latest anchor line per asset (date, meter, visit); a map-side combined max_by."""
    order = F.struct("visit_date", *[F.col(c) for c in LINE_ORDER])
    return (lines.where(F.col("is_anchor") & F.col("asset_id").isNotNull())
            .groupBy("asset_id")
            .agg(F.max_by(F.struct("visit_date", "meter_km", "visit_id"), order).alias("l"))
            .select("asset_id", F.col("l.visit_date").alias("last_anchor_date"),
                    F.col("l.meter_km").alias("last_anchor_km"), F.col("l.visit_id").alias("last_anchor_visit_id")))


def segment_interval(episodes: DataFrame, value: str, params: Params) -> tuple[DataFrame, Column]:
    """A4 lookup: per-segment median of ``value`` and the global median (fallback)."""
    ep = episodes.where(F.col("segment").isNotNull())
    if params.exact_median:
        seg = grouped_median(ep, ["segment"], value, "segment_interval")
        overall = grouped_median(episodes, [], value, "m").select("m").scalar()
        return seg, overall
    agg = F.percentile_approx(value, 0.5, 10000).cast("double")
    seg = ep.groupBy("segment").agg(agg.alias("segment_interval"))
    return seg, episodes.select(agg).scalar()


def priority(progress_day: Column, progress_km: Column) -> tuple[Column, Column, Column]:
    """Combined progress, logistic due probability and the 0..100 score."""
    combined = F.lit(DAY_WEIGHT) * progress_day + F.lit(KM_WEIGHT) * progress_km
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-LOGISTIC_SLOPE) * (combined - F.lit(LOGISTIC_CENTER))))
    raw = F.lit(100.0) * (F.lit(SCORE_PROB_W) * prob + F.lit(SCORE_COMBINED_W) * combined
                          + F.lit(SCORE_KM_W) * progress_km)
    return combined, prob, clip(raw, 0.0, 100.0)


def tier(score: Column) -> Column:
    """Tier by thresholds; NULL score -> Monitor."""
    out = None
    for name, lo in TIERS:
        out = F.when(score >= lo, F.lit(name)) if out is None else out.when(score >= lo, F.lit(name))
    return out.otherwise(F.lit(DEFAULT_TIER))


def reminder_message(owner: Column, model: Column, plate: Column, pd: Column, pk: Column) -> Column:
    """Reminder text; the percent is max(day, km progress) rounded half-even.

    NULL when the asset has no anchor visit (no progress to report).
    """
    top = F.when(pd.isNull(), F.lit(None)).when(pk.isNull(), pd).otherwise(F.greatest(pd, pk))
    pct = half_even(top * F.lit(100.0), 0).cast("bigint").cast("string")
    return F.concat(F.lit("Hello "), first_word(owner), F.lit(", your "), model, F.lit(" "), plate,
                    F.lit(" has reached about "), pct,
                    F.lit("% of its recommended service interval. Reply to this message to book a service slot."))


def score_alerts(lines: DataFrame, assets: DataFrame, episodes: DataFrame, params: Params,
                 interval_col: str = "gap_days", as_of: Column | None = None) -> DataFrame:
    """A2-A10: every asset of the master with its due score, tier and message.

    Only the anchor lines of ``lines`` count; with ``as_of`` given they may be
    all that it holds.

    ``interval_col`` of ``episodes`` feeds the segment medians: the actual
    gap (default) or a model's predicted gap.
    """
    as_of = as_of_date(lines, params) if as_of is None else as_of
    seg, global_median = segment_interval(episodes, interval_col, params)
    base = assets.join(last_anchor(lines), "asset_id", "left").join(seg, "segment", "left")
    days = F.datediff(as_of, F.col("last_anchor_date"))
    base = (base
            .withColumn("days_since_last_anchor", days)
            .withColumn("est_km_since_last_anchor",
                        F.col("days_since_last_anchor") * F.col("km_per_month") / F.lit(DAYS_PER_MONTH))
            .withColumn("predicted_interval_days", F.coalesce(F.col("segment_interval"), global_median))
            .withColumn("progress_day", F.col("days_since_last_anchor") / F.col("predicted_interval_days"))
            .withColumn("progress_km", F.col("est_km_since_last_anchor") / F.col("interval_km")))
    combined, prob, score = priority(F.col("progress_day"), F.col("progress_km"))
    base = (base.withColumn("due_probability", prob)
            .withColumn("priority_score", score)
            .withColumn("alert_tier", tier(F.col("priority_score")))
            .withColumn("reminder_message", reminder_message(F.col("owner_name"), F.col("model"), F.col("plate"),
                                                             F.col("progress_day"), F.col("progress_km"))))
    return base.select(*ALERT_COLUMNS)


def rank_alerts(alerts: DataFrame) -> DataFrame:
    """A10: highest score first, then km progress (NULLs last)."""
    return alerts.orderBy(F.desc_nulls_last("priority_score"), F.desc_nulls_last("progress_km"), "asset_id")


def tier_distribution(alerts: DataFrame) -> DataFrame:
    """Assets per tier in fixed order, zero-filled (4-row tier table)."""
    spark = alerts.sparkSession
    tiers = spark.createDataFrame([(i, t) for i, t in enumerate(TIER_ORDER)], "ord int, alert_tier string")
    counts = alerts.groupBy("alert_tier").agg(F.count(F.lit(1)).alias("assets"))
    return (tiers.join(counts, "alert_tier", "left")
            .select("ord", "alert_tier", F.coalesce("assets", F.lit(0)).alias("assets"))
            .orderBy("ord").drop("ord"))
