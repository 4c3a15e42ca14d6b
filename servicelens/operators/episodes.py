"""Anchor-service episodes (consecutive anchor visits per asset)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.functions.exprs import LINE_ORDER
from servicelens.functions.windows import lag_by_key
from servicelens.params import Params

EPISODE_ASSET_COLS = ("model_year", "fuel", "drive", "oil_type", "interval_km", "segment", "km_per_month")


def anchor_lines(lines: DataFrame) -> DataFrame:
    """The first anchor line of every visit (visit, asset, date, meter, price)."""
    first = F.min(F.struct(*[F.col(c) for c in LINE_ORDER], "asset_id", "visit_date", "meter_km"))
    return (lines.where(F.col("is_anchor"))
            .groupBy("visit_id").agg(first.alias("f"))
            .select("visit_id", "f.asset_id", "f.visit_date", "f.meter_km", "f.price"))


def episode_lag(lines: DataFrame) -> DataFrame:
    """Previous anchor visit of the same asset, gaps in days and km."""
    a = anchor_lines(lines)
    lagged = lag_by_key(a, "asset_id", ["visit_date", "meter_km", "visit_id"], ["visit_date", "meter_km"])
    return (lagged
            .withColumnRenamed("prev_visit_date", "prev_date")
            .withColumnRenamed("prev_meter_km", "prev_meter_km")
            .withColumn("gap_days", F.datediff("visit_date", "prev_date"))
            .withColumn("gap_km", F.col("meter_km") - F.col("prev_meter_km"))
            .withColumn("event", F.lit(1)))


def build_episodes(lines: DataFrame, assets: DataFrame, params: Params) -> DataFrame:
    """Valid episodes (0 < gap_days <= max, gap_km > 0) with model features.

    The asset master is joined after the lag (one row per asset assumed;
    the audit reports duplicate asset ids).
    """
    ep = episode_lag(lines).where(
        (F.col("gap_days") > 0) & (F.col("gap_days") <= params.max_gap_days) & (F.col("gap_km") > 0))
    ep = ep.join(assets.select("asset_id", *EPISODE_ASSET_COLS), "asset_id", "left")
    return (ep.withColumn("car_age", F.year("visit_date") - F.col("model_year"))
            .withColumn("log_gap_days", F.log(F.col("gap_days").cast("double")))
            .withColumn("utilization", F.col("gap_km") / F.col("interval_km")))


def raw_gap_by_segment(lines: DataFrame, assets: DataFrame) -> DataFrame:
    """Unfiltered mean gap (days) between consecutive anchor lines, per segment.

    The gaps of an asset telescope: their sum is last - first date and their
    number is lines - 1, so no window (and no per-asset sort) is needed.
    """
    per_asset = (lines.where(F.col("is_anchor") & F.col("asset_id").isNotNull() & F.col("visit_date").isNotNull())
                 .groupBy("asset_id")
                 .agg(F.datediff(F.max("visit_date"), F.min("visit_date")).alias("span"),
                      (F.count(F.lit(1)) - 1).alias("gaps")))
    joined = per_asset.join(assets.select("asset_id", "segment"), "asset_id", "inner")
    return (joined.groupBy("segment")
            .agg(F.sum("gaps").alias("n_gaps"), F.sum("span").alias("_span"))
            .select("segment", "n_gaps",
                    F.try_divide(F.col("_span").cast("double"), F.col("n_gaps").cast("double")).alias("avg_gap_days")))


def open_intervals(lines: DataFrame, assets: DataFrame, params: Params) -> DataFrame:
    """Right-censored intervals (event = 0): from each asset's last anchor visit to the as-of
    date, with the km estimated from the asset's monthly distance (option of the AFT model)."""
    from servicelens.operators.alerts import last_anchor
    from servicelens.sources.csv_source import as_of_date

    as_of = as_of_date(lines, params)
    la = last_anchor(lines).join(assets.select("asset_id", *EPISODE_ASSET_COLS), "asset_id", "left")
    days = F.datediff(as_of, F.col("last_anchor_date"))
    return (la.where(days > 0)
            .select("asset_id", F.col("last_anchor_visit_id").alias("visit_id"), *EPISODE_ASSET_COLS,
                    days.alias("gap_days"),
                    (days * F.col("km_per_month") / F.lit(30.0)).alias("gap_km"),
                    F.lit(0).alias("event"),
                    (F.year(as_of) - F.col("model_year")).alias("car_age"))
            .withColumn("log_gap_days", F.log(F.col("gap_days").cast("double")))
            .withColumn("utilization", F.col("gap_km") / F.col("interval_km")))
