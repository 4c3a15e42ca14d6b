"""The report's tables and the charts' data, in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_form(df: DataFrame, section: str, item: Column, values: list[str]) -> DataFrame:
    """(section, item, metric, value): one row for each value of each row."""
    cells = F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values])
    return df.select(F.lit(section).alias("section"), item.cast("string").alias("item"), F.inline(cells))


def stacked(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def executive_tables(kpi_long: DataFrame, intervals: DataFrame, best_rule: DataFrame, forecast: DataFrame,
                     uplift: DataFrame) -> DataFrame:
    """Headline KPIs, interval by segment, the best rule, the weekly forecast and the uplift scenarios."""
    return stacked([
        kpi_long.select(F.lit("kpi").alias("section"), F.lit("all").alias("item"), "metric", F.col("value").cast("double").alias("value")),
        long_form(intervals, "interval", F.col("segment"), ["n_episodes", "avg_gap_days", "avg_gap_km"]),
        long_form(best_rule, "best_rule", F.col("rule"), ["confidence", "lift", "estimated_rule_revenue"]),
        long_form(forecast, "forecast", F.col("week"), ["forecast_visits", "forecast_anchor_visits", "forecast_revenue"]),
        long_form(uplift, "uplift", F.col("scenario"),
                  ["targetable_assets", "incremental_visits", "incremental_service_revenue", "total_incremental_revenue"]),
    ])


def chart_data(by_category: DataFrame, intervals: DataFrame, rules: DataFrame, forecast: DataFrame, tiers: DataFrame,
               profile: DataFrame, group: str) -> DataFrame:
    """One section for each chart: its labels and the one value that it draws."""
    return stacked([
        long_form(by_category, "revenue_by_category", F.col("category"), ["revenue"]),
        long_form(intervals, "interval_by_segment", F.col("segment"), ["avg_gap_days"]),
        long_form(rules, "top_rules", F.col("rule"), ["estimated_rule_revenue"]),
        long_form(forecast, "weekly_forecast", F.col("week"), ["forecast_visits"]),
        long_form(tiers, "alert_tiers", F.col("alert_tier"), ["assets"]),
        long_form(profile, "profile", F.col(group), ["avg_revenue_per_year"]),
    ])
