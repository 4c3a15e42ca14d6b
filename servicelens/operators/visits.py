"""V1-V6: the visit table (one row per visit)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.functions.exprs import closing_monday, first_in_line_order, money, week_start


def visit_rollup(lines: DataFrame) -> DataFrame:
    """V1-V3 in ONE aggregate over the lines (one shuffle on visit_id).

    Item lists are collected per visit: a visit's distinct items are bounded
    by the catalogue, not by the data size.
    """
    items = F.array_sort(F.collect_set("item"))
    return (
        lines.where(F.col("visit_id").isNotNull())
        .groupBy("visit_id")
        .agg(
            first_in_line_order("asset_id").alias("asset_id"),
            F.min("visit_date").alias("visit_date"),
            F.max("meter_km").alias("meter_km"),
            first_in_line_order("branch").alias("branch"),
            first_in_line_order("technician").alias("technician"),
            # kept decimal so that weekly / customer revenue sums stay exact
            F.sum(money("price")).alias("visit_revenue"),
            items.alias("items"),
            F.bool_or("is_anchor").alias("has_anchor"),
        )
        .withColumn("n_items", F.size("items"))
    )


def visit_totals(lines: DataFrame, first_cols: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Date, revenue and anchor flag per visit, and the first line's value of ``first_cols``.

    The part of ``visit_rollup`` that the weekly series needs; a narrow scan
    feeds it, without the lookups of the other columns.
    """
    return (
        lines.where(F.col("visit_id").isNotNull())
        .groupBy("visit_id")
        .agg(
            F.min("visit_date").alias("visit_date"),
            F.sum(money("price")).alias("visit_revenue"),
            F.bool_or("is_anchor").alias("has_anchor"),
            *[first_in_line_order(c).alias(c) for c in first_cols],
        )
    )


def build_visits(lines: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """V1-V6: rollup, left join of the asset master (V4), month and week labels."""
    v = visit_rollup(lines)
    if assets is not None:
        v = v.join(assets, "asset_id", "left")
    return (
        v.withColumn("year_month", F.date_format("visit_date", "yyyy-MM"))
        .withColumn("week_start", week_start("visit_date"))
        .withColumn("week_label", closing_monday("visit_date"))
    )
