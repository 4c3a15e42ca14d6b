"""Per-asset history from co-partitioned tables (see ``sources.bucketed``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.functions.exprs import money_sum


def asset_history(assets: DataFrame, visits: DataFrame, episodes: DataFrame) -> DataFrame:
    """(asset_id, segment, n_visits, revenue, last_visit, n_episodes, gap_days), one row an asset row.

    If all three tables are bucketed alike by ``asset_id``, sums and joins
    need no exchange. Assets without visits or episodes have zero of them and
    NULL sums; visits of a NULL or unknown asset are left out.
    """
    v = visits.groupBy("asset_id").agg(F.count(F.lit(1)).alias("n_visits"), money_sum("visit_revenue").alias("revenue"),
                                       F.max("visit_date").alias("last_visit"))
    e = episodes.groupBy("asset_id").agg(F.count(F.lit(1)).alias("n_episodes"), F.sum("gap_days").alias("gap_days"))
    return (assets.join(v, "asset_id", "left").join(e, "asset_id", "left")
            .select("asset_id", "segment", F.coalesce("n_visits", F.lit(0)).cast("long").alias("n_visits"), "revenue", "last_visit",
                    F.coalesce("n_episodes", F.lit(0)).cast("long").alias("n_episodes"), "gap_days"))
