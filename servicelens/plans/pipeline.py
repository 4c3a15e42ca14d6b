"""Full run: build every result table from the canonical views and write them.

The intermediate frames reused by several tables (lines, visits, episodes,
alerts, customers) are persisted once; each output is one write action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from servicelens.operators import alerts, audit, basket, decisions, demand, episodes, interval, kpi, segments, value
from servicelens.operators import visits as visits_op
from servicelens.params import Params
from servicelens.sources.sinks import write_tables


def build_tables(lines: DataFrame, assets: DataFrame, params: Params, with_models: bool = True) -> dict[str, DataFrame]:
    lines = lines.persist(StorageLevel.MEMORY_AND_DISK)
    v = visits_op.build_visits(lines, assets).persist(StorageLevel.MEMORY_AND_DISK)
    ep = episodes.build_episodes(lines, assets, params).persist(StorageLevel.MEMORY_AND_DISK)
    gaps, gap_col, coef = ep, "gap_days", None
    if with_models:  # as in the reference, alerts and segment intervals come from the survival model's medians
        gaps, coef, fit = interval.weibull_aft(ep, params)
        gap_col = "pred_gap_days"
    al = alerts.score_alerts(lines, assets, gaps, params, interval_col=gap_col).persist(StorageLevel.MEMORY_AND_DISK)
    cust = value.value_segment(value.value_score(value.customer_rollup(v, lines, params)))
    pair_rules = basket.pairwise_rules(lines, params)
    rules = basket.association_rules(lines, params)
    weekly = demand.weekly_demand(v)
    split = demand.time_split(demand.lag_features(weekly, params))
    k = kpi.kpi_summary(lines, assets)
    out = {
        "kpi_summary": k,
        "kpi_long": kpi.kpi_long(lines, assets),
        "audit_checks": audit.audit_checks(lines, assets),
        "audit_status": audit.audit_status(lines, assets, params),
        "revenue_by_category": kpi.revenue_by_category(lines),
        "revenue_by_item": kpi.revenue_by_item(lines),
        "interval_by_segment": interval.interval_by_segment(gaps, params, scored=with_models),
        "due_alert_candidates": alerts.rank_alerts(al),
        "tier_distribution": alerts.tier_distribution(al),
        "market_basket_rules": rules,
        "top_rules": basket.top_rules(rules),
        "attach_rates": basket.attach_rates_full(lines),
        "naive_backtest": demand.naive_backtest(split),
        "customer_value_risk": cust,
        "uplift_scenarios": decisions.uplift_scenarios(al, k.select("avg_order_value").scalar()),
        "topn_uplift": decisions.topn_uplift(al, v, params),
        "next_best_offer": decisions.next_best_offer(al, alerts.last_anchor(lines), basket.baskets(lines), pair_rules),
        "campaign_target_list": decisions.campaign_target_list(al, cust),
    }
    naive_fc = demand.recursive_forecast(weekly, params, None)
    out["capacity_schedule"] = decisions.capacity_schedule(al, naive_fc, params)
    if with_models:
        bt = demand.gbt_backtest(split, params)
        model = demand.fit_gbt(split, params)
        out["forecast_backtest"] = bt
        out["weekly_demand_forecast"] = demand.prediction_interval(demand.recursive_forecast(weekly, params, model), bt)
        out["interval_model_coefficients"] = coef
        feats = segments.feature_table(assets, v, ep)
        best_k, sil, _, labelled = segments.cluster_run(feats, params)
        out["cluster_profile"] = segments.group_profile(labelled, "cluster_id", sil)
        out["cluster_confusion"] = segments.cluster_crosstab(labelled)
        mape = bt.select(F.first("mape_model").alias("mape_model"), F.first("mape_naive").alias("mape_naive"))
        out["model_summary"] = mape.select(
            F.lit(fit["method"]).alias("interval_model_method"), F.lit(fit["n_episodes"]).alias("n_episodes"),
            F.lit(fit["r2_log_duration"]).alias("r2_log_duration"), "mape_model", "mape_naive",
            F.lit(best_k).alias("clusters"))
    else:
        out["weekly_demand_forecast"] = naive_fc
    return out


def run(spark: SparkSession, lines: DataFrame, assets: DataFrame, params: Params, out_dir: str,
        fmt: str = "parquet", with_models: bool = True) -> dict[str, str]:
    """Build and write all tables; returns name -> path."""
    return write_tables(build_tables(lines, assets, params, with_models), out_dir, fmt)
