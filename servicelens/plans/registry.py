"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the star tables through ``StarViews`` and asks only for
the columns it needs, so the unused lookups never enter the plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelens.operators import kpi, visits as visits_op
from servicelens.plans.common import present, views

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


VISIT_COLS = ("line_id", "visit_id", "asset_id", "visit_date", "meter_km", "branch", "technician",
              "item", "price", "is_anchor")


# ---------------------------------------------------------------- sources
@query("asset_master")
def q_asset_master(spark, d):
    """The asset master built from the customer table."""
    return views(spark, d).assets()


@query("service_lines")
def q_service_lines(spark, d):
    """Canonical service lines (all lookups)."""
    return views(spark, d).lines()


# ---------------------------------------------------------------- visits
@query("visit_rollup")
def q_visit_rollup(spark, d):
    """V1-V6: one row per visit with master columns and week labels."""
    sv = views(spark, d)
    v = visits_op.build_visits(sv.lines(*VISIT_COLS), sv.assets().select("asset_id", "customer_id", "segment"))
    return v.select("visit_id", "asset_id", "visit_date", "meter_km", "branch", "technician", "visit_revenue",
                    "items", "has_anchor", "n_items", "customer_id", "segment", "year_month", "week_start",
                    "week_label")


# ---------------------------------------------------------------- KPI
@query("kpi_summary")
def q_kpi_summary(spark, d):
    """K1: the one-row KPI summary."""
    sv = views(spark, d)
    return kpi.kpi_summary(sv.lines("visit_id", "visit_date", "price", "is_anchor"), sv.assets())


@query("kpi_long")
def q_kpi_long(spark, d):
    """K2: KPI summary as metric/value rows."""
    sv = views(spark, d)
    return kpi.kpi_long(sv.lines("visit_id", "visit_date", "price", "is_anchor"), sv.assets())


@query("revenue_by_category")
def q_revenue_by_category(spark, d):
    """K3: revenue by category."""
    return kpi.revenue_by_category(views(spark, d).lines("line_id", "visit_id", "category", "price"))


@query("revenue_by_item")
def q_revenue_by_item(spark, d):
    """Revenue and mean price by item."""
    return kpi.revenue_by_item(views(spark, d).lines("line_id", "visit_id", "item", "price"))


@query("dataset_summary")
def q_dataset_summary(spark, d):
    """Dataset summary."""
    sv = views(spark, d)
    return kpi.dataset_summary(sv.lines("visit_id", "visit_date", "price"), sv.assets())


@query("segment_distribution")
def q_segment_distribution(spark, d):
    """Assets per segment."""
    return kpi.segment_distribution(views(spark, d).assets())


@query("top_items")
def q_top_items(spark, d):
    """Top 10 items by line count."""
    return kpi.top_items(views(spark, d).lines("item"))


# ---------------------------------------------------------------- audit
from servicelens.operators import audit  # noqa: E402


@query("audit_checks")
def q_audit_checks(spark, d):
    """Q1-Q9: the 14-row audit."""
    sv = views(spark, d)
    return audit.audit_checks(sv.lines("line_id", "visit_id", "asset_id", "visit_date", "price"), sv.assets())


@query("audit_status")
def q_audit_status(spark, d):
    """Q10-Q15: PASS/FAIL audit."""
    sv = views(spark, d)
    return audit.audit_status(sv.lines(), sv.assets(), sv.params, sv.line_tasks())


@query("amount_contract")
def q_amount_contract(spark, d):
    """Q: prices that exact sums leave out or round."""
    return audit.amount_contract(views(spark, d).lines("price"))


# ---------------------------------------------------------------- episodes
from servicelens.functions.exprs import r6  # noqa: E402
from servicelens.operators import alerts, episodes  # noqa: E402
from servicelens.sources import csv_source  # noqa: E402

EPISODE_LINE_COLS = ("line_id", "visit_id", "asset_id", "visit_date", "meter_km", "branch", "technician", "price",
                     "is_anchor")


def _anchors(sv):
    """The anchor lines: all that episodes, last anchors and alerts need of the fact table, for queries that use several of these."""
    return sv.shared("anchors", lambda: sv.lines(*EPISODE_LINE_COLS).where("is_anchor"))


def _as_of(sv):
    return csv_source.as_of_date(sv.lines("visit_date"), sv.params)


def _episodes(sv, lines=None):
    return episodes.build_episodes(sv.lines(*EPISODE_LINE_COLS) if lines is None else lines, sv.assets(), sv.params)


@query("anchor_lines")
def q_anchor_lines(spark, d):
    """First anchor line per visit."""
    return episodes.anchor_lines(views(spark, d).lines(*EPISODE_LINE_COLS))


@query("episode_lag")
def q_episode_lag(spark, d):
    """Previous anchor visit per asset and the gaps (all anchor visits)."""
    return episodes.episode_lag(views(spark, d).lines(*EPISODE_LINE_COLS))


@query("episodes")
def q_episodes(spark, d):
    """Valid episodes with model features."""
    e = _episodes(views(spark, d))
    return e.withColumn("log_gap_days", r6(F.col("log_gap_days")))


@query("raw_gap_by_segment")
def q_raw_gap_by_segment(spark, d):
    """Unfiltered mean anchor gap per segment."""
    sv = views(spark, d)
    return episodes.raw_gap_by_segment(sv.lines("asset_id", "visit_date", "category", "is_anchor"), sv.assets())


# ---------------------------------------------------------------- alerts
def _alerts(sv):
    anchors = _anchors(sv)
    return alerts.score_alerts(anchors, sv.assets(), _episodes(sv, anchors), sv.params, as_of=_as_of(sv))


@query("last_anchor")
def q_last_anchor(spark, d):
    """A1: latest anchor line per asset."""
    return alerts.last_anchor(views(spark, d).lines(*EPISODE_LINE_COLS))


@query("alert_ranking")
def q_alert_ranking(spark, d):
    """A2-A10: due-alert table ranked by priority (segment medians of actual gaps)."""
    a = alerts.rank_alerts(_alerts(views(spark, d)))
    return a.withColumn("due_probability", r6(F.col("due_probability"))) \
            .withColumn("priority_score", r6(F.col("priority_score")))


@query("tier_distribution")
def q_tier_distribution(spark, d):
    """Assets per alert tier."""
    return alerts.tier_distribution(_alerts(views(spark, d)))


# ---------------------------------------------------------------- basket
from servicelens.operators import basket, itemsets  # noqa: E402

BASKET_COLS = ("visit_id", "item", "price", "category", "is_anchor")


@query("baskets")
def q_baskets(spark, d):
    """B1: distinct items per visit."""
    return basket.baskets(views(spark, d).lines("visit_id", "item"))


@query("frequent_itemsets")
def q_frequent_itemsets(spark, d):
    """FP-Growth frequent itemsets."""
    return basket.frequent_itemsets(views(spark, d).lines("visit_id", "item"), views(spark, d).params)


@query("weighted_itemsets")
def q_weighted_itemsets(spark, d):
    """B3 on weighted patterns: the same itemsets, each distinct basket counted once."""
    return itemsets.weighted_itemsets(views(spark, d).lines("visit_id", "item"), views(spark, d).params)


@query("association_rules")
def q_association_rules(spark, d):
    """Rules from every proper subset of the frequent itemsets."""
    sv = views(spark, d)
    return basket.association_rules(sv.lines("visit_id", "item", "price"), sv.params)


@query("pairwise_rules")
def q_pairwise_rules(spark, d):
    """Single-item rules from pattern-aggregated pair counts."""
    sv = views(spark, d)
    return basket.pairwise_rules(sv.lines("visit_id", "item", "price"), sv.params)


@query("top_rules")
def q_top_rules(spark, d):
    """B2: top 10 rules of the mined rule table by estimated revenue."""
    sv = views(spark, d)
    return basket.top_rules(basket.association_rules(sv.lines("visit_id", "item", "price"), sv.params))


@query("top_pair_rules")
def q_top_pair_rules(spark, d):
    """B2 on single-item rules: top 10 by estimated revenue."""
    sv = views(spark, d)
    return basket.top_rules(basket.pairwise_rules(sv.lines("visit_id", "item", "price"), sv.params))


@query("item_price_stats")
def q_item_price_stats(spark, d):
    """Mean price per item."""
    return basket.item_prices(views(spark, d).lines("item", "price"))


@query("attach_rates")
def q_attach_rates(spark, d):
    """Attach rates of other items within anchor visits."""
    sv = views(spark, d)
    return basket.attach_rates(sv.lines(*BASKET_COLS), sv.line_tasks())


@query("attach_rates_full")
def q_attach_rates_full(spark, d):
    """Attach rates with zero rows kept."""
    sv = views(spark, d)
    return basket.attach_rates_full(sv.lines(*BASKET_COLS), sv.line_tasks())


@query("conditional_item_rate")
def q_conditional_item_rate(spark, d):
    """P(item | anchor visit) for probe items."""
    sv = views(spark, d)
    return basket.conditional_item_rate(sv.lines(*BASKET_COLS), sv.params, sv.line_tasks())


# ---------------------------------------------------------------- demand
from servicelens.operators import demand, exog_ar, series_boost  # noqa: E402


WEEKLY_COLS = ("visit_id", "visit_date", "price", "is_anchor")


def _weekly(sv, series_cols=()):
    """The weekly series from the columns it needs: the global one joins neither supplier, nation nor customer."""
    extra = ("line_id", "branch", "technician", "category") if series_cols else ()
    return demand.weekly_demand(visits_op.visit_totals(sv.lines(*WEEKLY_COLS, *extra), series_cols), series_cols)


def _split(sv, series_cols=()):
    return demand.time_split(demand.lag_features(_weekly(sv, series_cols), sv.params))


@query("weekly_demand")
def q_weekly_demand(spark, d):
    """F1-F2: dense weekly series labelled by closing Monday."""
    return _weekly(views(spark, d))


@query("branch_weekly_demand")
def q_branch_weekly_demand(spark, d):
    """the weekly series per branch."""
    return _weekly(views(spark, d), ["branch"])


@query("category_weekly_demand")
def q_category_weekly_demand(spark, d):
    """the weekly series per category (of the visit's first line)."""
    return _weekly(views(spark, d), ["category"])


@query("calendar_features")
def q_calendar_features(spark, d):
    """Calendar and holiday flags per week."""
    sv = views(spark, d)
    return demand.calendar_features(_weekly(sv), sv.params)


@query("lag_features")
def q_lag_features(spark, d):
    """Supervised frame with lags, trailing means and the test flag."""
    return _split(views(spark, d)).drop("revenue")


@query("naive_backtest")
def q_naive_backtest(spark, d):
    """Baseline backtest with MAPE."""
    b = demand.naive_backtest(_split(views(spark, d)))
    return b.withColumn("mape_naive", r6(F.col("mape_naive")))


@query("recursive_forecast_naive")
def q_recursive_forecast_naive(spark, d):
    """F13-F14 with the baseline predictor: 8-week recursive forecast and translation."""
    sv = views(spark, d)
    return demand.recursive_forecast(_weekly(sv), sv.params, None)


@query("gbt_backtest")
def q_gbt_backtest(spark, d):
    """Gradient-boosted trees backtest (rows-only check)."""
    sv = views(spark, d)
    return demand.gbt_backtest(_split(sv), sv.params)


@query("backtest_by_model")
def q_backtest_by_model(spark, d):
    """F16: MAPE per model: baseline, boosted trees, calendar regression (rows-only check)."""
    sv = views(spark, d)
    split = _split(sv)
    other = exog_ar.mape_rows(exog_ar.exog_ar_backtest(split)).where(F.col("model") == exog_ar.METHOD_EXOG)
    return demand.backtest_by_model(demand.gbt_backtest(split, sv.params)).unionByName(other)


@query("exog_ar_backtest")
def q_exog_ar_backtest(spark, d):
    """F16: backtest of the calendar regression with autoregressive errors, per branch."""
    sv = views(spark, d)
    b = exog_ar.exog_ar_backtest(_split(sv, ["branch"]))
    return b.select("series", "week", "actual_visits", "pred_visits_exog",
                    *[r6(F.col(c)).alias(c) for c in ("pred_exog_raw", "mape_exog", "mape_naive")])


@query("exog_ar_mape")
def q_exog_ar_mape(spark, d):
    """F16: one MAPE row per model of the global series, for the models that SQL can follow."""
    sv = views(spark, d)
    return exog_ar.mape_rows(exog_ar.exog_ar_backtest(_split(sv))).withColumn("test_mape", r6(F.col("test_mape")))


@query("branch_boost_backtest")
def q_branch_boost_backtest(spark, d):
    """one boosted model a branch, backtest with simulated bands (rows-only)."""
    sv = views(spark, d)
    return series_boost.boost_backtest(_weekly(sv, ["branch"]), sv.params)


@query("branch_boost_forecast")
def q_branch_boost_forecast(spark, d):
    """Recursive forecast of each branch by its own model, with simulated bands (rows-only)."""
    sv = views(spark, d)
    return series_boost.boost_forecast(_weekly(sv, ["branch"]), sv.params)


@query("recursive_forecast_gbt")
def q_recursive_forecast_gbt(spark, d):
    """GBT refit on all weeks, recursive forecast with a 95% band (rows-only)."""
    sv = views(spark, d)
    split = _split(sv)
    bt = demand.gbt_backtest(split, sv.params)
    model = demand.fit_gbt(split, sv.params)
    return demand.prediction_interval(demand.recursive_forecast(_weekly(sv), sv.params, model), bt)


# ---------------------------------------------------------------- customer value
from servicelens.operators import value  # noqa: E402

ASSET_OWNER_COLS = ("asset_id", "customer_id", "owner_name", "phone", "segment")


def _visits_full(sv):
    return visits_op.build_visits(sv.lines(*VISIT_COLS), sv.assets())


def _customers(sv):
    return value.customer_rollup(_visits_full(sv), sv.lines("visit_date"), sv.params)


def _shared_customers(sv):
    """The rollup for queries that rank it and join the ranks back."""
    return sv.shared("customers", lambda: _customers(sv))


@query("customer_rollup")
def q_customer_rollup(spark, d):
    """Per-owner rollup, recency, tenure, annualised revenue, risk."""
    return _customers(views(spark, d))


@query("value_score")
def q_value_score(spark, d):
    """Percentile value score and reactivation priority."""
    v = value.value_score(_shared_customers(views(spark, d))).orderBy(F.desc_nulls_last("priority_reactivation_score"), "customer_id")
    return v.select("customer_id", "annualized_revenue", "recency_risk", "value_score", "risk_score",
                    "priority_reactivation_score")


@query("value_segment")
def q_value_segment(spark, d):
    """Revenue quartiles and action policy."""
    v = value.value_segment(_customers(views(spark, d)))
    return v.select("customer_id", "revenue", "recency_risk", "value_quartile", "value_segment", "action")


# ---------------------------------------------------------------- segmentation
from servicelens.operators import segments  # noqa: E402


def _features(sv):
    return segments.feature_table(sv.assets(), visits_op.visit_rollup(sv.lines(*VISIT_COLS)), _episodes(sv))


@query("car_activity")
def q_car_activity(spark, d):
    """Per-asset activity, annualised rates and gap means."""
    sv = views(spark, d)
    a = segments.car_activity(visits_op.visit_rollup(sv.lines(*VISIT_COLS)))
    g = segments.gap_means(_episodes(sv))
    return a.join(g, "asset_id", "left")


@query("car_features")
def q_car_features(spark, d):
    """C4: the clustering feature table."""
    f = _features(views(spark, d))
    return f.select("asset_id", "segment", *segments.FILL_ZERO, *[f"x_{c}" for c in segments.X_COLS])


@query("standardized_features")
def q_standardized_features(spark, d):
    """Z-scores of the clustering inputs (population sd)."""
    sv = views(spark, d)
    z = segments.standardized(sv.shared("features", lambda: _features(sv)))
    return z.select("asset_id", *[r6(F.col(f"z_{c}")).alias(f"z_{c}") for c in segments.X_COLS])


@query("segment_profile")
def q_segment_profile(spark, d):
    """C8-C9 grouped by the hidden usage segment (deterministic profile)."""
    p = segments.group_profile(_features(views(spark, d)), "segment")
    return p.select("segment", "assets", *[r6(F.col(c)).alias(c) for c in
                                           ("avg_km_per_month", "avg_visits_per_year", "avg_revenue_per_year",
                                            "avg_gap_days", "avg_anchor_visits")], "top_segment")


@query("choose_k")
def q_choose_k(spark, d):
    """Silhouette per k (rows-only)."""
    sv = views(spark, d)
    return segments.cluster_run(_features(sv), sv.params)[2]


def _clusters(sv):
    return segments.cluster_run(_features(sv), sv.params)[3]


def _by_modulus(sv):
    """Features with a given label instead of a fitted one, so that SQL can follow the tables made from labels."""
    return _features(sv).withColumn("cluster_id", (F.col("asset_id") % 3).cast("int"))


@query("crosstab_given_labels")
def q_crosstab_given_labels(spark, d):
    """C10 on given labels: group x segment row shares, zero cells included."""
    return segments.cluster_crosstab(_by_modulus(views(spark, d))).withColumn("share", r6(F.col("share")))


@query("segment_counts_given_labels")
def q_segment_counts_given_labels(spark, d):
    """C11 on given labels: segment x group counts."""
    return segments.segment_crosstab(_by_modulus(views(spark, d)))


@query("profile_given_labels")
def q_profile_given_labels(spark, d):
    """C8-C9 on given labels: group means and the dominant segment of each group."""
    p = segments.group_profile(_by_modulus(views(spark, d)), "cluster_id", silhouette=0.5)
    return p.select("cluster_id", "assets", *[r6(F.col(c)).alias(c) for c in
                                              ("avg_km_per_month", "avg_visits_per_year", "avg_revenue_per_year",
                                               "avg_gap_days", "avg_anchor_visits")], "top_segment", "silhouette")


@query("final_clusters")
def q_final_clusters(spark, d):
    """Cluster label per asset (rows-only)."""
    return _clusters(views(spark, d)).select("asset_id", "segment", "cluster_id")


@query("cluster_profile")
def q_cluster_profile(spark, d):
    """Profile per K-Means cluster (rows-only)."""
    sv = views(spark, d)
    _, silhouette, _, labelled = segments.cluster_run(_features(sv), sv.params)
    return segments.group_profile(labelled, "cluster_id", silhouette)


@query("cluster_crosstab")
def q_cluster_crosstab(spark, d):
    """Cluster x segment row shares (rows-only)."""
    return segments.cluster_crosstab(_clusters(views(spark, d)))


@query("segment_crosstab")
def q_segment_crosstab(spark, d):
    """C11: segment x cluster counts (rows-only)."""
    return segments.segment_crosstab(_clusters(views(spark, d)))


# ---------------------------------------------------------------- interval models
import uuid  # noqa: E402

from servicelens.functions import sketch  # noqa: E402
from servicelens.operators import asset_history, interval  # noqa: E402
from servicelens.session import ensure_checkpoint_dir  # noqa: E402
from servicelens.sources import bucketed  # noqa: E402


@query("training_frame")
def q_training_frame(spark, d):
    """M1: complete-case episodes for the interval models."""
    t = interval.training_frame(_episodes(views(spark, d)))
    return t.select("asset_id", "visit_id", "gap_days", "gap_km", *interval.NUM_COLS[:3], *interval.CAT_COLS)


@query("interval_by_segment")
def q_interval_by_segment(spark, d):
    """M9: gap statistics per segment (actual gaps)."""
    sv = views(spark, d)
    t = interval.interval_by_segment(_episodes(sv), sv.params)
    return t.withColumn("avg_utilization", r6(F.col("avg_utilization")))


@query("interval_sketch_by_segment")
def q_interval_sketch_by_segment(spark, d):
    """M9 on stored sketches: daily sketches of the gaps, in folders by month, merged by segment, beside the exact median."""
    sv = views(spark, d)
    ep = sv.shared("episodes", lambda: _episodes(sv).where(F.col("segment").isNotNull()).select("segment", "visit_date", "gap_days"))
    days = sketch.sketch(ep.withColumn("month", F.trunc("visit_date", "month")), ["segment", "month", "visit_date"], "gap_days")
    days = sketch.store(days, "month", f"{ensure_checkpoint_dir(spark)}/sketch_{uuid.uuid4().hex}")
    got = sketch.quantiles(sketch.merged(days, ["segment"]), ["segment"], {"sketch_median": 0.5, "sketch_p90": 0.9})
    exact = ep.groupBy("segment").agg(F.median("gap_days").alias("exact_median"))
    return (got.join(exact, "segment")
            .withColumn("within_bound", F.abs(F.col("sketch_median") - F.col("exact_median")) <= 0.01 * F.col("exact_median") + 1e-9)
            .withColumns({c: r6(F.col(c)) for c in ("sketch_median", "sketch_p90")}))


@query("asset_history_bucketed")
def q_asset_history_bucketed(spark, d):
    """S8 co-partitioned: visits, episodes and assets written by bucket of the asset, then grouped and joined in place."""
    sv = views(spark, d)
    t = bucketed.write_bucketed
    v = t(visits_op.visit_rollup(sv.lines(*VISIT_COLS)).select("asset_id", "visit_id", "visit_date", "visit_revenue"), "asset_id", 8)
    e = t(_episodes(sv).select("asset_id", "visit_id", "gap_days"), "asset_id", 8)
    a = t(sv.assets().select("asset_id", "segment"), "asset_id", 8)
    return asset_history.asset_history(a, v, e)


@query("scored_episodes")
def q_scored_episodes(spark, d):
    """M3 with the closed-form prediction: predicted gap per episode."""
    s = interval.trend_scored(_episodes(views(spark, d)))
    return s.select("asset_id", "visit_id", "segment", "gap_days", r6(F.col("pred_gap_days")).alias("pred_gap_days"))


@query("interval_by_segment_scored")
def q_interval_by_segment_scored(spark, d):
    """M9 with predictions: gap statistics per segment and the mean predicted gap."""
    sv = views(spark, d)
    t = interval.interval_by_segment(interval.trend_scored(_episodes(sv)), sv.params, scored=True)
    return t.withColumn("avg_utilization", r6(F.col("avg_utilization"))) \
            .withColumn("avg_pred_gap_days", r6(F.col("avg_pred_gap_days")))


@query("alert_ranking_predicted")
def q_alert_ranking_predicted(spark, d):
    """A4 on predicted gaps (the reference's default), here of the closed-form prediction."""
    sv = views(spark, d)
    scored = interval.trend_scored(_episodes(sv, _anchors(sv)))
    a = alerts.score_alerts(_anchors(sv), sv.assets(), scored, sv.params, interval_col="pred_gap_days", as_of=_as_of(sv))
    return alerts.rank_alerts(a.select(
        "asset_id", "segment", "days_since_last_anchor", r6(F.col("predicted_interval_days")).alias("predicted_interval_days"),
        r6(F.col("progress_day")).alias("progress_day"), r6(F.col("due_probability")).alias("due_probability"),
        r6(F.col("priority_score")).alias("priority_score"), "alert_tier", "progress_km")).drop("progress_km")


@query("alert_ranking_aft")
def q_alert_ranking_aft(spark, d):
    """A2-A10 fed by the Weibull AFT medians, as the reference runs it (rows-only)."""
    sv = views(spark, d)
    scored, _, _ = interval.weibull_aft(_episodes(sv), sv.params)
    return alerts.rank_alerts(alerts.score_alerts(_anchors(sv), sv.assets(), scored, sv.params,
                                                  interval_col="pred_gap_days", as_of=_as_of(sv)))


@query("aft_scored_episodes")
def q_aft_scored_episodes(spark, d):
    """M3, M8: predicted median per episode and the fit's R² of log duration (rows-only)."""
    sv = views(spark, d)
    scored, _, s = interval.weibull_aft(_episodes(sv), sv.params)
    return scored.select("asset_id", "visit_id", "gap_days", "pred_gap_days", F.lit(s["r2_log_duration"]).alias("r2_log_duration"))


@query("aft_given_coefficients")
def q_aft_given_coefficients(spark, d):
    """M3 on given coefficients: median gap per training episode."""
    s = interval.aft_given(_episodes(views(spark, d)))
    return s.select("asset_id", "visit_id", r6(F.col("pred_gap_days")).alias("pred_gap_days"))


@query("alert_ranking_aft_given")
def q_alert_ranking_aft_given(spark, d):
    """A4 on the medians of given coefficients: the table that alert_ranking_aft makes of a fit."""
    sv = views(spark, d)
    scored = interval.aft_given(_episodes(sv, _anchors(sv)))
    a = alerts.score_alerts(_anchors(sv), sv.assets(), scored, sv.params, interval_col="pred_gap_days", as_of=_as_of(sv))
    return alerts.tier_distribution(a)


@query("log_gap_trend")
def q_log_gap_trend(spark, d):
    """M5 (single covariate): per segment regression of log gap on log km/month."""
    e = _episodes(views(spark, d)).withColumn("x", F.log("km_per_month"))
    g = e.groupBy("segment").agg(F.regr_count("log_gap_days", "x").alias("n"),
                                 F.regr_slope("log_gap_days", "x").alias("slope"),
                                 F.regr_intercept("log_gap_days", "x").alias("intercept"),
                                 F.regr_r2("log_gap_days", "x").alias("r2"))
    return g.select("segment", "n", *[r6(F.col(c)).alias(c) for c in ("slope", "intercept", "r2")])


@query("log_ols_coefficients")
def q_log_ols_coefficients(spark, d):
    """M5: log-normal OLS coefficients with direction and p-value (rows-only)."""
    sv = views(spark, d)
    return interval.log_ols(_episodes(sv), sv.params)[1]


@query("weibull_aft")
def q_weibull_aft(spark, d):
    """M2-M4: ridge Weibull AFT coefficients with standard errors, z and p (rows-only)."""
    sv = views(spark, d)
    return interval.weibull_aft(_episodes(sv), sv.params)[1]


@query("gbt_interval")
def q_gbt_interval(spark, d):
    """M6-M7: GBT interval model feature importances (rows-only)."""
    sv = views(spark, d)
    return interval.gbt_interval(_episodes(sv), sv.params)[1]


@query("model_summary")
def q_model_summary(spark, d):
    """Interval model fit and forecast backtest summary (rows-only)."""
    sv = views(spark, d)
    _, _, s = interval.log_ols(_episodes(sv), sv.params)
    bt = demand.gbt_backtest(_split(sv), sv.params)
    m = bt.select(F.first("mape_model").alias("mape_model"), F.first("mape_naive").alias("mape_naive"))
    lines = sv.lines("visit_date")
    from servicelens.sources.csv_source import as_of_date
    return m.select(F.lit(s["method"]).alias("interval_model_method"), F.lit(s["n_episodes"]).alias("n_episodes"),
                    F.lit(s["r2"]).alias("r2"), F.lit(s["r2_adj"]).alias("r2_adj"),
                    F.lit(s["residual_sigma"]).alias("residual_sigma"),
                    F.lit(s["median_actual_gap_days"]).alias("median_actual_gap_days"),
                    F.lit(s["median_predicted_gap_days"]).alias("median_predicted_gap_days"),
                    "mape_model", "mape_naive", as_of_date(lines, sv.params).alias("as_of"))


# ---------------------------------------------------------------- decisions
from servicelens.operators import decisions  # noqa: E402


@query("uplift_scenarios")
def q_uplift_scenarios(spark, d):
    """Three conversion scenarios over the targetable assets."""
    sv = views(spark, d)
    aov = kpi.kpi_summary(sv.lines("visit_id", "visit_date", "price", "is_anchor"), sv.assets()) \
             .select("avg_order_value").scalar()
    return decisions.uplift_scenarios(_alerts(sv), aov)


@query("topn_uplift")
def q_topn_uplift(spark, d):
    """Top-N reminder scenarios x conversion x mean anchor-visit value."""
    sv = views(spark, d)
    return decisions.topn_uplift(_alerts(sv), visits_op.visit_rollup(sv.lines(*VISIT_COLS)), sv.params)


@query("next_best_offer")
def q_next_best_offer(spark, d):
    """Next best offer per targeted asset from the pairwise rules."""
    sv = views(spark, d)
    rules = basket.pairwise_rules(sv.lines("visit_id", "item", "price"), sv.params)
    nbo = decisions.next_best_offer(_alerts(sv), alerts.last_anchor(_anchors(sv)),
                                    basket.baskets(sv.lines("visit_id", "item")), rules)
    return nbo.withColumn("priority_score", r6(F.col("priority_score")))


@query("campaign_target_list")
def q_campaign_target_list(spark, d):
    """D3: targeted alerts with the owner's value score and segment."""
    sv = views(spark, d)
    cust = value.value_segment(value.value_score(_shared_customers(sv)))
    t = decisions.campaign_target_list(_alerts(sv), cust)
    return t.select("asset_id", "customer_id", "alert_tier", "priority_score", "value_score", "value_segment", "action") \
            .withColumn("priority_score", r6(F.col("priority_score")))


@query("capacity_schedule")
def q_capacity_schedule(spark, d):
    """Ranked targets assigned to forecast weeks within the weekly headroom."""
    sv = views(spark, d)
    fc = demand.recursive_forecast(_weekly(sv), sv.params, None)
    s = decisions.capacity_schedule(_alerts(sv), fc, sv.params)
    return s.withColumn("priority_score", r6(F.col("priority_score")))


# ---------------------------------------------------------------- simulator rules, sources
from servicelens.functions import calendar as cal_fn  # noqa: E402
from servicelens.functions import rules as rules_fn  # noqa: E402


@query("classify_item")
def q_classify_item(spark, d):
    """G1: item-name rules applied to every distinct part name and item."""
    sv = views(spark, d)
    names = sv.table("part").select(F.col("p_name").alias("name")).union(
        sv.lines("item").select(F.col("item").alias("name"))).distinct()
    return names.select("name", rules_fn.classify_item(F.col("name")).alias("category"))


@query("interval_rule")
def q_interval_rule(spark, d):
    """Km interval rule per asset from fuel and oil type."""
    a = views(spark, d).assets()
    return a.select("asset_id", "fuel", "oil_type", rules_fn.interval_rule(F.col("fuel"), F.col("oil_type")).alias("rule_interval_km"))


@query("calendar_weight")
def q_calendar_weight(spark, d):
    """Demand weight of every service date."""
    sv = views(spark, d)
    days = sv.lines("visit_date").where(F.col("visit_date").isNotNull()).distinct()
    return days.select("visit_date", cal_fn.calendar_weight(F.col("visit_date"), sv.params.holidays).alias("weight"))


@query("calendar_coverage")
def q_calendar_coverage(spark, d):
    """G3/F4 audit: distinct service dates before, within and after the known moving holidays."""
    sv = views(spark, d)
    return cal_fn.calendar_coverage(sv.lines("visit_date").distinct(), "visit_date", sv.params.holidays)


@query("clean_lines")
def q_clean_lines(spark, d):
    """The lines as text, coerced back (bad values -> NULL, qty default 1)."""
    sv = views(spark, d)
    raw = sv.lines().select(*[F.col(c).cast("string").alias(c) for c in
                              ("line_id", "visit_id", "asset_id", "visit_date", "meter_km", "branch", "technician",
                               "category", "item", "qty", "price")])
    return csv_source.clean_lines(raw, sv.params)


@query("as_of_date")
def q_as_of_date(spark, d):
    """The as-of date (max service date + 1 day)."""
    sv = views(spark, d)
    lines = sv.lines("visit_date")
    return lines.agg(F.max("visit_date").alias("max_service_date")) \
                .select("max_service_date", csv_source.as_of_date(lines, sv.params).alias("as_of"))


@query("executive_summary")
def q_executive_summary(spark, d):
    """Headline numbers of the report (KPI, best rule, naive forecast totals, episodes)."""
    sv = views(spark, d)
    k = kpi.kpi_summary(sv.lines("visit_id", "visit_date", "price", "is_anchor"), sv.assets())
    rules = basket.pairwise_rules(sv.lines("visit_id", "item", "price"), sv.params)
    fc = demand.recursive_forecast(_weekly(sv), sv.params, None)
    return kpi.executive_summary(k, rules, fc, _episodes(sv))


from servicelens.operators import report  # noqa: E402


@query("executive_tables")
def q_executive_tables(spark, d):
    """The report's tables in long form (section, item, metric, value)."""
    sv = views(spark, d)
    rules = basket.association_rules(sv.lines("visit_id", "item", "price"), sv.params)
    # each of these feeds several tables: computed once
    k = sv.shared("kpi", lambda: kpi.kpi_summary(sv.lines(*WEEKLY_COLS), sv.assets()))
    ep = sv.shared("episodes_of_anchors", lambda: _episodes(sv, _anchors(sv)))
    as_of = csv_source.as_of_date(k.select(F.col("date_max").alias("visit_date")), sv.params)  # the latest of all lines
    due = alerts.score_alerts(_anchors(sv), sv.assets(), ep, sv.params, as_of=as_of)
    return report.executive_tables(
        kpi.kpi_rows(k), interval.interval_by_segment(ep, sv.params), basket.top_rules(rules, 1),
        demand.recursive_forecast(_weekly(sv), sv.params, None),
        decisions.uplift_scenarios(due, k.select("avg_order_value").scalar()))


@query("chart_data")
def q_chart_data(spark, d):
    """What the six charts draw; the cluster profile is of given labels, which SQL can follow."""
    sv = views(spark, d)
    rules = basket.association_rules(sv.lines("visit_id", "item", "price"), sv.params)
    c = report.chart_data(
        kpi.revenue_by_category(sv.lines("line_id", "visit_id", "category", "price")),
        interval.interval_by_segment(_episodes(sv), sv.params), basket.top_rules(rules),
        demand.recursive_forecast(_weekly(sv), sv.params, None), alerts.tier_distribution(_alerts(sv)),
        segments.group_profile(_by_modulus(sv), "cluster_id"), "cluster_id")
    return c.withColumn("value", r6(F.col("value")))


@query("weibull_aft_censored")
def q_weibull_aft_censored(spark, d):
    """M2 option: leak-free AFT with every asset's open interval as a censored row (rows-only)."""
    sv = views(spark, d)
    lines = sv.lines(*EPISODE_LINE_COLS)
    cens = episodes.open_intervals(lines, sv.assets(), sv.params)
    return interval.weibull_aft(_episodes(sv), sv.params, leak_free=True, censored=cens)[1]
