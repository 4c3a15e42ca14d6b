"""Identities that must hold between result tables."""

import __spark_entry__ as E
from tests.conftest import SF0001


def _q(spark, name):
    return E.queries()[name](spark, SF0001)


def test_revenue_totals_agree(spark):
    k = _q(spark, "kpi_summary").first()
    cat = _q(spark, "revenue_by_category").collect()
    item = _q(spark, "revenue_by_item").collect()
    assert abs(sum(r.revenue for r in cat) - k.total_revenue) < 1e-3
    assert abs(sum(r.revenue for r in item) - k.total_revenue) < 1e-3
    assert abs(sum(r.revenue_share for r in cat) - 1.0) < 1e-9
    assert sum(r.rows for r in cat) == k.service_item_rows


def test_tiers_partition_assets(spark):
    tiers = _q(spark, "tier_distribution").collect()
    assert [r.alert_tier for r in tiers] == ["Critical", "High Priority", "Warm Reminder", "Monitor"]
    assert sum(r.assets for r in tiers) == _q(spark, "asset_master").count()


def test_rule_identities(spark):
    for r in _q(spark, "pairwise_rules").collect():
        assert r.potential_visits_without_consequent == r.antecedent_visits - r.cooccurrence_visits
        assert abs(r.confidence - r.cooccurrence_visits / r.antecedent_visits) < 1e-12


def test_episode_counts_add_up(spark):
    seg = _q(spark, "interval_by_segment").collect()
    assert sum(r.n_episodes for r in seg) == _q(spark, "episodes").count()


def test_value_quartiles_balanced(spark):
    rows = _q(spark, "value_segment").groupBy("value_quartile").count().collect()
    sizes = sorted(r["count"] for r in rows)
    assert sizes[-1] - sizes[0] <= 1
