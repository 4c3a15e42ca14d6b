"""Lines dealt out by their number, and inputs that several tables of one query share, on star tables made here."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from servicelens.operators import audit, basket, decisions, episodes, kpi
from servicelens.plans import registry
from servicelens.plans.common import views
from servicelens.sources import star


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("star"))
    day = lambda i: dt.date(1995, 1, 2) + dt.timedelta(days=i)
    made = {
        "nation": ([(i, f"N{i}") for i in range(3)], "n_nationkey int, n_name string"),
        "customer": ([(i, f"C {i}", i % 3, 100.0 * i, ("BUILDING", "MACHINERY")[i % 2]) for i in range(1, 21)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(i, f"S{i}", i % 3) for i in range(4)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(i, f"P{i}", f"Brand#{i % 5}", ("PROMO", "ECONOMY")[i % 2]) for i in range(10)],
                 "p_partkey long, p_name string, p_brand string, p_type string"),
        "orders": ([(i, 1 + i % 20, day(i * 3 % 700)) for i in range(300)], "o_orderkey long, o_custkey long, o_orderdate date"),
        "lineitem": ([(i if i % 50 else None, (i + 3 * n) % 10, i % 4, n, 1 + n, 10.0 + i % 7 + n) for i in range(300) for n in (0, 1, 1, 2)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity int, l_extendedprice double"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d


def rows(df):
    return sorted(map(repr, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_dealt_out_by_their_number(spark, tables, monkeypatch):
    assert views(spark, tables).line_tasks() == 1
    monkeypatch.setattr(star, "LINES_A_TASK", 100)
    assert views(spark, tables).line_tasks() == 12
    for name in ("attach_rates", "attach_rates_full", "conditional_item_rate", "audit_status"):
        assert ", 12), REPARTITION_BY_NUM" in plan(registry.QUERIES[name](spark, tables)), name


def test_dealt_out_lines_give_the_same_rows(spark, tables):
    sv = views(spark, tables)
    lines, few = sv.lines(), sv.lines(*registry.BASKET_COLS)
    assert rows(audit.audit_status(lines, sv.assets(), sv.params, 7)) == rows(audit.audit_status(lines, sv.assets(), sv.params))
    found = {r.check: r.value for r in audit.audit_status(lines, sv.assets(), sv.params, 7).collect()}
    everything = [tuple(r) for r in lines.collect()]
    assert found["exact_duplicate_rows"] == len(everything) - len(set(everything)) > 0 and found["missing_line_id"] == 24
    for f, more in ((basket.attach_rates, ()), (basket.attach_rates_full, ()), (basket.conditional_item_rate, (sv.params,))):
        got = rows(f(few, *more, tasks=7))
        assert got and got == rows(f(few, *more))


def test_the_report_computes_shared_tables_once(spark, tables, monkeypatch):
    calls = []
    for module, name in ((kpi, "kpi_summary"), (episodes, "build_episodes")):
        def counted(*a, real=getattr(module, name), name=name, **k):
            calls.append(name)
            return real(*a, **k)
        monkeypatch.setattr(module, name, counted)
    got = registry.QUERIES["executive_tables"](spark, tables).collect()
    assert sorted(calls) == ["build_episodes", "kpi_summary"]
    sv = views(spark, tables)
    k = {r.metric: r.value for r in kpi.kpi_long(sv.lines(*registry.WEEKLY_COLS), sv.assets()).collect()}
    assert {r.metric: r.value for r in got if r.section == "kpi"} == k
    due = {r.scenario: r.total_incremental_revenue for r in decisions.uplift_scenarios(
        registry._alerts(sv), F.lit(k["avg_order_value"])).collect()}
    assert {r.item: r.value for r in got if r.metric == "total_incremental_revenue"} == pytest.approx(due)


def test_the_miner_makes_few_trees_of_few_baskets(spark, monkeypatch):
    lines = spark.createDataFrame([(v, i) for v in range(40) for i in "abcd"[: 1 + v % 4]], "visit_id long, item string").repartition(16)
    from pyspark.ml import fpm

    seen, real = [], fpm.FPGrowth.fit
    monkeypatch.setattr(fpm.FPGrowth, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or real(self, df))
    got = {tuple(r["items"]): r["freq"] for r in basket.frequent_itemsets(lines, star.star_params()).collect()}
    assert seen == [1] and got["a",] == 40 and got["a", "d"] == 10 and len(got) == 15
