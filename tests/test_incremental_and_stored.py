"""Weighted itemsets, stored sketches, co-partitioned tables and per-asset streaming state."""

import itertools
import random
import re
from collections import Counter
from datetime import date, timedelta

from pyspark.sql import functions as F

from servicelens.functions import sketch
from servicelens.operators import episodes, itemsets
from servicelens.operators.alerts import last_anchor
from servicelens.operators.asset_history import asset_history
from servicelens.params import Params
from servicelens.sources.bucketed import write_bucketed
from servicelens.streaming import asset_state


def _lines(spark, visits):
    return spark.createDataFrame([(v, i) for v, items in visits for i in items] or [], "visit_id string, item string")


def test_weighted_itemsets_equal_a_plain_count_and_fp_growth(spark):
    from servicelens.operators.basket import frequent_itemsets

    r = random.Random(5)
    visits = [(f"v{n}", r.sample("abcdefgh", r.randint(1, 5)) + ["hot"] * (n % 3 > 0) + [None] * (n % 7 == 0)) for n in range(400)]
    visits += [("only-null", [None]), (None, ["a", "b"])]
    lines = _lines(spark, visits).unionByName(_lines(spark, visits[:50]))  # repeated rows count once
    params = Params(min_support=0.05)
    sets = [frozenset(x for x in i if x) for v, i in visits if v]
    plain = {}
    for k in range(1, 7):
        for c in itertools.combinations(["a", "b", "c", "d", "e", "f", "g", "h", "hot"], k):
            n = sum(s.issuperset(c) for s in sets)
            if n / len(sets) >= 0.05:
                plain[c] = n
    got = itemsets.weighted_itemsets(lines, params)
    assert {tuple(x["items"]): x["freq"] for x in got.collect()} == plain
    assert max(map(len, plain)) >= 3
    fp = frequent_itemsets(lines, params)
    assert got.exceptAll(fp.select(*got.columns)).count() == fp.select(*got.columns).exceptAll(got).count() == 0


def test_patterns_are_the_distinct_baskets_with_their_weights(spark):
    visits = [(f"v{n}", ["x", "y"] if n % 2 else ["y"]) for n in range(100)] + [("w", ["rare"])]
    p = itemsets.weighted_patterns(itemsets.baskets(_lines(spark, visits)), 0.1, 101)
    assert {tuple(r["rest"]): r["w"] for r in p.collect()} == {("x", "y"): 50, ("y",): 50}
    empty = itemsets.weighted_itemsets(_lines(spark, []), Params(min_support=0.1))
    assert empty.count() == 0 and empty.columns == ["items", "freq", "size", "support"]


def _percentile(xs, q):
    xs, h = sorted(xs), q * (len(xs) - 1)
    lo = int(h)
    return xs[lo] + (h - lo) * (xs[min(lo + 1, len(xs) - 1)] - xs[lo])


def test_sketches_meet_their_bound_and_merge_to_the_whole(spark):
    r = random.Random(3)
    rows = [(k, i % 9, r.lognormvariate(3, 2) * (-1 if k == "neg" else 1)) for k in ("a", "neg", None) for i in range(700)]
    rows += [("a", 1, None), ("a", 1, float("nan")), ("a", 1, float("inf"))] + [("zero", 0, 0.0)] * 3
    df = spark.createDataFrame(rows, "k string, day int, x double")
    probs = {"q00": 0.0, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    days = sketch.sketch(df, ["k", "day"], "x", 0.02)
    whole = sketch.sketch(df, ["k"], "x", 0.02)
    merged = sketch.merged(days, ["k"])
    assert merged.exceptAll(whole).count() == whole.exceptAll(merged.select(*whole.columns)).count() == 0
    for row in sketch.quantiles(merged, ["k"], probs, 0.02).collect():
        xs = [x for k, _, x in rows if k == row["k"] and x is not None and abs(x) < float("inf")]
        assert row["n"] == len(xs)
        for name, q in probs.items():
            exact = _percentile(xs, q)
            assert abs(row[name] - exact) <= 0.02 * abs(exact) + 1e-9
    assert sketch.quantiles(sketch.sketch(df.limit(0), ["k"], "x"), ["k"], probs).count() == 0


def test_a_stored_day_is_replaced_alone(spark, tmp_path):
    first = spark.createDataFrame([(1, 5.0), (2, 7.0)], "day int, x double")
    again = spark.createDataFrame([(2, 9.0), (2, 9.0), (3, 1.0)], "day int, x double")
    sketch.store(sketch.sketch(first, ["day"], "x"), "day", f"{tmp_path}/s")
    kept = sketch.store(sketch.sketch(again, ["day"], "x"), "day", f"{tmp_path}/s")
    assert {r["day"]: r["n"] for r in kept.collect()} == {1: 1, 2: 2, 3: 1}


def test_co_partitioned_tables_are_summed_and_joined_without_an_exchange(spark):
    r = random.Random(9)
    keys = [None, *range(40)]
    visits = [(r.choice(keys) if n % 3 else 7, n, date(2020, 1, 1) + timedelta(n % 50), float(n)) for n in range(900)]  # one hot key
    gaps = [(r.choice(keys), n, n % 90) for n in range(500)]
    a = spark.createDataFrame([(k, f"s{k % 3}") for k in range(45)], "asset_id long, segment string")
    v = spark.createDataFrame(visits, "asset_id long, visit_id long, visit_date date, visit_revenue double")
    e = spark.createDataFrame(gaps, "asset_id long, visit_id long, gap_days int")
    ta, tv, te = (write_bucketed(t, "asset_id", 4, writers=3) for t in (a, v, e))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = asset_history(ta, tv, te)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"\bExchange\b", plan) and "SortMergeJoin" in plan
        rows = {x["asset_id"]: x for x in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    n = Counter(x[0] for x in visits)
    assert len(rows) == 45
    for k, x in rows.items():
        assert x["n_visits"] == n.get(k, 0) and x["n_episodes"] == sum(g[0] == k for g in gaps)
        assert (x["revenue"] or 0.0) == sum(y[3] for y in visits if y[0] == k)
        assert x["last_visit"] == max((y[2] for y in visits if y[0] == k), default=None)
    assert tv.exceptAll(v).count() == v.exceptAll(tv).count() == 0


def _anchor_row(visit, asset, day, meter, line=1, anchor=True):
    return (f"{visit}-{line}", visit, asset, day, meter, "b", "t", 10.0, anchor)


def _run(spark, base, files):
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, asset_state.line_schema()).coalesce(1).write.mode("append").parquet(f"{base}/in")
        q = asset_state.start(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
        q.awaitTermination()
        assert q.exception() is None
    return asset_state.gaps(spark, f"{base}/out"), asset_state.state_at(spark, f"{base}/out", len(files) - 1)


def test_asset_state_after_all_files_equals_the_batch(spark, tmp_path):
    r = random.Random(11)
    day = date(2021, 1, 1)
    visits = [(f"v{n:04d}", "hot" if n % 3 == 0 else f"a{r.randint(0, 12)}", day + timedelta(n // 5), 100 * n) for n in range(300)]
    rows = [_anchor_row(*v, line=k, anchor=k < 3) for v in visits for k in range(4)]
    files = [rows[:400], rows[400:404], rows[404:]]
    odd = [_anchor_row("x", None, day, 5), _anchor_row("y", "a1", None, 5), _anchor_row(None, "a1", day, 5)]
    got, state = _run(spark, tmp_path, [f + odd for f in files])
    lines = spark.createDataFrame(rows, asset_state.line_schema())
    want = episodes.episode_lag(lines).select(*got.columns)
    assert got.count() == 300 and got.exceptAll(want).count() == 0
    last = last_anchor(lines).select("asset_id", F.col("last_anchor_date").alias("visit_date"),
                                     F.col("last_anchor_km").alias("meter_km"), F.col("last_anchor_visit_id").alias("visit_id"))
    assert state.count() == last.count() and state.exceptAll(last).count() == 0
    assert {x["batch"]: x["late_visits"] for x in asset_state.late_counts(spark, f"{tmp_path}/out").collect()} == {0: 0, 1: 0, 2: 0}


def test_late_visits_are_kept_apart_and_counted(spark, tmp_path):
    day = date(2021, 1, 1)
    first = [_anchor_row("v1", "a", day, 10), _anchor_row("v3", "a", day + timedelta(20), 300)]
    second = [_anchor_row("v2", "a", day + timedelta(5), 50), _anchor_row("v3", "a", day + timedelta(20), 300),
              _anchor_row("v4", "a", day + timedelta(30), 400), _anchor_row("w1", "b", day, 1)]
    got, state = _run(spark, tmp_path, [first, second, []])
    assert {(x["visit_id"], x["gap_days"], x["gap_km"]) for x in got.collect()} == {
        ("v1", None, None), ("v3", 20, 290), ("v4", 10, 100), ("w1", None, None)}
    assert {(x["asset_id"], x["visit_id"]) for x in state.collect()} == {("a", "v4"), ("b", "w1")}
    counts = {x["batch"]: x["late_visits"] for x in asset_state.late_counts(spark, f"{tmp_path}/out").collect()}
    assert counts == {0: 0, 1: 2, 2: 0}
    assert {x["visit_id"] for x in spark.read.parquet(f"{tmp_path}/out/late").collect()} == {"v2", "v3"}
