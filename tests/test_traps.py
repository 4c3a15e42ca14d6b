"""Literal fixtures for behaviours that are easy to get wrong."""

import datetime as dt

from pyspark.sql import functions as F

from servicelens.functions.calendar import days_to_holiday
from servicelens.functions.exprs import closing_monday, half_even, week_start
from servicelens.functions.ranking import average_percent_rank, global_row_number, ntile
from servicelens.functions.windows import lag_by_key
from servicelens.operators import audit, basket
from servicelens.operators.alerts import reminder_message, tier
from servicelens.params import Params
from servicelens.sources.csv_source import clean_lines

LINE_TEXT = "line_id string, visit_id string, asset_id string, visit_date string, meter_km string, branch string, " \
            "technician string, category string, item string, qty string, price string"


def _lines(spark, rows):
    return clean_lines(spark.createDataFrame(rows, LINE_TEXT), Params())


def test_coercion_bad_values_become_null(spark):
    rows = [("1", "V1", "C1", "2024-01-05", "100", "b", "t", "c", "Ganti Oli Mesin", None, "10"),
            ("2", "V1", "C1", "not a date", "x", "b", "t", "c", "Wiper", "abc", "-5"),
            ("3", "V2", "C2", "2024-02-01", "200", "b", "t", "c", "Wiper", "2.9", "oops")]
    out = {r.line_id: r for r in _lines(spark, rows).collect()}
    assert out["1"].qty == 1 and out["1"].is_anchor
    assert out["2"].visit_date is None and out["2"].meter_km is None and out["2"].qty == 1
    assert out["3"].qty == 2 and out["3"].price is None


def test_audit_counts_repeated_null_ids_as_duplicates(spark):
    rows = [(None, "V1", "C1", "2024-01-05", "1", "b", "t", "c", "i", "1", "10"),
            (None, "V1", "C1", "2024-01-05", "1", "b", "t", "c", "i", "1", "10"),
            ("A", "V2", "C9", "2024-01-06", "1", "b", "t", "c", "i", "1", "-1"),
            ("A", "V2", "C9", "2024-01-06", "1", "b", "t", "c", "i", "1", "0")]
    lines = _lines(spark, rows)
    assets = spark.createDataFrame([("C1", "O1", None)], "asset_id string, customer_id string, phone string")
    checks = {r.check: r.value for r in audit.audit_checks(lines, assets).collect()}
    assert checks["duplicate_line_id"] == 2
    assert checks["fk_missing_asset_id"] == 1
    assert checks["negative_price"] == 1
    assert checks["phone_leading_zero_ok"] == 0


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(half_even(F.col("x"), 0)).collect()] == [0.0, 2.0, 2.0, -2.0]


def test_week_labels(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),), (dt.date(2024, 1, 7),)], "d date")
    got = df.select(closing_monday("d").alias("m"), week_start("d").alias("s")).collect()
    assert [r.m for r in got] == [dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 1, 8)]
    assert [r.s for r in got] == [dt.date(2023, 12, 26), dt.date(2024, 1, 2), dt.date(2024, 1, 2)]


def test_holiday_distance_default_and_legacy(spark):
    hol = ["2022-05-02", "2023-04-22"]
    df = spark.createDataFrame([(dt.date(2023, 4, 10),), (dt.date(2022, 5, 4),)], "d date")
    got = df.select(days_to_holiday(F.col("d"), hol).alias("a"), days_to_holiday(F.col("d"), hol, legacy=True).alias("b")).collect()
    assert [r.a for r in got] == [12, -2]
    assert [r.b for r in got] == [-343, -2]


def test_average_percent_rank_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", None)], "k string, v double")
    got = {r.k: r.p for r in average_percent_rank(df, "v", ["k"], "p").collect()}
    assert abs(got["a"] - 1 / 3) < 1e-12 and abs(got["b"] - 5 / 6) < 1e-12 and got["c"] == got["b"] and got["d"] is None


def test_global_row_number_with_hot_value(spark):
    rows = [(i, 0 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v long")
    got = global_row_number(df, ["v", "id"], "rn").orderBy("rn").collect()
    expect = sorted(rows, key=lambda r: (r[1], r[0]))
    assert [(r.id, r.rn) for r in got] == [(e[0], i + 1) for i, e in enumerate(expect)]


def test_ntile_quartiles_533(spark):
    df = spark.range(1, 534).withColumn("q", ntile(F.col("id"), F.lit(533), 4))
    sizes = sorted((r.q, r["count"]) for r in df.groupBy("q").count().collect())
    assert sizes == [(1, 134), (2, 133), (3, 133), (4, 133)]


def test_lag_by_key_equals_plain_window(spark):
    from pyspark.sql import Window

    rows = [("hot", dt.date(2024, 1, 1) + dt.timedelta(days=i // 3), i, i * 10) for i in range(300)] + \
           [("cold", dt.date(2024, 3, 1), 1, 5), ("cold", dt.date(2024, 3, 9), 2, 9), (None, dt.date(2024, 3, 1), 3, 1)]
    df = spark.createDataFrame(rows, "k string, d date, id int, m int")
    got = lag_by_key(df, "k", ["d", "id"], ["d", "m"]).select("id", "prev_d", "prev_m")
    w = Window.partitionBy("k").orderBy("d", "id")
    ref = df.select("id", F.when(F.col("k").isNotNull(), F.lag("d").over(w)).alias("prev_d"),
                    F.when(F.col("k").isNotNull(), F.lag("m").over(w)).alias("prev_m"))
    assert sorted(got.collect(), key=repr) == sorted(ref.collect(), key=repr)


def test_tier_and_message_nulls(spark):
    df = spark.createDataFrame([(None, None, None), (90.0, 1.2, 0.5), (55.0, None, 0.7)],
                               "s double, pd double, pk double")
    out = df.select(tier(F.col("s")).alias("t"),
                    reminder_message(F.lit("Budi Santoso"), F.lit("Avanza"), F.lit("BK 1"), F.col("pd"), F.col("pk")).alias("m")).collect()
    assert [r.t for r in out] == ["Monitor", "Critical", "Warm Reminder"]
    assert out[0].m is None and out[2].m is None
    assert "about 120%" in out[1].m and out[1].m.startswith("Hello Budi,")


def _basket_lines(spark, baskets):
    rows = []
    for v, items in enumerate(baskets):
        for j, it in enumerate(items):
            rows.append((f"{v}-{j}", f"V{v}", "C1", "2024-01-01", "1", "b", "t", "c", it, "1", "100"))
    return _lines(spark, rows)


def test_association_rules_from_triples_and_conviction(spark):
    lines = _basket_lines(spark, [["a", "b", "c"]] * 6 + [["a", "b"]] * 2 + [["d"]] * 2)
    p = Params(min_support=0.5, min_lift=0.0)
    rules = {(r.antecedents_txt, r.consequents_txt): r for r in basket.association_rules(lines, p).collect()}
    # itemset {a,b,c} (6/10) yields 6 rules; {a,b},{a,c},{b,c} yield 2 each
    assert len(rules) == 12
    r = rules[("a + c", "b")]
    assert abs(r.support - 0.6) < 1e-12 and r.confidence == 1.0 and r.conviction == float("inf")
    assert abs(rules[("a", "b + c")].confidence - 0.75) < 1e-12


def test_association_rules_empty(spark):
    lines = _basket_lines(spark, [["a"], ["b"], ["c"], ["d"]])
    out = basket.association_rules(lines, Params(min_support=0.9))
    assert out.count() == 0 and "lift" in out.columns


def test_pairwise_rules_lift_symmetric(spark):
    lines = _basket_lines(spark, [["a", "b"], ["a", "b"], ["a"], ["b", "c"], ["c"]])
    rules = {(r.antecedent, r.consequent): r for r in basket.pairwise_rules(lines, Params(min_support=0.2, min_lift=0.0)).collect()}
    assert abs(rules[("a", "b")].lift - rules[("b", "a")].lift) < 1e-12
    assert rules[("a", "b")].cooccurrence_visits == 2 and rules[("a", "b")].antecedent_visits == 3


def test_exact_median_matches_percentile(spark):
    from servicelens.functions.stats import exact_median

    rows = [("hot", float(i % 97)) for i in range(2001)] + [("even", 1.0), ("even", 4.0), ("even", 2.5), ("even", 10.0)] \
        + [("one", 7.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m").collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert got.get("nulls") is None and want["nulls"] is None
    assert {k: v for k, v in got.items() if v is not None} == {k: v for k, v in want.items() if v is not None}
    overall = exact_median(df, [], "v", "m").first().m
    assert overall == df.select(F.median("v")).first()[0]
