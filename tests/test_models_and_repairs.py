"""Fitted models on planted signals, and literal cases of ingest, calendar, ranks and medians."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from servicelens.functions.calendar import calendar_coverage, calendar_weight, is_closed_day
from servicelens.functions.ranking import average_percent_rank, global_running_sum
from servicelens.functions.rules import classify_item
from servicelens.functions.stats import exact_median
from servicelens.operators import audit, demand, interval, kpi, segments, visits
from servicelens.params import Params
from servicelens.sources.csv_source import MASTER_ORDER, clean_lines

LINE_TEXT = "line_id string, visit_id string, asset_id string, visit_date string, meter_km string, branch string, " \
            "technician string, category string, item string, qty string, price string"


def test_non_finite_and_huge_numbers_do_not_stop_the_load(spark):
    rows = [(str(i), "V1", "C1", "2024-01-05", "1", "b", "t", "c", "i", q, p) for i, (q, p) in enumerate(
        [("nan", "nan"), ("inf", "inf"), ("1e12", "1e17"), ("-2.9", "10.5"), ("", "20")])]
    lines = clean_lines(spark.createDataFrame(rows, LINE_TEXT), Params())
    got = {r.line_id: r for r in lines.collect()}
    assert [got[str(i)].qty for i in range(5)] == [1, 1, 1_000_000_000_000, -2, 1]
    assert got["0"].price is None and got["1"].price is None and got["2"].price == 1e17
    v = visits.visit_rollup(lines).first()
    assert float(v.visit_revenue) == 30.5
    assets = spark.createDataFrame([("C1", "O1", None)], "asset_id string, customer_id string, phone string")
    checks = {r.check: r.value for r in audit.audit_checks(lines, assets).collect()}
    assert [v for k, v in checks.items() if "missing" in k and "price" in k] == [2]
    assert kpi.revenue_by_item(lines).first().avg_price == pytest.approx(30.5 / 2)


def test_dates_of_other_layouts_are_null(spark):
    rows = [(str(i), "V", "C", d, "1", "b", "t", "c", "i", "1", "1") for i, d in enumerate(["2024-01-05", "2024-01-05 10:30:00", "05/01/2024", "x", None])]
    got = [r.visit_date for r in clean_lines(spark.createDataFrame(rows, LINE_TEXT), Params()).orderBy("line_id").collect()]
    assert got[:2] == [dt.date(2024, 1, 5)] * 2 and got[3:] == [None, None]


def test_closed_days_of_any_year(spark):
    days = [dt.date(y, m, d) for y in (1980, 2002, 2024) for m, d in ((12, 25), (1, 1), (8, 17), (6, 1), (12, 24))]
    df = spark.createDataFrame([(d,) for d in [*days, dt.date(2001, 12, 14), dt.date(2001, 12, 19), dt.date(2001, 12, 20)]], "d date")
    long = ["2001-12-16"]
    got = {r.d: (r.c, r.w) for r in df.select("d", is_closed_day(F.col("d"), long).alias("c"), calendar_weight(F.col("d"), long).alias("w")).collect()}
    assert all(got[d] == (True, 0.15) for d in days if (d.month, d.day) != (12, 24))
    assert not any(got[d][0] for d in days if (d.month, d.day) == (12, 24))
    assert got[dt.date(2001, 12, 14)][0] and got[dt.date(2001, 12, 19)][0] and not got[dt.date(2001, 12, 20)][0]
    assert tuple(calendar_coverage(df, "d", ["1990-01-01", "2001-12-19"]).first()) == (5, 2, 11)


def test_rank_and_median_with_a_hot_value_and_nulls(spark):
    rng = random.Random(1)
    rows = [(i, 5.0 if i % 3 == 0 else None if i % 7 == 0 else float(rng.randrange(200)), "a" if i % 10 else "b") for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, v double, g string")
    import pandas as pd

    want = pd.Series([r[1] for r in rows], dtype=float).rank(pct=True)
    got = {r.k: r.p for r in average_percent_rank(df, "v", ["k"], "p").collect()}
    assert len(got) == 6000
    assert all((got[i] is None and math.isnan(w)) or got[i] == pytest.approx(w) for i, w in enumerate(want))
    frame = pd.DataFrame(rows, columns=["k", "v", "g"])
    assert {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()} == frame.groupby("g").v.median().to_dict()
    assert exact_median(df, [], "v", "m").first().m == frame.v.median()
    wide = spark.range(1000).select((F.col("id") * 1.5).alias("v"), F.lit(None).cast("string").alias("g"))
    assert exact_median(wide, ["g"], "v", "m").first().m == 999 * 1.5 / 2
    run = {r.k: r.s for r in global_running_sum(spark.createDataFrame([(i, i + 1) for i in range(100)], "k long, w long"), ["k"], "w", "s").collect()}
    assert run == {i: (i + 1) * (i + 2) // 2 for i in range(100)}


def episodes(spark, n=400, alias=False):
    """log gap falls with km/month (planted slope -0.8) and with the heavy segment."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        seg = ("Heavy", "Light", "Mid")[i % 3]
        km = rng.uniform(300, 3000)
        ik = {"Heavy": 7000, "Light": 4500, "Mid": 10000}[seg] if alias else rng.choice([4500, 7000, 10000])
        gap = max(2, round(math.exp(9.5 - 0.8 * math.log(km) - 0.3 * (seg == "Heavy") + rng.gauss(0, 0.1))))
        rows.append((i, i, gap, int(gap * km / 30), km, ik, rng.randrange(1, 15), 2010 + i % 9, ("Petrol", "Diesel")[i % 2], ("FWD", "RWD")[(i // 2) % 2],
                     ("Mineral", "Full")[(i // 4) % 2], seg, math.log(gap), rng.random()))
    return spark.createDataFrame(rows, "asset_id long, visit_id long, gap_days int, gap_km long, km_per_month double, interval_km int, car_age int, "
                                       "model_year int, fuel string, drive string, oil_type string, segment string, log_gap_days double, utilization double")


def design(e, names):
    cols = {"log_km_per_month": np.log(e.km_per_month), "log_interval_km": np.log(e.interval_km), "model_year": e.model_year.astype(float), "const": np.ones(len(e))}
    out = []
    for n in names:
        if n in cols:
            out.append(cols[n])
        else:
            c, level = n.split("_oh_")
            out.append((e[c] == level).astype(float))
    return np.column_stack(out)


@pytest.mark.parametrize("alias", [False, True])
def test_log_ols_equals_normal_equations_and_has_p_values(spark, alias):
    ep = episodes(spark, alias=alias)
    scored, coef, summary = interval.log_ols(ep, Params())
    rows = {r.feature: r for r in coef.collect()}
    dropped = [n for n, r in rows.items() if r.coef_log_days is None]
    assert len(dropped) == (1 if alias else 0)
    names = [n for n in rows if n not in dropped]
    e = ep.toPandas()
    x, y = design(e, names), e.log_gap_days.to_numpy()
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    assert [rows[n].coef_log_days for n in names] == pytest.approx(beta.tolist(), abs=1e-5)
    assert all(rows[n].p_value is not None for n in names) and rows["log_km_per_month"].p_value < 1e-6
    assert rows["log_km_per_month"].coef_log_days == pytest.approx(-0.8, abs=0.05)
    resid = y - x @ beta
    assert summary["r2"] == pytest.approx(1 - (resid**2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-8)
    assert summary["median_predicted_gap_days"] == pytest.approx(float(np.median(np.exp(x @ beta))), rel=1e-6)
    assert scored.count() == len(e)


def test_aft_finds_the_planted_signs(spark):
    scored, coef, s = interval.weibull_aft(episodes(spark), Params(), leak_free=True)
    c = {r.feature: r.coef for r in coef.collect()}
    assert c["km_per_month"] < 0 and c["segment_oh_Light"] > 0  # against the heavy segment
    assert s["r2_log_duration"] > 0.6 and s["n_episodes"] == 400
    assert scored.where("pred_gap_days < 10 or pred_gap_days > 500").count() == 0


def test_gbt_interval_beats_the_mean(spark):
    scored, imp, s = interval.gbt_interval(episodes(spark), Params(gbt_iters=20))
    top = imp.first().feature
    assert scored.count() == 400 and s["r2_log_duration"] > 0.3 and (top.startswith("km_per_month") or top.startswith("gap_km"))


def test_passes_of_the_trees_have_as_many_tasks_as_the_episodes_need(spark):
    ep = episodes(spark).repartition(64)
    tracker, group = spark.sparkContext.statusTracker(), "trees"
    spark.sparkContext.setJobGroup(group, group)
    scored, _, _ = interval.gbt_interval(ep, Params(gbt_iters=8))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    wide = sum(i.numCompletedTasks >= 64 for i in map(tracker.getStageInfo, stages) if i)
    assert 0 < wide < 8 and scored.count() == 400  # the trees alone are 24 passes


def clustered(spark):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        base = (500.0, 2000.0, 6000.0)[i % 3]
        rows.append((i, ("x", "y")[i % 3 == 2], *[base * (1 + 0.01 * rng.random()) for _ in segments.X_COLS], base, base, base, 3.0, base))
    cols = "asset_id long, segment string, " + ", ".join(f"x_{c} double" for c in segments.X_COLS)
    return spark.createDataFrame(rows, cols + ", revenue_per_year double, km_per_month double, visits_per_year double, anchor_visits double, avg_gap_days double")


def test_kmeans_recovers_separated_groups(spark):
    k, sil, table, labelled = segments.cluster_run(clustered(spark), Params(kmeans_restarts=2, kmeans_final_restarts=2))
    assert k == 3 and sil > 0.95 and table.count() == 3
    got = {r.asset_id: r.cluster_id for r in labelled.collect()}
    assert all(got[i] == 2 - i % 3 for i in got)  # numbered by falling revenue
    grid = {(r.cluster_id, r.segment): r.share for r in segments.cluster_crosstab(labelled).collect()}
    assert grid == {(0, "x"): 0.0, (0, "y"): 1.0, (1, "x"): 1.0, (1, "y"): 0.0, (2, "x"): 1.0, (2, "y"): 0.0}
    p = segments.group_profile(labelled, "cluster_id", sil).collect()
    assert [r.top_segment for r in p] == ["y", "x", "x"] and {r.silhouette for r in p} == {sil}


def test_prediction_interval_and_backtest_by_model(spark):
    day = dt.date(2024, 1, 1)
    fc = spark.createDataFrame([("ALL", day, 10.0), ("B", day, 4.0)], "series string, week date, forecast_mean double")
    bt = spark.createDataFrame([("ALL", 0.1, 0.2, 2.0), ("ALL", 0.1, 0.2, 2.0)], "series string, mape_model double, mape_naive double, residual_sd double")
    got = {r.series: (r.lower_95, r.upper_95) for r in demand.prediction_interval(fc, bt).collect()}
    assert got == {"ALL": pytest.approx((10 - 3.92, 10 + 3.92)), "B": (None, None)}
    assert sorted((r.model, r.test_mape) for r in demand.backtest_by_model(bt).collect()) == sorted([(demand.METHOD_NAIVE, 0.2), (demand.METHOD_GBT, 0.1)])


def test_gbt_forecast_follows_a_seasonal_series(spark):
    rows = [("ALL", dt.date(2022, 1, 3) + dt.timedelta(days=7 * i), 100 + 60 * (i % 4 == 0), 10, 1000.0) for i in range(90)]
    weekly = spark.createDataFrame(rows, "series string, week date, visits long, anchor_visits long, revenue double")
    p = Params(gbt_iters=25)
    split = demand.time_split(demand.lag_features(weekly, p))
    bt = demand.gbt_backtest(split, p).first()
    assert bt.mape_model < bt.mape_naive
    fc = demand.recursive_forecast(weekly, p, demand.fit_gbt(split, p)).orderBy("week").collect()
    assert len(fc) == p.horizon_weeks and [r.forecast_visits > 130 for r in fc[:8]] == [(90 + i) % 4 == 0 for i in range(8)]


def test_item_rules_are_hit(spark):
    want = {"Filter Oli": "Oli & Filter", "Kampas Rem Depan": "Rem & Kaki", "Aki": "Kelistrikan", "Ban (per pcs)": "Rem & Kaki", "Busi Iridium": "Tune Up",
            "Oli Gardan": "Drivetrain", "Coolant": "Pendingin", "Filter AC": "Oli & Filter", "nothing like it": "Lainnya"}
    df = spark.createDataFrame([(n,) for n in want], "n string")
    assert {r.n: r.c for r in df.select("n", classify_item(F.col("n")).alias("c")).collect()} == want


def test_tables_are_read_back_as_written(spark, tmp_path):
    from servicelens.sources.sinks import write_tables

    df = spark.createDataFrame([(1, "x,y", ["a", "b"], 1.5), (2, None, [], None)], "k int, t string, items array<string>, p double")
    csv = write_tables({"t": df}, str(tmp_path / "csv"), "csv")["t"]
    got = sorted(map(tuple, spark.read.option("header", True).csv(csv).collect()))
    assert got == [("1", "x,y", "a | b", "1.5"), ("2", None, got[1][2], None)] and got[1][2] in (None, "")
    back = spark.read.parquet(write_tables({"t": df}, str(tmp_path / "pq"))["t"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_pipeline_with_models_feeds_predictions_to_alerts(spark, tmp_path):
    from servicelens.plans.common import views
    from servicelens.plans.pipeline import run
    from tests.conftest import SF0001

    sv = views(spark, SF0001)
    p = sv.params.with_(gbt_iters=3, kmeans_restarts=1, kmeans_final_restarts=1)
    paths = run(spark, sv.lines(), sv.assets(), p, str(tmp_path / "out"))
    read = {k: spark.read.parquet(v) for k, v in paths.items()}
    assert "avg_pred_gap_days" in read["interval_by_segment"].columns
    al = read["due_alert_candidates"]
    assert al.count() == sv.assets().count() and al.where("predicted_interval_days between 10 and 500").count() == al.count()
    share = read["cluster_confusion"].groupBy("cluster_id").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in share)
    assert read["model_summary"].first().r2_log_duration is not None


def test_master_order():
    assert MASTER_ORDER[4:7] == ("district", "city", "postcode")
