"""The ridge Weibull fit and the side-by-side K-Means against plain numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from servicelens.operators import segments, survival
from servicelens.params import Params

NUM, CAT = ("km", "age"), ("fuel", "kind")


def durations(n=600, censored=True):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        km, age, fuel, kind = rng.uniform(300, 3000), rng.randrange(1, 15), rng.choice("abc"), rng.choice(["x", "y"])
        scale = math.exp(5 - 0.0005 * km + 0.02 * age - 0.4 * (fuel == "c"))
        t = scale * (-math.log(rng.random())) ** (1 / 2.5)
        stop = rng.uniform(20, 400) if censored else math.inf
        rows.append((km, age, fuel, kind, max(1.0, min(t, stop)), float(t <= stop)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "km double, age int, fuel string, kind string, gap_days double, ended double").repartition(3)


def objective(rows, params, penalty):
    """Written apart from the library: mean log-likelihood less the penalty, at the scaled coefficients."""
    x = np.array([[r[0], r[1], r[2] == "b", r[2] == "c", r[3] == "y"] for r in rows], float)
    sd = x.std(0, ddof=1)
    beta, free, rho = params[:5], params[5], math.exp(params[6])
    t, d = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
    lam = np.exp(x / sd @ beta + free)
    log_h = np.log(rho / lam) + (rho - 1) * np.log(t / lam)
    return np.mean(d * log_h - (t / lam) ** rho) - penalty / 2 * np.sum(beta**2)


def slopes(f, at, h=1e-5):
    return np.array([(f(at + h * e) - f(at - h * e)) / (2 * h) for e in np.eye(len(at))])


@pytest.mark.parametrize("censored,penalty", [(True, 0.01), (False, 0.01), (True, 0.0)])
def test_fit_is_the_optimum_and_errors_are_the_inverse_information(spark, censored, penalty):
    rows = durations(censored=censored)
    fit = survival.fit_weibull(frame(spark, rows), NUM, CAT, event="ended", penalty=penalty)
    assert fit.design.names == ["km", "age", "fuel_oh_b", "fuel_oh_c", "kind_oh_y"]
    x = np.array([[r[0], r[1], r[2] == "b", r[2] == "c", r[3] == "y"] for r in rows], float)
    sd = np.append(x.std(0, ddof=1), [1.0, 1.0])
    f = lambda p: objective(rows, p, penalty)
    scaled = fit.params * sd
    assert np.max(np.abs(slopes(f, scaled))) < 1e-7
    # a plain Newton fit by finite differences, from near by, ends at the same place
    other = scaled + np.array([0.05, -0.05, 0.03, -0.03, 0.05, 0.1, -0.1])
    for _ in range(30):
        curve = np.array([slopes(lambda p: slopes(f, p, 1e-4)[i], other, 1e-4) for i in range(7)])
        step = -np.linalg.solve((curve + curve.T) / 2, slopes(f, other))
        while f(other + step) < f(other) - 1e-13:
            step /= 2
        other = other + step
        if np.max(np.abs(step)) < 1e-9:
            break
    assert np.max(np.abs(other / sd - fit.params)) < 1e-6
    curve = np.array([slopes(lambda p: slopes(f, p, 1e-4)[i], scaled, 1e-4) for i in range(7)])
    errors = np.sqrt(np.diag(np.linalg.inv(-curve * len(rows)))) / sd
    assert fit.errors == pytest.approx(errors, rel=1e-3)
    table = {(r[0], r[1]): r for r in fit.table()}
    km = table["lambda", "km"]
    assert km[2] == pytest.approx(-0.0005, rel=0.15) and km[6] < 1e-10 and km[5] == pytest.approx(km[2] / km[4]) and km[7] < km[2] < km[8]
    assert table["lambda", "kind_oh_y"][6] > 0.001  # planted without effect
    assert table["rho", "intercept"][2] == pytest.approx(math.log(2.5), abs=0.15)


def test_median_of_a_fit(spark):
    fit = survival.fit_weibull(frame(spark, durations(200)), NUM, CAT, event="ended")
    got = frame(spark, durations(200)).withColumn("m", fit.median()).collect()
    for r in got[:20]:
        x = [r.km, r.age, r.fuel == "b", r.fuel == "c", r.kind == "y"]
        lam = math.exp(np.dot(x, fit.params[:5]) + fit.params[5])
        assert math.exp(-((r.m / lam) ** math.exp(fit.params[6]))) == pytest.approx(0.5)


def test_fit_of_an_empty_frame_and_of_constant_columns(spark):
    empty = survival.fit_weibull(frame(spark, durations(3)).where("km < 0"), NUM, CAT)
    assert all(math.isnan(x) for x in empty.params)
    same = [(1.0, 2, "a", "x", t, 1.0) for t in (10.0, 20.0, 30.0, 25.0, 0.0)]  # a duration of 0 is left out
    fit = survival.fit_weibull(frame(spark, same), NUM, CAT, event="ended")
    assert fit.design.names == ["km", "age"] and np.isfinite(fit.params).all()
    assert 10 < math.exp(fit.params @ [1.0, 2.0, 1.0, 0.0]) < 35


def cloud(spark, n=300, k=4):
    rng = np.random.default_rng(2)
    z = rng.normal(size=(n, 7)) * 0.3 + rng.integers(0, k, n)[:, None] * 2.0
    return z, spark.createDataFrame([(x.tolist(),) for x in z], "z array<double>").repartition(3)


def lloyd(z, centers):
    for _ in range(segments.MOST_SWEEPS):
        own = np.argmin(((z[:, None] - centers) ** 2).sum(2), 1)
        new = np.array([z[own == i].mean(0) if (own == i).any() else c for i, c in enumerate(centers)])
        if np.max(np.abs(new - centers)) <= segments.CLOSE:
            return own, new
        centers = new
    return own, new


def test_fits_side_by_side_equal_single_fits(spark):
    z, df = cloud(spark)
    starts = {(k, s): segments.first_centers(z, k, s) for k in (3, 4, 5) for s in range(6)}
    fits, passes = segments.fit_many(df, starts)
    alone = 0
    for j, first in starts.items():
        own, centers = lloyd(z, first)
        assert np.allclose(fits[j][0], centers, atol=1e-9)
        away = ((z[:, None] - centers) ** 2).sum(2)
        assert fits[j][1] == pytest.approx(away.min(1).sum())
        assert (np.argmin(((z[:, None] - fits[j][0]) ** 2).sum(2), 1) == own).all()
        alone = max(alone, segments.fit_many(df, {j: first})[1]) if j[1] == 0 else alone
    assert alone <= passes <= segments.MOST_SWEEPS
    got = [r.c for r in df.select(segments.nearest(fits[4, 0][0]).alias("c"), "z").collect()]
    assert sorted(np.bincount(got)) == sorted(np.bincount(lloyd(z, starts[4, 0])[0]))


def test_passes_do_not_grow_with_the_restarts(spark):
    z, df = cloud(spark, 200)
    df = df.persist()
    tracker, group = spark.sparkContext.statusTracker(), "sweeps"
    spark.sparkContext.setJobGroup(group, group)
    _, passes = segments.fit_many(df, {(4, s): segments.first_centers(z, 4, s) for s in range(30)})
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3 * passes + 10 and passes < 30


def test_constant_features_and_fewer_assets_than_clusters(spark):
    cols = "asset_id long, segment string, " + ", ".join(f"x_{c} double" for c in segments.X_COLS) + ", revenue_per_year double"
    df = spark.createDataFrame([(i, "s", *[1.0] * len(segments.X_COLS), 5.0) for i in range(2)], cols)
    pts = segments._points(df)
    assert all(r.z == [0.0] * 7 for r in pts.collect())
    fits, passes = segments.fit_many(pts, {0: segments.first_centers(np.zeros((2, 7)), 3, 1)})
    assert passes == 1 and fits[0][1] == 0.0
    assert pts.select(segments.nearest(fits[0][0]).alias("c")).agg(F.max("c")).first()[0] == 0
    assert Params().kmeans_restarts == 20 and Params().kmeans_final_restarts == 30


def test_tasks_of_a_pass_follow_the_points_not_the_shuffles_before(spark, monkeypatch):
    cols = "asset_id long, " + ", ".join(f"x_{c} double" for c in segments.X_COLS)
    df = spark.createDataFrame([(i, *[float(i % (j + 2)) for j in range(len(segments.X_COLS))]) for i in range(100)], cols).repartition(64)
    assert segments._points(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(segments, "POINTS_A_TASK", 30)
    pts = segments._points(df)
    assert pts.rdd.getNumPartitions() == 4 and pts.count() == 100


def test_a_pass_gives_equal_centres_to_the_first_and_holds_a_few_points_at_once(spark, monkeypatch):
    monkeypatch.setattr(segments, "POINTS_AT_ONCE", 7)
    z, df = cloud(spark, 60)
    twin = np.array([z[0], z[1], z[0]])
    (members, sums, cost), (m4, s4, c4) = segments.sweep(df, [twin, z[:4].copy()])
    own = np.argmin(((z[:, None] - twin[:2]) ** 2).sum(2), 1)
    assert members.tolist() == [(own == 0).sum(), (own == 1).sum(), 0] and not sums[2].any()
    assert cost == pytest.approx(((z[:, None] - twin) ** 2).sum(2).min(1).sum())
    assert m4.sum() == 60 and np.allclose(s4.sum(0), z.sum(0)) and c4 == pytest.approx(((z[:, None] - z[:4]) ** 2).sum(2).min(1).sum())
