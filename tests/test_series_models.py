"""Models of many series: boosted trees against a plain loop, simulated bands, two-stage least squares against numpy."""

import datetime as dt

import numpy as np
import pytest

from servicelens.operators import demand, exog_ar, series_boost
from servicelens.operators.series_boost import Boosted, BoostParams
from servicelens.params import Params

DAY = dt.date(2022, 1, 3)
SCHEMA = "series string, week date, visits long, anchor_visits long, revenue double"
P = Params(gbt_iters=30)


def seasonal(name, n, seed, size=100, noise=8):
    rng = np.random.default_rng(seed)
    out, last = [], 0.0
    for i in range(n):
        last = 0.8 * last + rng.normal(0, noise)
        out.append((name, DAY + dt.timedelta(days=7 * i), max(0, int(size + 60 * (i % 4 == 0) + last)), 5, 1000.0))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain_boost(x, y, tests, p):
    """Exact greedy trees over all cuts, one row and one node at a time."""
    left, out = y - y.mean(), np.full(len(tests), y.mean())

    def grow(rows, depth):
        best, found = 1e-12, None
        if depth:
            for f in range(x.shape[1]):
                v = np.unique(x[:, f])
                for cut in (v[1:] + v[:-1]) / 2:
                    a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if len(a) and len(b):
                        gain = (left[a].mean() - left[b].mean()) ** 2 * len(a) * len(b) / len(rows)
                        if gain > best * (1 + 1e-9):
                            best, found = gain, (f, cut, a, b)
        if found is None:
            return p.rate * left[rows].mean()
        f, cut, a, b = found
        return f, cut, grow(a, depth - 1), grow(b, depth - 1)

    def value(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    for _ in range(p.iterations):
        tree = grow(np.arange(len(y)), p.depth)
        left = left - [value(tree, r) for r in x]
        out = out + [value(tree, r) for r in tests]
    return np.maximum(out, 0)


def test_boosting_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=60), rng.integers(0, 3, 60), rng.normal(size=60)])
    y = 40 + 9 * (x[:, 0] > 0.3) + 4 * x[:, 1] + rng.normal(size=60)
    p = BoostParams(iterations=12, rate=0.3)
    new = np.column_stack([rng.normal(size=40), rng.integers(0, 3, 40), rng.normal(size=40)])
    assert Boosted(x, y, p).predict(new) == pytest.approx(plain_boost(x, y, new, p), rel=1e-9)
    assert set(Boosted(x[:5], y[:5], p).predict(new)) == {y[:5].mean()}
    assert set(Boosted(x, np.full(60, 7.0), p).predict(new)) == {7.0}
    coarse = Boosted(x, y, BoostParams(iterations=12, rate=0.3, bins=8))
    assert np.isfinite(coarse.edges).sum(axis=1).max() <= 7 and np.corrcoef(coarse.predict(x), y)[0, 1] > 0.9


def test_each_series_has_its_own_model(spark):
    a, b = seasonal("a", 90, 1), seasonal("b", 80, 2, size=900, noise=2)
    short = [("short", DAY + dt.timedelta(days=7 * i), 10 + i, 1, 10.0) for i in range(9)]
    both = series_boost.boost_backtest(frame(spark, a + b + short), P).orderBy("series", "week").collect()
    alone = series_boost.boost_backtest(frame(spark, b), P).orderBy("week").collect()
    assert [r for r in both if r.series == "b"] == alone  # nothing of another series, nothing random
    assert {r.series for r in both} == {"a", "b"}
    split = demand.time_split(demand.lag_features(frame(spark, a + b), P)).where("is_test").collect()
    assert {(r.series, r.week, r.visits) for r in split} == {(r.series, r.week, r.actual_visits) for r in both}
    naive = {r.series: r.mape_naive for r in demand.naive_backtest(demand.time_split(demand.lag_features(frame(spark, a + b), P))).collect()}
    assert all(r.mape_model < naive[r.series] for r in both)
    # the group's features are those of the DataFrame expressions
    rows = demand.lag_features(frame(spark, a), P).orderBy("week").collect()
    flags = np.array([[float(r[c]) for c in demand.CALENDAR_COLS] for r in rows])
    visits = np.array([float(r[2]) for r in a])
    x, y = series_boost.training_rows(visits, np.vstack([np.zeros((12, flags.shape[1])), flags]))
    assert x == pytest.approx(np.array([[float(r[c]) for c in demand.FEATURE_COLS] for r in rows]))
    assert list(y) == [r.y for r in rows]


def test_bands_widen_and_cover(spark):
    rows = [r for s in range(12) for r in seasonal(f"s{s:02d}", 120, s)]
    back = series_boost.boost_backtest(frame(spark, rows), P).collect()
    assert 0.75 <= np.mean([r.covered for r in back]) <= 1.0
    got = series_boost.boost_forecast(frame(spark, rows), P).orderBy("series", "week").collect()
    assert len(got) == 12 * P.horizon_weeks
    width = np.array([r.upper_95 - r.lower_95 for r in got]).reshape(12, -1).mean(axis=0)
    assert width[4:].mean() > width[0]
    assert all(0 <= r.lower_95 <= r.upper_95 and r.forecast_mean >= 0 for r in got)
    again = series_boost.boost_forecast(frame(spark, rows).repartition(7), P).orderBy("series", "week").collect()
    assert again == got
    assert [(r.week - DAY).days // 7 for r in got[: P.horizon_weeks]] == list(range(120, 120 + P.horizon_weeks))


def test_short_and_empty_series(spark):
    got = series_boost.boost_forecast(frame(spark, [("one", DAY, 3, 1, 9.0)]), P).collect()
    assert len(got) == P.horizon_weeks and all(r.forecast_mean == 0 and r.lower_95 is None for r in got)
    assert series_boost.boost_backtest(frame(spark, []), P).collect() == []
    assert series_boost.boost_forecast(frame(spark, []), P).collect() == []
    split = demand.time_split(demand.lag_features(frame(spark, [("one", DAY, 3, 1, 9.0)]), P))
    assert exog_ar.exog_ar_backtest(split).collect() == []


def test_two_stages_equal_numpy_least_squares(spark):
    rows = seasonal("a", 110, 5) + seasonal("b", 70, 6, size=20)
    split = demand.time_split(demand.lag_features(frame(spark, rows), P))
    scored, fits = exog_ar.exog_ar_fit(split)
    for fit in fits.collect():
        r = scored.where(f"series = '{fit.series}'").orderBy("week").toPandas()
        x = np.column_stack([np.ones(len(r)), np.arange(len(r)), r[list(exog_ar.EXOG)]]).astype(float)
        y, train = r.y.to_numpy(), ~r.is_test.to_numpy(dtype=bool)
        used = [i for i in range(x.shape[1]) if np.linalg.matrix_rank(x[train][:, : i + 1]) > (np.linalg.matrix_rank(x[train][:, :i]) if i else 0)]
        want = np.zeros(x.shape[1])
        want[used] = np.linalg.lstsq(x[train][:, used], y[train], rcond=None)[0]
        assert fit.beta == pytest.approx(want, rel=1e-6, abs=1e-7)
        u = y - x @ want
        past = np.column_stack([np.concatenate([np.zeros(k), u[:-k]]) for k in exog_ar.AR_LAGS])
        learn = train & (np.arange(len(u)) >= max(exog_ar.AR_LAGS))
        rho = np.linalg.lstsq(past[learn], u[learn], rcond=None)[0]
        assert fit.rho == pytest.approx(rho, rel=1e-6, abs=1e-7)
        assert r.pred.to_numpy()[learn] == pytest.approx(np.maximum(x @ want + past @ rho, 0)[learn], rel=1e-6)
    back = exog_ar.exog_ar_backtest(split)
    assert {r.series for r in back.collect()} == {"a", "b"} and exog_ar.mape_rows(back).count() == 4
