"""A boosted forecaster of its own for each series, with simulated bands.

A series has a row a week, so its length is bounded by the calendar; each is
one group of ``applyInArrow`` and groups are fitted side by side. Features and
calendar flags come from DataFrame expressions (``demand``); only the trees
and the paths are made in the group. Bands are quantiles of paths that feed
each step's prediction plus a drawn error back into the lags, so errors add up
over the horizon. Drawn errors are those of the weeks that a fit before them
did not see.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.functions.calendar import week_calendar
from servicelens.operators.demand import CALENDAR_COLS, LAGS, translated
from servicelens.params import Params

METHOD_SERIES_GBT = "boosted trees by series + lag features + calendar exog"


@dataclass(frozen=True)
class BoostParams:
    iterations: int = 250
    rate: float = 0.04
    depth: int = 3
    #: Most bins of a feature; up to so many distinct values are told apart exactly.
    bins: int = 256
    paths: int = 200
    #: Training weeks below which a series is forecast by its mean.
    least_rows: int = 12


class Boosted:
    """Squared-error boosting of depth-limited trees on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, p: BoostParams):
        self.p, self.base = p, float(y.mean()) if len(y) else 0.0
        self.features: list[np.ndarray] = []
        self.cuts: list[np.ndarray] = []
        self.leaves: list[np.ndarray] = []
        if len(y) < p.least_rows:
            return
        edges = [self._cuts(c) for c in x.T]
        wide = max(map(len, edges)) + 1
        self.edges = np.array([np.pad(e, (0, wide - len(e)), constant_values=np.inf) for e in edges])
        codes = np.column_stack([np.searchsorted(e, c, side="left") + f * wide for f, (e, c) in enumerate(zip(edges, x.T))])
        left = y - self.base
        for _ in range(p.iterations):
            at = np.zeros(len(y), np.int64)
            for level in range(p.depth):
                feature, cut = self._best(codes, left, at, 1 << level)
                self.features.append(feature)
                self.cuts.append(cut)
                at = self._down(x, at, feature, cut)
            n = np.bincount(at, minlength=1 << p.depth)
            leaf = p.rate * np.bincount(at, left, 1 << p.depth) / np.maximum(n, 1)
            self.leaves.append(leaf)
            left = left - leaf[at]

    def _cuts(self, c: np.ndarray) -> np.ndarray:
        """Values between bins: a row is right of a cut if it is greater."""
        v = np.unique(c)
        if len(v) > self.p.bins:
            v = np.unique(np.quantile(c, np.linspace(0, 1, self.p.bins)))
        return (v[1:] + v[:-1]) / 2

    def _best(self, codes: np.ndarray, y: np.ndarray, at: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """(feature, cut) of each node: the largest fall in squared error, ties to the first; no gain: (0, inf)."""
        shape = (nodes, *self.edges.shape)
        size = self.edges.size
        place = (at[:, None] * size + codes).ravel()
        n = np.cumsum(np.bincount(place, minlength=nodes * size).reshape(shape), axis=2)
        s = np.cumsum(np.bincount(place, np.repeat(y, codes.shape[1]), nodes * size).reshape(shape), axis=2)
        rest = n[:, :, -1:] - n
        apart = s / np.maximum(n, 1) - (s[:, :, -1:] - s) / np.maximum(rest, 1)
        gain = (apart**2 * n * rest / np.maximum(n[:, :, -1:], 1)).reshape(nodes, size)  # zero where a side is empty
        most = gain.max(axis=1)
        found = (gain >= most[:, None] * (1 - 1e-9)).argmax(axis=1)
        some = most > 1e-12
        return np.where(some, found // shape[2], 0), np.where(some, self.edges.ravel()[found], np.inf)

    @staticmethod
    def _down(x: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        return at * 2 + (x[np.arange(len(x)), feature[at]] > cut[at])

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for i, leaf in enumerate(self.leaves):
            at = np.zeros(len(x), np.int64)
            for level in range(i * self.p.depth, (i + 1) * self.p.depth):
                at = self._down(x, at, self.features[level], self.cuts[level])
            out += leaf[at]
        return np.maximum(out, 0.0)


def features_at(history: np.ndarray, calendar: np.ndarray) -> np.ndarray:
    """Features of the week after ``history`` (paths x weeks): lags, trailing means, its calendar flags.

    A history shorter than a lag gives its mean for that lag.
    """
    n = history.shape[1]
    lags = [history[:, -k] if n >= k else history.mean(axis=1) for k in LAGS]
    means = [history[:, -k:].mean(axis=1) for k in (4, 8)]
    return np.column_stack([*lags, *means, np.broadcast_to(calendar, (len(history), len(calendar)))])


def training_rows(visits: np.ndarray, calendar: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and targets of all weeks whose lags are complete."""
    at = range(max(LAGS), len(visits))
    x = [features_at(visits[None, :i], calendar[i])[0] for i in at]
    return np.array(x).reshape(len(x), len(LAGS) + 2 + calendar.shape[1]), visits[max(LAGS) :]


def ahead(model: Boosted, visits: np.ndarray, calendar: np.ndarray, errors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(point, lower, upper) of the weeks of ``calendar`` that follow ``visits``.

    The point is the recursion without errors; the bounds are the 2.5 and 97.5
    percent quantiles of paths with errors drawn by ``seed``, NaN without errors.
    """
    draws = np.random.default_rng(seed).choice(errors, (model.p.paths, len(calendar))) if len(errors) else np.zeros((0, len(calendar)))
    draws = np.vstack([np.zeros(len(calendar)), draws])
    past = np.repeat(visits[None, :], len(draws), axis=0)
    for i, flags in enumerate(calendar):
        step = np.maximum(model.predict(features_at(past, flags)) + draws[:, i], 0.0)
        past = np.column_stack([past, step])
    got = past[:, len(visits) :]
    if len(errors) == 0:
        nothing = np.full(len(calendar), np.nan)
        return got[0], nothing, nothing
    low, high = np.quantile(got[1:], [0.025, 0.975], axis=0)
    return got[0], low, high


def held_out(x: np.ndarray, y: np.ndarray, p: BoostParams) -> tuple[Boosted | None, np.ndarray]:
    """(model, predictions) of the last weeks by a fit of the weeks before them; the split of ``demand.time_split``."""
    held = min(12, max(4, len(y) // 6))
    if len(y) <= held:
        return None, np.zeros(0)
    model = Boosted(x[:-held], y[:-held], p)
    return model, model.predict(x[-held:])


def held_errors(x: np.ndarray, y: np.ndarray, p: BoostParams) -> np.ndarray:
    pred = held_out(x, y, p)[1]
    return y[len(y) - len(pred) :] - pred


def with_future(weekly: DataFrame, params: Params, horizon: int) -> DataFrame:
    """Weekly rows with calendar flags, and ``horizon`` further weeks of each series with NULL visits."""
    own = weekly.select("series", "week", F.col("visits").cast("double").alias("visits"))
    last = own.groupBy("series").agg(F.max("week").alias("last"))
    later = last.select("series", F.explode(F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda i: F.date_add("last", i * 7))).alias("week"),
                        F.lit(None).cast("double").alias("visits"))
    flags = week_calendar(F.col("week"), params.holidays, params.legacy_holiday_distance)
    return own.unionByName(later).select("*", *[F.coalesce(flags[c].cast("double"), F.lit(0.0)).alias(c) for c in CALENDAR_COLS])


def _by_series(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run(series, weeks, visits, calendar)`` -> columns, for each series in the order of its weeks."""

    def one(t: pa.Table) -> pa.Table:
        t = t.sort_by("week")
        calendar = np.column_stack([t.column(c).to_numpy() for c in CALENDAR_COLS])
        name = t.column("series")[0].as_py()
        weeks, columns = run(name, t.column("week"), t.column("visits").to_numpy(zero_copy_only=False), calendar)
        return pa.table({"series": pa.array([name] * len(weeks), pa.string()), "week": weeks, **columns})

    # a stated number of partitions: few rows, but much work a row, so small partitions must not be merged
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "series").groupBy("series").applyInArrow(one, f"series string, week date, {schema}")


def _seed(params: Params, name: str) -> int:
    return zlib.crc32(f"{params.seed}/{name}".encode())


def boost_backtest(weekly: DataFrame, params: Params, boost: BoostParams | None = None) -> DataFrame:
    """One model a series, scored on the series' last weeks.

    ``pred_model_raw`` is the one-step prediction; ``lower_95`` and
    ``upper_95`` are the band of paths that start before the test weeks, with
    errors from the training weeks alone, and ``covered`` says whether the
    actual value lies in it. A series with no complete week before its test
    weeks gives no row.
    """
    p = boost or BoostParams(iterations=params.gbt_iters)

    def run(name, weeks, visits, calendar):
        x, y = training_rows(visits, calendar)
        model, pred = held_out(x, y, p)
        held = len(pred)
        first = len(visits) - held
        if model is None:
            low = high = pred
        else:
            errors = held_errors(x[: len(y) - held], y[: len(y) - held], p)
            _, low, high = ahead(model, visits[:first], calendar[first:], errors, _seed(params, name))
        actual = visits[first:]
        some = actual != 0
        mape = float(np.mean(np.abs(actual - pred)[some] / actual[some])) if some.any() else None
        return weeks.slice(first), {
            "actual_visits": pa.array(actual.astype(np.int64)), "pred_model_raw": pa.array(pred),
            "lower_95": pa.array(low, from_pandas=True), "upper_95": pa.array(high, from_pandas=True),
            "covered": pa.array((low <= actual) & (actual <= high), mask=np.isnan(low)),
            "mape_model": pa.array([mape] * held, pa.float64())}

    rows = with_future(weekly, params, 1).where(F.col("visits").isNotNull())
    return _by_series(rows, run, "actual_visits long, pred_model_raw double, lower_95 double, upper_95 double, covered boolean, mape_model double")


def boost_forecast(weekly: DataFrame, params: Params, boost: BoostParams | None = None) -> DataFrame:
    """``horizon_weeks`` recursive steps by each series' own model, with simulated bands.

    A series of fewer complete weeks than ``least_rows`` is forecast by the
    mean of its complete weeks (0 if there is none); one without held-out weeks has NULL bounds.
    """
    p = boost or BoostParams(iterations=params.gbt_iters)
    horizon = params.horizon_weeks

    def run(name, weeks, visits, calendar):
        known = len(visits) - horizon
        x, y = training_rows(visits[:known], calendar[:known])
        point, low, high = ahead(Boosted(x, y, p), visits[:known], calendar[known:], held_errors(x, y, p), _seed(params, name))
        return weeks.slice(known), {"pred": pa.array(point), "lower_95": pa.array(low, from_pandas=True), "upper_95": pa.array(high, from_pandas=True)}

    steps = _by_series(with_future(weekly, params, horizon), run, "pred double, lower_95 double, upper_95 double")
    totals = weekly.groupBy("series").agg(F.sum("visits").alias("tv"), F.sum("anchor_visits").alias("ta"), F.sum("revenue").alias("tr"))
    return translated(steps.join(totals, "series"), METHOD_SERIES_GBT, "lower_95", "upper_95")
