"""M2-M4: ridge-penalised Weibull accelerated failure time model, by distributed Newton steps.

A duration t with covariates x has the survival function exp(-(t / exp(x b))**rho).
Each step is one pass: every task sums the objective, gradient and Hessian of
its rows, Spark adds these few numbers up, and the driver solves a system of
the model's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

#: Fixed value: the reference run's ridge penalty.
PENALTY = 0.01
MOST_STEPS, CLOSE = 100, 1e-10
Z95 = 1.959963984540054


@dataclass(frozen=True)
class Design:
    """Columns of a design: numeric ones, and categories coded against their alphabetically first level."""

    numeric: tuple[str, ...]
    levels: tuple[tuple[str, str], ...]  # (column, level), without each column's first level

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *(f"{c}_oh_{v}" for c, v in self.levels)]

    def columns(self) -> list[Column]:
        """Values in the order of ``names``."""
        return [*(F.col(c).cast("double") for c in self.numeric), *(F.when(F.col(c) == v, 1.0).otherwise(0.0) for c, v in self.levels)]


@dataclass(frozen=True)
class AftFit:
    design: Design
    #: Of the covariates in order, then the intercept, then the logarithm of rho.
    params: np.ndarray
    errors: np.ndarray
    steps: int

    def log_scale(self) -> Column:
        """x b as a column."""
        return sum((F.lit(float(b)) * x for b, x in zip(self.params, self.design.columns())), F.lit(float(self.params[-2])))

    def median(self) -> Column:
        return median_duration(self.log_scale(), float(self.params[-1]))

    def table(self) -> list[tuple]:
        """(param, feature, coef, exp_coef, se, z, p, lower_95, upper_95) of each coefficient."""
        rows = []
        for name, b, se in zip([*self.design.names, "intercept", "intercept"], self.params.tolist(), self.errors.tolist()):
            known = se > 0 and math.isfinite(se)
            z = b / se if known else None
            rows.append(("rho" if len(rows) == len(self.params) - 1 else "lambda", name, b, math.exp(b) if b < 700 else math.inf, se if known else None, z,
                         math.erfc(abs(z) / math.sqrt(2)) if known else None, b - Z95 * se if known else None, b + Z95 * se if known else None))
        return rows


TABLE = "param string, feature string, coef double, exp_coef double, se double, z double, p double, lower_95 double, upper_95 double"


def median_duration(log_scale: Column, log_rho: float) -> Column:
    """M3: exp(x b) * ln(2)**(1 / rho)."""
    return F.exp(log_scale + F.lit(math.log(math.log(2.0)) / math.exp(log_rho)))


def make_design(frame: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> Design:
    """The design over the levels that the frame has; their number is the model's size."""
    got = frame.agg(*[F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(c) for c in categories]).first()
    return Design(tuple(numeric), tuple((c, v) for c in categories for v in got[c][1:]))


def sums_at(rows: DataFrame, params: np.ndarray, size: int) -> tuple[float, float, np.ndarray, np.ndarray]:
    """(rows, log-likelihood, gradient, Hessian) at ``params`` over (x array, log_t, event), in one pass.

    A task gives one row of numbers; these are added by position, partly in the
    map tasks, so the driver gets as many numbers as the model has.
    """
    width = 2 + size + size * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        b, log_rho = params[:-1], params[-1]
        rho = math.exp(log_rho)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            x = np.column_stack([x, np.ones(len(x))])
            log_t, event = batch.column("log_t").to_numpy(), batch.column("event").to_numpy()
            z = rho * (log_t - x @ b)
            w = np.exp(np.minimum(z, 500.0))
            total[0] += len(x)
            total[1] += np.sum(event * (log_rho + z - log_t) - w)
            slope = np.append(x.T @ (-rho * (event - w)), np.sum(event * (1 + z) - w * z))
            curve = np.empty((size, size))
            curve[:-1, :-1] = x.T @ (x * (-rho * rho * w)[:, None])
            curve[-1, :-1] = curve[:-1, -1] = x.T @ (rho * (w * (1 + z) - event))
            curve[-1, -1] = np.sum(event * z - w * z * (1 + z))
            total[2:] += np.concatenate([slope, curve.ravel()])
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.tolist()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("at", "v"))
    got = {r["at"]: r["v"] for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect()}
    v = np.array([got[i] for i in range(width)])
    return v[0], v[1], v[2 : 2 + size], v[2 + size :].reshape(size, size)


def fit_weibull(frame: DataFrame, numeric: Sequence[str], categories: Sequence[str], duration: str = "gap_days",
                event: str | None = None, penalty: float = PENALTY) -> AftFit:
    """Fit the model to rows without NULL; ``event`` is 1.0 for ended and 0.0 for censored durations (all ended without it).

    The objective is the mean log-likelihood less ``penalty`` / 2 times the
    squares of the coefficients of covariates divided by their standard
    deviation; intercepts are free. Newton steps are halved until the
    objective grows. Standard errors are of the inverse of the penalised
    observed information. Durations of 0 or less, which have no logarithm,
    are left out; a frame without rows gives NaN.
    """
    design = make_design(frame, numeric, categories)
    kept = frame.where(F.col(duration) > 0)
    x = F.array(*design.columns())
    rows = kept.select(x.alias("x"), F.log(F.col(duration).cast("double")).alias("log_t"), (F.col(event).cast("double") if event else F.lit(1.0)).alias("event"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = len(design.names) + 2
        spread = rows.agg(F.avg("log_t").alias("mean"), F.stddev_samp("log_t").alias("sd"), *[F.stddev_samp(F.col("x")[i]).alias(f"s{i}") for i in range(size - 2)]).first()
        if spread["mean"] is None:
            return AftFit(design, np.full(size, math.nan), np.full(size, math.nan), 0)
        scale = np.array([spread[f"s{i}"] or 1.0 for i in range(size - 2)] + [1.0, 1.0])
        scaled = rows.select(F.array(*[F.col("x")[i] / F.lit(float(s)) for i, s in enumerate(scale[:-2])]).alias("x"), "log_t", "event")
        ridge = np.append(np.full(size - 2, penalty), [0.0, 0.0])

        def at(params: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, float]:
            n, value, slope, curve = sums_at(scaled, params, size)
            return value / n - 0.5 * np.sum(ridge * params**2), slope / n - ridge * params, curve / n - np.diag(ridge), n

        params = np.zeros(size)
        params[-2], params[-1] = spread["mean"] + 0.5, math.log(1.28 / max(spread["sd"] or 1.0, 1e-3))
        value, slope, curve, n = at(params)
        steps = 1
        while steps < MOST_STEPS and np.max(np.abs(slope)) > CLOSE:
            bend, axes = np.linalg.eigh(-curve)  # Newton's step; uphill too where the objective bends up
            step = axes @ ((axes.T @ slope) / np.maximum(np.abs(bend), 1e-9))
            part, gained = 1.0, False
            while steps < MOST_STEPS and part > 1e-9:
                tried = at(params + part * step)
                steps += 1
                if math.isfinite(tried[0]) and tried[0] >= value - 1e-14:
                    gained = True
                    break
                part /= 2
            if not gained:
                break
            moved, value, slope, curve = np.max(np.abs(part * step)), *tried[:3]
            params = params + part * step
            if moved < 1e-12:
                break
        errors = np.sqrt(np.maximum(np.diag(np.linalg.pinv(-curve * n)), 0.0))
        return AftFit(design, params / scale, errors / scale, steps)
    finally:
        rows.unpersist()
