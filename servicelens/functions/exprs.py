"""Scalar and aggregate column helpers (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"  # contract: amounts have two decimals and stay below 1e16; others are rounded or NULL
# Deterministic tie order for "first line of a group": line ids may repeat,
# so the remaining line attributes break the tie.
LINE_ORDER = ("line_id", "branch", "technician", "price")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Amount as an exact decimal; NaN, infinite and too large amounts become NULL."""
    return F.when(F.abs(col(c)) < F.lit(1e16), col(c)).cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Exact sum of a money column (decimal), exposed as double."""
    return F.sum(money(c)).cast("double")


def money_avg(c: str | Column) -> Column:
    """Exact mean of a money column: decimal sum / count of the amounts summed."""
    return F.sum(money(c)).cast("double") / F.count(money(c))


def first_by(value: str | Column, *order: str | Column) -> Column:
    """First non-null ``value`` in ``order`` (pandas ``first`` on sorted input)."""
    v = col(value)
    key = F.struct(*[col(o) for o in order], v.alias("__v"))
    return F.min(F.when(v.isNotNull(), key))["__v"]


def last_by(value: str | Column, *order: str | Column) -> Column:
    v = col(value)
    key = F.struct(*[col(o) for o in order], v.alias("__v"))
    return F.max(F.when(v.isNotNull(), key))["__v"]


def first_in_line_order(value: str | Column) -> Column:
    return first_by(value, *LINE_ORDER)


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """pandas ``clip``: bounds applied, NULL stays NULL (``greatest`` skips nulls)."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def half_even(c: Column, scale: int = 0) -> Column:
    """numpy / Python rounding (half to even)."""
    return F.bround(c, scale)


def closing_monday(d: str | Column) -> Column:
    """Label of the weekly bin (previous Monday, Monday] containing ``d``."""
    return F.next_day(F.date_sub(col(d), 1), "Mon")


def week_start(d: str | Column) -> Column:
    """Start (a Tuesday) of the week ending on Monday that contains ``d``."""
    return F.date_sub(closing_monday(d), 6)


def first_word(c: str | Column) -> Column:
    return F.split(F.trim(col(c)), r"\s+").getItem(0)


def ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero or NULL denominator."""
    return F.try_divide(num, den)


def r6(c: Column) -> Column:
    """Round a derived ratio to 6 places (stable across summation orders)."""
    return F.round(c, 6)
