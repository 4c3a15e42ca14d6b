"""Calendar features of weekly labels and the simulator's day weights."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Calendar windows of the reference's demand features.
PRE_HOLIDAY_DAYS = 28
HOLIDAY_WEEK_BEFORE, HOLIDAY_WEEK_AFTER = -3, 7
PAYDAY_FIRST_DAYS, PAYDAY_FROM_DAY = 7, 25


def holiday_array(holidays: Sequence[str | dt.date]) -> Column:
    """The (parameter-sized) holiday list as a literal array column."""
    return F.array(*[F.lit(str(h)).cast("date") for h in holidays])


def days_to_holiday(d: Column, holidays: Sequence[str | dt.date], legacy: bool = False) -> Column:
    """Days from ``d`` to the relevant holiday.

    default: the nearest holiday not more than 3 days in the past;
    ``legacy``: the minimum over all holidays (the reference's formula,
    which always picks the earliest holiday).
    """
    diffs = F.transform(holiday_array(holidays), lambda h: F.datediff(h, d))
    if legacy:
        return F.array_min(diffs)
    return F.array_min(F.filter(diffs, lambda x: x >= HOLIDAY_WEEK_BEFORE))


def week_calendar(week: Column, holidays: Sequence[str], legacy: bool = False) -> dict[str, Column]:
    """F3-F4 features of a weekly label date."""
    dth = days_to_holiday(week, holidays, legacy)
    return {
        "week_of_year": F.weekofyear(week),
        "month": F.month(week),
        "is_year_end": F.month(week).isin(11, 12).cast("int"),
        "payday_week": ((F.dayofmonth(week) <= PAYDAY_FIRST_DAYS) | (F.dayofmonth(week) >= PAYDAY_FROM_DAY)).cast("int"),
        "pre_holiday_4w": F.coalesce(((dth > 0) & (dth <= PRE_HOLIDAY_DAYS)).cast("int"), F.lit(0)),
        "holiday_week": F.coalesce(((dth >= HOLIDAY_WEEK_BEFORE) & (dth <= HOLIDAY_WEEK_AFTER)).cast("int"), F.lit(0)),
    }


# The simulator's demand weights.
WEEKDAY_WEIGHT = {1: 1.0, 2: 1.0, 3: 1.05, 4: 1.05, 5: 1.15, 6: 1.45, 7: 0.35}  # ISO day: Monday=1 .. Sunday=7
PAYDAY_WEIGHT, PAYDAY_WEIGHT_FROM, PAYDAY_WEIGHT_UNTIL = 1.25, 25, 5
SURGE_DAYS, SURGE_PEAK = 21, 0.9
HOLIDAY_WEIGHT = 0.15
FIXED_HOLIDAYS_MD = ((1, 1), (8, 17), (12, 25), (6, 1))
LONG_HOLIDAY_OFFSETS = range(-2, 4)


def is_closed_day(d: Column, long_holidays: Sequence[str]) -> Column:
    """Fixed month/day holidays of any year, and -2..+3 days around each long holiday."""
    fixed = (F.month(d) * 100 + F.dayofmonth(d)).isin(*[100 * m + day for m, day in FIXED_HOLIDAYS_MD])
    around = F.exists(holiday_array(long_holidays),
                      lambda h: F.datediff(d, h).between(LONG_HOLIDAY_OFFSETS[0], LONG_HOLIDAY_OFFSETS[-1]))
    return fixed | around


def calendar_coverage(days: DataFrame, col: str, long_holidays: Sequence[str]) -> DataFrame:
    """Dates within the known moving holidays, and before or after them.

    The moving holidays are a list of given dates: flags of dates beyond the
    last one are not known, so a run should report how many there are.
    """
    first, last = (F.lit(str(x)).cast("date") for x in (min(map(str, long_holidays)), max(map(str, long_holidays))))
    c = F.col(col)
    return days.where(c.isNotNull()).agg(
        F.count_if(c < first).alias("before_calendar"), F.count_if(c.between(first, last)).alias("in_calendar"),
        F.count_if(c > last).alias("after_calendar"))


def calendar_weight(d: Column, long_holidays: Sequence[str]) -> Column:
    """Weekday x payday x pre-holiday surge multiplier; closed days weigh 0.15."""
    iso_dow = ((F.dayofweek(d) + 5) % 7) + 1
    wd = None
    for k, v in WEEKDAY_WEIGHT.items():
        wd = F.when(iso_dow == k, F.lit(v)) if wd is None else wd.when(iso_dow == k, F.lit(v))
    pay = F.when((F.dayofmonth(d) >= PAYDAY_WEIGHT_FROM) | (F.dayofmonth(d) <= PAYDAY_WEIGHT_UNTIL),
                 F.lit(PAYDAY_WEIGHT)).otherwise(F.lit(1.0))
    ahead = F.filter(F.transform(holiday_array(sorted(str(h) for h in long_holidays)), lambda h: F.datediff(h, d)),
                     lambda x: (x > 0) & (x <= SURGE_DAYS))
    delta = F.try_element_at(ahead, F.lit(1))
    surge = F.when(delta.isNull(), F.lit(1.0)).otherwise(
        F.lit(1.0) + F.lit(SURGE_PEAK) * (F.lit(1.0) - delta / F.lit(float(SURGE_DAYS))))
    return F.when(is_closed_day(d, long_holidays), F.lit(HOLIDAY_WEIGHT)).otherwise(wd * pay * surge)
