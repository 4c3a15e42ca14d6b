"""Run parameters shared by all operators (a small frozen object)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

# The reference run's defaults.
DEFAULT_ANCHOR_ITEM = "Ganti Oli Mesin"
DEFAULT_MIN_SUPPORT = 0.03
DEFAULT_MIN_LIFT = 1.05
DEFAULT_HORIZON_WEEKS = 8
DEFAULT_SEED = 42
# Approximate Eid al-Fitr dates used as the holiday calendar
# of the reference's weekly demand features.
DEFAULT_HOLIDAYS = (
    "2022-05-02", "2023-04-22", "2024-04-10", "2025-03-31", "2026-03-20", "2027-03-10",
)


@dataclass(frozen=True)
class Params:
    """Parameters of one analytics run.

    ``anchor_column``/``anchor_value`` define the anchor service (the line
    predicate that marks e.g. an oil change).  ``as_of`` defaults to the
    maximum service date + 1 day.
    """

    anchor_column: str = "item"
    anchor_value: str = DEFAULT_ANCHOR_ITEM
    min_support: float = DEFAULT_MIN_SUPPORT
    min_lift: float = DEFAULT_MIN_LIFT
    horizon_weeks: int = DEFAULT_HORIZON_WEEKS
    seed: int = DEFAULT_SEED
    as_of: str | None = None
    # episode validity window (days)
    max_gap_days: int = 500
    # audit: services dated before this are flagged
    window_start: str = "2022-01-01"
    holidays: tuple[str, ...] = DEFAULT_HOLIDAYS
    # True reproduces the reference's "minimum over all holidays" distance
    legacy_holiday_distance: bool = False
    # named items for the conditional attach-rate check
    probe_items: tuple[str, ...] = ()
    # exact medians use a value->count map per group; False switches to
    # approx_percentile for high-cardinality double columns
    exact_median: bool = True
    # decision layer
    # visits a week that can be served; None: 11/10 of the highest forecast week
    weekly_capacity: int | None = 60
    uplift_conversion: float = 0.18
    # model sizes (reference: 250 trees, 20/30 k-means restarts)
    gbt_iters: int = 250
    kmeans_restarts: int = 20
    kmeans_final_restarts: int = 30
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @property
    def holiday_dates(self) -> list[_dt.date]:
        return [_dt.date.fromisoformat(d) for d in self.holidays]
