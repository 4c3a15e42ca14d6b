"""User-level rules lifted from the reference's data simulator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered substring rules item name -> category (first match wins).
CATEGORY_RULES = (
    (("Filter",), "Oli & Filter"),
    (("Tune", "Busi"), "Tune Up"),
    (("Rem", "Ban", "Spooring"), "Rem & Kaki"),
    (("Gardan",), "Drivetrain"),
    (("Coolant", "AC"), "Pendingin"),
    (("Aki",), "Kelistrikan"),
)
DEFAULT_CATEGORY = "Lainnya"

# Anchor-service interval (km) by oil type, diesel cap, hybrid floor.
INTERVAL_BY_OIL = {"Mineral": 4500, "Semi-Sintetik": 7000, "Full-Sintetik": 9500,
                   "Semi-Synthetic": 7000, "Full-Synthetic": 9500}
DIESEL_CAP, HYBRID_FLOOR = 6000, 10000


def classify_item(item: Column) -> Column:
    """G1: category of an item name by the ordered substring rules."""
    out = None
    for words, cat in CATEGORY_RULES:
        cond = None
        for w in words:
            c = item.contains(w)
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(cat)) if out is None else out.when(cond, F.lit(cat))
    return out.otherwise(F.lit(DEFAULT_CATEGORY))


def interval_rule(fuel: Column, oil_type: Column) -> Column:
    """Km interval from the oil type; diesel capped at 6,000, hybrid at least 10,000."""
    base = None
    for oil, km in INTERVAL_BY_OIL.items():
        base = F.when(oil_type == oil, F.lit(km)) if base is None else base.when(oil_type == oil, F.lit(km))
    return (F.when(base.isNull(), F.lit(None))
            .when(fuel == "Diesel", F.least(base, F.lit(DIESEL_CAP)))
            .when(fuel == "Hybrid", F.greatest(base, F.lit(HYBRID_FLOOR)))
            .otherwise(base))
