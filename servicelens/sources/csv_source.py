"""Read the service-history CSV files and coerce types.

Every column is read as text (so phone numbers and postcodes keep their
leading zeros) and then coerced with ``try_*`` casts: a value that does not
parse becomes NULL instead of failing the job (ANSI mode is on in Spark 4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelens.params import Params
from servicelens.sources.schema import (
    ASSET_COLUMNS, CUSTOMER_CSV_COLUMNS, LINE_COLUMNS, MASTER_CSV_COLUMNS, SERVICE_CSV_COLUMNS,
)


def _read_text(spark: SparkSession, path: str, columns: dict[str, str], fmt: str) -> DataFrame:
    if fmt == "csv":
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        raw = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    present = set(raw.columns)
    return raw.select(*[
        (F.col(src).cast("string") if src in present else F.lit(None).cast("string")).alias(dst)
        for src, dst in columns.items()
    ])


def coerce_date(c: Column) -> Column:
    """Unparseable dates become NULL (dates are kept at day precision).

    Accepted are ISO dates and timestamps (``2024-01-05``, ``2024-01-05 10:30:00``);
    other layouts, such as ``05/01/2024`` or ``20240105``, are NULL.
    """
    return F.try_to_timestamp(F.trim(c)).cast("date")


def coerce_number(c: Column) -> Column:
    """Unparseable and non-finite numbers become NULL."""
    v = F.trim(c).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def default_quantity(c: Column) -> Column:
    """missing/unparseable quantity -> 1, then truncated to a 64-bit integer."""
    return F.coalesce(coerce_number(c).try_cast("bigint"), F.lit(1).cast("bigint"))


def clean_lines(raw: DataFrame, params: Params) -> DataFrame:
    """Coerce a text-typed service-line frame to the canonical ``lines`` layout."""
    out = raw.select(
        F.col("line_id"), F.col("visit_id"), F.col("asset_id"),
        coerce_date(F.col("visit_date")).alias("visit_date"),
        coerce_number(F.col("meter_km")).alias("meter_km"),
        F.col("branch"), F.col("technician"), F.col("category"), F.col("item"),
        default_quantity(F.col("qty")).alias("qty"),
        coerce_number(F.col("price")).alias("price"),
    )
    return out.withColumn("is_anchor", anchor_flag(params)).select(*LINE_COLUMNS)


def anchor_flag(params: Params) -> Column:
    """Anchor-line flag; never NULL, and written with pushable predicates."""
    a = F.col(params.anchor_column)
    return (a == F.lit(params.anchor_value)) & a.isNotNull()


def clean_assets(raw: DataFrame) -> DataFrame:
    out = raw
    for c in ("model_year", "interval_km", "km_per_month"):
        out = out.withColumn(c, coerce_number(F.col(c)))
    return out.select(*ASSET_COLUMNS)


def load_service_lines(spark: SparkSession, path: str, params: Params, fmt: str = "csv") -> DataFrame:
    """S2 (+S4-S6): service lines from the reference's CSV layout."""
    return clean_lines(_read_text(spark, path, SERVICE_CSV_COLUMNS, fmt), params)


def load_assets(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """S1 (+S5): the asset master (one row per vehicle, owner columns included)."""
    return clean_assets(_read_text(spark, path, MASTER_CSV_COLUMNS, fmt))


def load_customers(spark: SparkSession, path: str | None, fmt: str = "csv") -> DataFrame | None:
    """S3: optional customer file; None when no path is given."""
    if not path:
        return None
    return _read_text(spark, path, CUSTOMER_CSV_COLUMNS, fmt)


def as_of_date(lines: DataFrame, params: Params) -> Column:
    """The as-of date as a scalar column (parameter, else max date + 1 day).

    The default is a scalar subquery: Spark evaluates the 1-row aggregate
    once and inlines it, no join is planned.
    """
    if params.as_of:
        return F.lit(params.as_of).cast("date")
    return lines.select(F.date_add(F.max("visit_date"), 1)).scalar()


# Column order of the denormalised asset master file.
MASTER_ORDER = ("customer_id", "owner_name", "phone", "address", "district", "city", "postcode", "asset_id", "plate",
                "model", "trim", "model_year", "fuel", "drive", "transmission", "oil_type", "interval_km", "segment",
                "km_per_month")


def denormalize_master(cars: DataFrame, customers: DataFrame) -> DataFrame:
    """Assets left-joined to their owner's attributes, in the master file's column order."""
    owner = customers.select("customer_id", *[c for c in ("owner_name", "phone", "address", "district", "postcode", "city")
                                              if c in customers.columns and c not in cars.columns])
    out = cars.join(owner, "customer_id", "left")
    return out.select(*[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in MASTER_ORDER])
