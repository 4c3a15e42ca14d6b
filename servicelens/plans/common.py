"""Shared helpers for registered queries."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelens.sources.star import StarViews, star_params


def views(spark: SparkSession, sf_dir: str) -> StarViews:
    return StarViews(spark, sf_dir, star_params())


def present(df: DataFrame) -> DataFrame:
    """Output normalisation shared with the SQL oracles.

    Dates become ISO text, arrays become ``|``-joined text, decimals double.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
