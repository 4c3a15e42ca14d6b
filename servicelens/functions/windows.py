"""Window building blocks that stay distributed when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_by_key(df: DataFrame, key: str, order_cols: Sequence[str], value_cols: Sequence[str],
               bucket: str | None = None, prefix: str = "prev_") -> DataFrame:
    """Previous row's ``value_cols`` within ``key`` in ``order_cols`` order.

    ``order_cols`` must be a total order inside a key.  A plain
    ``lag().over(partitionBy(key))`` sends every row of a key to one task;
    here the window runs per ``(key, bucket)`` -- ``bucket`` is a column that
    is monotone in the order (default: the first order column, e.g. the
    date) -- and the first row of each bucket takes the last row of the
    key's previous non-empty bucket.  That carry comes from the
    ``(key, bucket)`` aggregate (map-side combined), whose window per key
    holds one row per bucket, bounded by the calendar rather than the data.
    """
    bucket = bucket or order_cols[0]
    w = Window.partitionBy(key, bucket).orderBy(*order_cols)
    out = df.withColumn("__rn", F.row_number().over(w))
    for c in value_cols:
        out = out.withColumn(prefix + c, F.lag(c).over(w))
    last = (df.where(F.col(key).isNotNull())
            .groupBy(key, bucket)
            .agg(F.max_by(F.struct(*value_cols), F.struct(*order_cols)).alias("__last")))
    carry = last.select(key, bucket, F.lag("__last").over(Window.partitionBy(key).orderBy(bucket)).alias("__carry"))
    out = out.join(carry, [key, bucket], "left")
    for c in value_cols:
        out = out.withColumn(
            prefix + c,
            F.when(F.col(key).isNull(), F.lit(None))
            .when(F.col("__rn") == 1, F.col("__carry")[c])
            .otherwise(F.col(prefix + c)),
        )
    return out.drop("__rn", "__carry")
