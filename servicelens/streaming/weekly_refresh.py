"""Weekly demand (F1) maintained incrementally over a file stream of service lines.

New line files arriving in a folder are aggregated into closing-Monday weeks
with a watermark on the service date, so a week's row is final once the
stream has moved ``late_days`` past it; weeks that are not final yet are not
written, they follow with later files.  Distinct visits are counted per week
from the (week, visit) state; revenue is an exact decimal sum.  Lines of no
visit or date are left out, as in the batch; lines that come after their week
was final are dropped and counted (``late_lines``).  Each micro-batch has a
folder of its own in the sink, so a replayed batch replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from servicelens.functions.exprs import closing_monday, money


def line_schema(id_type: T.DataType | None = None) -> T.StructType:
    """Columns of the line files; visit ids are text unless another type is given."""
    return T.StructType([
        T.StructField("visit_id", id_type or T.StringType()),
        T.StructField("visit_date", T.DateType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("is_anchor", T.BooleanType()),
    ])


def weekly_visit_stream(spark: SparkSession, folder: str, late_days: int = 14, id_type: T.DataType | None = None) -> DataFrame:
    """Per (week, visit) rollup of a line stream; feed it to ``weekly_from_visits``."""
    s = spark.readStream.schema(line_schema(id_type)).parquet(folder)
    s = s.where(F.col("visit_id").isNotNull() & F.col("visit_date").isNotNull())
    ts = F.col("visit_date").cast("timestamp")
    return (s.withColumn("event_time", ts)
            .withWatermark("event_time", f"{late_days} days")
            # windows [Tuesday, next Tuesday): the epoch is a Thursday, +5 days is a Tuesday
            .groupBy(F.window("event_time", "7 days", startTime="5 days").alias("w"), "visit_id")
            .agg(F.bool_or("is_anchor").alias("has_anchor"),
                 F.sum(money("price")).alias("visit_revenue"),
                 F.min("visit_date").alias("visit_date")))


def weekly_from_visits(batch: DataFrame) -> DataFrame:
    """Final weekly rows from one micro-batch of completed (week, visit) rows."""
    return (batch.groupBy(closing_monday("visit_date").alias("week"))
            .agg(F.count(F.lit(1)).alias("visits"), F.count_if("has_anchor").alias("anchor_visits"),
                 F.sum("visit_revenue").alias("revenue")))


def start(spark: SparkSession, folder: str, sink_folder: str, checkpoint: str, late_days: int = 14,
          available_now: bool = True, id_type: T.DataType | None = None) -> StreamingQuery:
    """Start the refresh: completed weeks go to ``sink_folder/batch=N`` (Parquet)."""
    visits = weekly_visit_stream(spark, folder, late_days, id_type)

    def write(batch: DataFrame, epoch: int) -> None:
        weekly_from_visits(batch).write.mode("overwrite").parquet(f"{sink_folder.rstrip('/')}/batch={epoch}")

    w = visits.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def late_lines(query: StreamingQuery) -> int:
    """(week, visit) updates dropped since their week was final already.

    Of the batches that the query still reports on: the last 100, or as many
    as ``spark.sql.streaming.numRecentProgressUpdates`` says.
    """
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
