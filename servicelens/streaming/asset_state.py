"""E2 and A1 kept up over a file stream of anchor lines: each asset's latest anchor visit is the state.

A micro-batch is reduced to its anchor visits. Those after their asset's
latest visit get their previous visit, of the batch or of the state, and are
written as gaps; those that are not come too late to be put between others,
and are written to a table of late visits. The new state is the later of old
state and batch for each asset. Every batch has folders of its own
(``gaps/batch=N``, ``late/batch=N``, ``state/batch=N``) and reads the state of
the batch before it, so a replayed batch replaces its own rows. A batch costs
its lines and one row an asset; old lines are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from servicelens.functions.windows import lag_by_key
from servicelens.operators.episodes import anchor_lines

ORDER = ("visit_date", "meter_km", "visit_id")


def line_schema(id_type: T.DataType | None = None) -> T.StructType:
    """Columns of the line files; ids are text unless another type is given."""
    i = id_type or T.StringType()
    return T.StructType([
        T.StructField("line_id", T.StringType()), T.StructField("visit_id", i), T.StructField("asset_id", i),
        T.StructField("visit_date", T.DateType()), T.StructField("meter_km", T.LongType()),
        T.StructField("branch", T.StringType()), T.StructField("technician", T.StringType()),
        T.StructField("price", T.DoubleType()), T.StructField("is_anchor", T.BooleanType()),
    ])


def split_batch(lines: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new, late): the anchor visits of ``lines`` after and not after their asset's latest in ``state``.

    A visit that the state holds already counts as late, so does one of equal
    date, meter and smaller id. Lines without visit, asset, date or meter are
    left out.
    """
    key = F.struct(*ORDER)
    whole = F.lit(True)
    for c in ("visit_id", "asset_id", "visit_date", "meter_km"):
        whole = whole & F.col(c).isNotNull()
    visits = anchor_lines(lines.where(whole)).drop("price")
    old = state.select("asset_id", key.alias("__last"))
    met = visits.join(old, "asset_id", "left")
    after = F.col("__last").isNull() | (key > F.col("__last"))
    return met.where(after).drop("__last"), met.where(~after).drop("__last")


def new_gaps(new: DataFrame, state: DataFrame) -> DataFrame:
    """E2-E3 of the visits in ``new``: previous visit, gap in days and km."""
    cols = ["visit_id", "asset_id", "visit_date", "meter_km"]
    known = state.join(new.select("asset_id").distinct(), "asset_id", "left_semi")
    both = new.select(*cols, F.lit(True).alias("__new")).unionByName(known.select(*cols, F.lit(False).alias("__new")))
    g = lag_by_key(both, "asset_id", list(ORDER), ["visit_date", "meter_km"]).where("__new").drop("__new")
    return (g.withColumnsRenamed({"prev_visit_date": "prev_date"})
            .withColumn("gap_days", F.datediff("visit_date", "prev_date"))
            .withColumn("gap_km", F.col("meter_km") - F.col("prev_meter_km")))


def new_state(new: DataFrame, state: DataFrame) -> DataFrame:
    """The latest visit of each asset, by date, meter and visit."""
    both = state.unionByName(new.select(*state.columns))
    return both.groupBy("asset_id").agg(F.max(F.struct(*ORDER)).alias("l")).select("asset_id", *[F.col(f"l.{c}").alias(c) for c in ORDER])


def state_at(spark: SparkSession, folder: str, batch: int, id_type: T.DataType | None = None) -> DataFrame:
    """The state after ``batch`` (-1: before the first one)."""
    s = line_schema(id_type)
    schema = T.StructType([s[c] for c in ("asset_id", *ORDER)])
    if batch < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/state/batch={batch}")


def start(spark: SparkSession, source: str, folder: str, checkpoint: str, files_a_batch: int = 1000,
          available_now: bool = True, id_type: T.DataType | None = None) -> StreamingQuery:
    """Start the upkeep of gaps, late visits and state below ``folder`` from the line files in ``source``."""
    out = folder.rstrip("/")
    lines = spark.readStream.schema(line_schema(id_type)).option("maxFilesPerTrigger", files_a_batch).parquet(source)

    def write(batch: DataFrame, epoch: int) -> None:
        state = state_at(spark, out, epoch - 1, id_type)
        new, late = split_batch(batch, state)
        late.write.mode("overwrite").parquet(f"{out}/late/batch={epoch}")
        new_gaps(new, state).write.mode("overwrite").parquet(f"{out}/gaps/batch={epoch}")
        new_state(new, state).write.mode("overwrite").parquet(f"{out}/state/batch={epoch}")

    w = lines.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The gaps of all batches."""
    return spark.read.parquet(f"{folder.rstrip('/')}/gaps").drop("batch")


def late_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(batch, late_visits) of every batch that was written."""
    root = folder.rstrip("/")
    late = spark.read.parquet(f"{root}/late").groupBy("batch").agg(F.count(F.lit(1)).alias("late_visits"))
    seen = spark.read.parquet(f"{root}/state").select("batch").distinct()
    return seen.join(late, "batch", "left").select("batch", F.coalesce("late_visits", F.lit(0)).cast("long").alias("late_visits"))
