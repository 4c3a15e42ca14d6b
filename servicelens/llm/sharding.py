"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a table of prime size. The
shards take turns, and each claims the first free slot of its preference, until
no slot is free. All shards own nearly the same number of slots, and a change
of the shards moves few slots. A document's key hashes to a slot; the table is
broadcast, so a placement is one lookup.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelens.llm.common import free_names

#: The largest table that is broadcast; 16 bytes a slot.
MOST_SLOTS = 1 << 22


@dataclass(frozen=True)
class ShardParams:
    shards: int = 64
    #: A prime, at least 100 times the shards for slots even to about 1 %.
    slots: int = 6553


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def lookup_table(names: list[str], slots: int) -> list[int]:
    """Index of the owning shard for each slot; depends on the shards' names alone."""
    if not 0 < len(names) <= slots <= MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)) or slots < 2:
        raise ValueError("the number of slots must be a prime, no less than the shards, up to 2**22")
    start = [_number(f"start/{x}") % slots for x in names]
    step = [_number(f"step/{x}") % (slots - 1) + 1 for x in names]
    turn, owner, taken = [0] * len(names), [-1] * slots, 0
    while True:
        for i in range(len(names)):
            while owner[slot := (start[i] + turn[i] * step[i]) % slots] >= 0:
                turn[i] += 1
            owner[slot] = i
            taken += 1
            if taken == slots:
                return owner


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def slot_of(slots: int) -> Column:
    """Slot of a row by its doc_id, or by its text where that is NULL."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long"), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, p: ShardParams) -> DataFrame:
    """(__slot, __shard): one row a slot, from a literal; its size is ``p.slots`` whatever the data."""
    owners = ",".join(map(str, lookup_table(shard_names(p.shards), p.slots)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(owners), ","))).select(
        F.col("pos").alias("__slot"), F.col("col").cast("int").alias("__shard")
    )


def with_shard(docs: DataFrame, params: ShardParams | None = None, name: str = "shard") -> DataFrame:
    """``docs`` with the column ``name``: the shard of each row.

    No row is moved for it. Rows of one doc_id, and so repeated rows, share a
    shard; a NULL doc_id is placed by its text, a NULL text like an empty one;
    an empty table gives no rows. A column of that name is replaced, any other
    column is kept as it is, whatever its name.
    """
    p = params or ShardParams()
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    slot, shard = free_names(docs, "__slot", "__shard")
    owners = table_frame(docs.sparkSession, p).withColumnsRenamed({"__slot": slot, "__shard": shard})
    return docs.withColumn(slot, slot_of(p.slots)).join(F.broadcast(owners), slot).select(*kept, F.col(shard).alias(name))


def shard_counts(placed: DataFrame, name: str = "shard") -> DataFrame:
    """Rows by shard, for a manifest."""
    return placed.groupBy(name).agg(F.count(F.lit(1)).alias("n_docs"))


def write_shards(placed: DataFrame, path: str, files_a_shard: int = 8, name: str = "shard") -> None:
    """One folder a shard; the rows of a shard, and of a frequent doc_id, are dealt over several files."""
    salt = F.pmod(F.xxhash64(*[c for c in placed.columns if c != name]), F.lit(files_a_shard))
    placed.repartition(F.col(name), salt).write.partitionBy(name).mode("overwrite").parquet(path)
