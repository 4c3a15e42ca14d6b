"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelens.session import ensure_checkpoint_dir


def one_blas_thread() -> None:
    """Keep numpy's linear algebra to the calling thread.

    Spark runs a task on each core already, and OpenBLAS's own threads were
    seen to wait for each other forever in a driver that has a JVM below it.
    """
    for lib in (Path(np.__file__).parent.parent / "numpy.libs").glob("*openblas*"):
        put = getattr(ctypes.CDLL(str(lib)), "scipy_openblas_set_num_threads64_", None)
        if put:
            put(1)


one_blas_thread()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts the lineage, survives lost executors, and gives a later join two
    plain exchanges, which adaptive execution may split where a key is hot.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(key: str, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod`` (NULL key: NULL)."""
    return F.crc32(F.col(key).cast("string")) % mod


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores put before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def summed_blocks(parts: DataFrame, fan_in: int = 256) -> dict[int, np.ndarray]:
    """Sum the vectors ``v`` of equal ``block`` over all partitions, in two levels.

    ``parts`` holds at most one vector per block and partition. A first group
    takes the partitions of one rest modulo ``fan_in``, a second one the at
    most ``fan_in`` sums of a block; the number and width of the blocks are
    fixed by the model, not by the data.
    """

    def add(t: pa.Table) -> pa.Table:
        rows = sorted(x.as_py() for x in t.column("v").combine_chunks())  # same order in each run
        total = np.sum([np.frombuffer(x, dtype=np.float64) for x in rows], axis=0)
        return pa.table({"block": t.column("block").slice(0, 1), "v": pa.array([total.tobytes()], pa.binary())})

    some = parts.groupBy("block", F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("part")).applyInArrow(add, "block int, v binary")
    out = some.groupBy("block").applyInArrow(add, "block int, v binary")
    return {r["block"]: np.frombuffer(bytes(r["v"]), dtype=np.float64) for r in out.collect()}


def block_rows(values: np.ndarray, blocks: int) -> pa.RecordBatch:
    """One partition's sums, cut into equal blocks for ``summed_blocks``."""
    cut = np.array_split(np.ascontiguousarray(values, dtype=np.float64).ravel(), blocks)
    return pa.RecordBatch.from_pydict(
        {"block": pa.array(range(blocks), pa.int32()), "v": pa.array([c.tobytes() for c in cut], pa.binary())}
    )


def joined_blocks(got: dict[int, np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Put the blocks together again; an empty input gives zeros."""
    if not got:
        return np.zeros(shape)
    return np.concatenate([got[k] for k in sorted(got)]).reshape(shape)


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    """The texts of a batch one by one, so that only one is a Python string at a time."""
    for x in batch.column(name):
        yield x.as_py()
