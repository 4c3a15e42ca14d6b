"""Substring deduplication: content-defined chunks of a gear rolling hash, deduplicated by digest.

A gear hash of the 16 bytes before each word decides where chunks are cut: a
word starts a chunk if its hash is the least of some ``window`` successive
words. Cuts depend on the text around them alone, so an insertion shifts no
other cut, and no chunk is longer than ``window`` words. Runs of chunks that an
earlier document has too are duplicate spans, if they are long or the whole
document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from servicelens.llm.common import materialise, texts

#: One random number for each byte value.
GEAR = np.random.default_rng(64).integers(0, 1 << 32, 256, dtype=np.uint32)
SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
#: Keys from here on stand for rows without a doc_id.
NO_ID = 1 << 62


@dataclass(frozen=True)
class ChunkParams:
    window: int = 12
    #: Least words of a run of shared chunks. The first word of a passage that has 16 bytes of it before
    #: it is word 8 at most (after words of one letter), and the first and last sure cut are up to window - 1
    #: and window words from there and from the end: n - 8 - 2 * window + 1 words of whole chunks are sure to be shared, 20 of 51.
    min_words: int = 20


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h = (h << 2) + GEAR[byte] in 32 bits, at each byte; it forgets bytes older than 16."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        nxt = h.copy()
        nxt[step:] += h[:-step] << np.uint32(2 * step)
        h = nxt
    return h


def chunk_cuts(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words) of the chunks: byte ranges from a word's start to the end of the last word before the next cut."""
    space = SPACE[data]
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(starts)
    if not n:
        return starts, ends, starts
    cuts = np.zeros(1, np.int64)
    if n - 1 >= window:  # the first word always starts a chunk; the others compete
        key = (gear_hashes(data)[starts[1:] - 1].astype(np.uint64) << np.uint64(32)) | np.arange(1, n, dtype=np.uint64)
        low, width = key, 1
        while 2 * width <= window:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < window:
            low = np.minimum(low[: len(low) - (window - width)], low[window - width :])
        cuts = np.concatenate((cuts, np.unique((low & np.uint64(0xFFFFFFFF)).astype(np.int64))))
    words = np.diff(np.append(cuts, n))
    return starts[cuts], ends[cuts + words - 1], words


def chunks(docs: DataFrame, p: ChunkParams) -> DataFrame:
    """(digest, dkey, text_key, seq, final, start, stop, words): all chunks of all rows; start and stop are UTF-8 byte offsets.

    ``final`` marks the last chunk of its text; ``text_key``, a digest of the
    whole text, tells apart several texts of one doc_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                yield rows(part.column("doc_id").to_pylist(), texts(part))

    def rows(ids: list[int | None], group: Iterator[str | None]) -> pa.RecordBatch:
        digest, cols = [], [[] for _ in range(7)]
        for doc_id, t in zip(ids, group):
            data = (t or "").encode("utf-8", "surrogatepass")
            start, stop, words = chunk_cuts(np.frombuffer(data, np.uint8), p.window)
            digest += [xxhash.xxh3_64_intdigest(data[x:y]) for x, y in zip(start.tolist(), stop.tolist())]
            text_key = xxhash.xxh3_64_intdigest(data)
            key = doc_id if doc_id is not None else NO_ID + (text_key >> 2)
            seq = np.arange(len(start))
            for c, v in zip(cols, (np.full(len(start), key, np.int64), np.full(len(start), text_key, np.uint64).view(np.int64), seq, seq == len(start) - 1, start, stop, words)):
                c.append(v)
        whole = [np.concatenate(c) if c else np.empty(0, np.int64) for c in cols]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(digest, np.uint64).view(np.int64)), *(pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(whole, kinds))],
            names=["digest", "dkey", "text_key", "seq", "final", "start", "stop", "words"],
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "digest long, dkey long, text_key long, seq int, final boolean, start int, stop int, words int")


def duplicate_spans(docs: DataFrame, params: ChunkParams | None = None) -> DataFrame:
    """(doc_id, start, stop, n_words, first_doc_id, first_doc_ids, text_hash): spans that a smaller doc_id has too.

    start and stop are UTF-8 byte offsets; first_doc_id is the smallest of the
    documents that have a chunk of the span first, first_doc_ids lists them.
    The document of the smallest id keeps a passage and gives no row for it.
    A span has ``min_words`` words at least or is a whole document, as in exact
    copies of short ones.
    Repeats within one document are no duplicates, nor are repeated rows of
    one doc_id; of several texts with one doc_id each has its own spans, told
    apart by text_hash (xxhash3 of the text), and none is a duplicate of
    another; rows with a NULL doc_id are told apart by their text and come
    last. NULL and empty texts have no chunk; an empty table gives no rows.
    Other columns are not read. Ids are below 2**62.
    """
    p = params or ChunkParams()
    own = materialise(chunks(docs, p))
    # partly aggregated in each map task, so a chunk that a third of all rows have is no hot key
    shared = materialise(
        own.groupBy("digest").agg(F.min("dkey").alias("first"), F.max("dkey").alias("last")).where("first <> last").select("digest", "first")
    )
    repeated = own.join(shared, "digest").where("dkey <> first").drop("digest").distinct()
    island = F.col("seq") - F.row_number().over(Window.partitionBy("dkey", "text_key").orderBy("seq", "start", "first"))
    spans = (
        repeated.withColumn("island", island).groupBy("dkey", "text_key", "island")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("words").alias("n_words"),
             (F.min("seq") == 0).alias("from_start"), F.bool_or("final").alias("to_end"),
             F.min("first").alias("first"), F.sort_array(F.collect_set(F.when(F.col("first") < NO_ID, F.col("first")))).alias("first_doc_ids"))
        .where((F.col("n_words") >= p.min_words) | (F.col("from_start") & F.col("to_end")))
    )
    known = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return spans.select(known("dkey").alias("doc_id"), "start", "stop", "n_words", known("first").alias("first_doc_id"), "first_doc_ids", F.col("text_key").alias("text_hash"))


def drop_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with its duplicate spans cut out of ``text``; other rows and columns as they are.

    Rows are met by doc_id and text; those with a NULL doc_id are left alone.
    """
    cuts = spans.where("doc_id is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.sort_array(F.collect_list(F.struct("start", "stop", "text_hash"))).alias("__cuts"))

    @F.pandas_udf("string")
    def cut(text, ranges):
        import pandas as pd

        out = []
        for t, r in zip(text, ranges):
            if t is not None and r is not None:
                data, kept, at = t.encode("utf-8", "surrogatepass"), [], 0
                own = int(np.array([xxhash.xxh3_64_intdigest(data)], np.uint64).view(np.int64)[0])
                for x in (x for x in r if x["text_hash"] == own):
                    kept.append(data[at : x["start"]])
                    at = max(at, x["stop"])
                t = b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
            out.append(t)
        return pd.Series(out)

    joined = docs.join(cuts, docs["doc_id"].cast("long") == F.col("__id"), "left")
    return joined.select(*[cut(F.col("text").cast("string"), F.col("__cuts")).alias("text") if c == "text" else F.col(c) for c in docs.columns])
