"""Benchmark decontamination: SimHash windows, multi-index Hamming blocks, exact verification.

Windows as long as a benchmark item slide over each document. A window that
shares no shingle with an item has the similarity zero to it, so windows are
fingerprinted wherever they touch a shingle of an item of their length.
Fingerprints within the radius agree to within radius // blocks bits in at
least one block; tables of each block give all such items. Those within the
radius are verified by the exact similarity of the shingle counts.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens.llm.common import free_names, materialise, texts
from servicelens.llm.simhash_dedup import BITS, fingerprint, shingle_hashes
from servicelens.llm.token_files import storage
from servicelens.session import ensure_checkpoint_dir

FILTER_BITS = 20
#: Windows fingerprinted at a time.
STEP = 4096


@dataclass(frozen=True)
class LeakParams:
    words: int = 5
    similarity: float = 0.8
    #: 64 x the angle of two texts with a similarity of 0.8 is under 10 bits; 23 is over four deviations more.
    radius: int = 23
    blocks: int = 8
    #: Items, and characters of items, that one pass over the documents takes along.
    items_a_pass: int = 5000
    chars_a_pass: int = 1 << 24


def count_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over the sum of the larger shingle counts."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both / max(1, len(a) + len(b) - both)


@dataclass
class ItemClass:
    """Items of one shingle length and number of shingles, with their block tables."""

    size: int
    items: list[int] = field(default_factory=list)
    fps: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    near: np.ndarray = field(default_factory=lambda: np.empty(0, bool))

    def close(self, fps: list[int], p: LeakParams) -> None:
        self.fps = np.array(fps, np.uint64)
        width = BITS // p.blocks
        values = np.arange(1 << width, dtype=np.uint64)
        part = np.stack([(self.fps >> np.uint64(width * b)) & np.uint64((1 << width) - 1) for b in range(p.blocks)])
        self.near = np.bitwise_count(values[None, :, None] ^ part[:, None, :]) <= p.radius // p.blocks

    def candidates(self, fps: np.ndarray, p: LeakParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius."""
        width = BITS // p.blocks
        met = np.zeros((len(fps), len(self.items)), bool)
        for b in range(p.blocks):
            met |= self.near[b][((fps >> np.uint64(width * b)) & np.uint64((1 << width) - 1)).astype(np.int64)]
        w, t = np.nonzero(met)
        far = np.bitwise_count(fps[w] ^ self.fps[t])
        ok = far <= p.radius
        return w[ok], t[ok], far[ok]


class LeakIndex:
    """Items of one pass: their shingles, inverted, and their classes by length."""

    def __init__(self, items: list[tuple[int, str]], p: LeakParams):
        self.p = p
        self.ids: list[int] = []
        self.hashes: list[np.ndarray] = []
        own: dict[int, list[tuple[int, int]]] = {}
        self.classes: dict[tuple[int, int], ItemClass] = {}
        fps: dict[tuple[int, int], list[int]] = {}
        for item_id, text in items:
            n = len(text.encode("utf-8", "surrogatepass").split())
            if not n:
                continue
            k, i = min(n, p.words), len(self.ids)
            h = shingle_hashes(text, k)
            self.ids.append(item_id)
            self.hashes.append(h)
            own.setdefault(k, []).extend((int(x), i) for x in set(h.tolist()))
            c = self.classes.setdefault((k, len(h)), ItemClass(len(h)))
            c.items.append(i)
            fps.setdefault((k, len(h)), []).append(fingerprint(h))
        for key, c in self.classes.items():
            c.close(fps[key], p)
        self.inverted = {}
        for k, pairs in own.items():
            pairs.sort()
            h = np.array([x for x, _ in pairs], np.uint64)
            uniq, first = np.unique(h, return_index=True)
            flags = np.zeros(1 << FILTER_BITS, bool)
            flags[(uniq & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
            self.inverted[k] = (uniq, np.append(first, len(h)), np.array([i for _, i in pairs]), flags)

    def leaks(self, text: str) -> list[tuple[int, float, int, int, int]]:
        """(item_id, similarity, distance, first word, words) of the best window for each item that leaks."""
        best: dict[int, tuple[float, int, int]] = {}
        for k, (uniq, first, items, flags) in self.inverted.items():
            h = shingle_hashes(text, k)
            at = np.flatnonzero(flags[(h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
            where = np.searchsorted(uniq, h[at])
            found = uniq[np.minimum(where, len(uniq) - 1)] == h[at]
            at, where = at[found], where[found]
            if not len(at):
                continue
            touched: dict[int, list[np.ndarray]] = {}
            for pos, s in zip(at.tolist(), where.tolist()):
                for i in items[first[s] : first[s + 1]].tolist():
                    touched.setdefault(len(self.hashes[i]), []).append(pos)
            for size, hits in touched.items():
                self._windows(h, self.classes[k, size], np.unique(hits), best)
        return [(self.ids[i], sim, far, s, len(self.hashes[i])) for i, (sim, far, s) in sorted(best.items())]

    def _windows(self, h: np.ndarray, c: ItemClass, hits: np.ndarray, best: dict[int, tuple[float, int, int]]) -> None:
        n = min(c.size, len(h))  # a shorter document is one window
        mark = np.zeros(len(h) + 2, np.int64)
        np.add.at(mark, np.maximum(hits - n + 1, 0), 1)
        np.add.at(mark, hits + 1, -1)
        starts = np.flatnonzero(np.cumsum(mark)[: len(h) - n + 1] > 0)
        for i in range(0, len(starts), STEP):
            part = starts[i : i + STEP]
            for run in np.split(part, np.flatnonzero(np.diff(part) > n) + 1):
                fps = window_fingerprints(h[run[0] : run[-1] + n], run - run[0], n)
                for w, t, far in zip(*c.candidates(fps, self.p)):
                    item, s = c.items[t], int(run[w])
                    if item in best and best[item][0] == 1.0:
                        continue
                    sim = count_similarity(h[s : s + n], self.hashes[item])
                    if sim >= self.p.similarity and (item not in best or sim > best[item][0]):
                        best[item] = (sim, int(far), s)


def window_fingerprints(h: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the windows of ``n`` hashes, from running bit counts."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    run = np.zeros((len(h) + 1, BITS), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=run[1:])
    return np.packbits(2 * (run[starts + n] - run[starts]) > n, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def item_passes(benchmark: DataFrame, p: LeakParams) -> list[str]:
    """The benchmark's indexes, in blocks of bounded size, as files below the shared checkpoint folder.

    A task takes the items of a block and writes their index; only the names
    of the files reach the driver. The number of blocks follows the number and
    length of the items, so no item is left out however many there are. A
    task that runs again writes a file of its own.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    n, chars = items.select(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    passes = max(1, -(-n // p.items_a_pass), -(-chars // p.chars_a_pass))
    folder = f"{ensure_checkpoint_dir(benchmark.sparkSession)}/{uuid.uuid4().hex}"
    system, root = storage(folder)
    system.create_dir(root, recursive=True)

    def build(t: pa.Table) -> pa.Table:
        rows = sorted(zip(t.column("item_id").to_pylist(), t.column("text").to_pylist()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        path = f"{folder}/{uuid.uuid4().hex}.index"
        system, name = storage(path)
        with system.open_output_stream(name) as f:
            f.write(pickle.dumps(LeakIndex(rows, p), pickle.HIGHEST_PROTOCOL))
        return pa.table({"block": t.column("block").slice(0, 1), "path": pa.array([path], pa.string())})

    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)).alias("block")
    built = items.select(block, "item_id", "text").groupBy("block").applyInArrow(build, "block long, path string")
    return [r.path for r in built.orderBy("block").collect()]


@lru_cache(maxsize=1)
def load_index(path: str) -> LeakIndex:
    """An index that ``item_passes`` wrote; a worker holds one at a time."""
    system, name = storage(path)
    with system.open_input_stream(name) as f:
        return pickle.loads(f.read())


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams | None = None) -> DataFrame:
    """(doc_id, item_id, similarity, distance, first_word, n_shingles) of each document that holds an item.

    One row for each row of ``docs`` and item: its best window, the first of
    equally good ones. Documents without a leak give no row; so do NULL and
    empty texts, and NULL or empty items. Items of under five words are one
    shingle and match as a whole. Repeated rows each get their rows, repeated
    items count once; ids may be NULL and are passed on. An empty table on
    either side gives no rows. Other columns are not read.
    """
    p = params or LeakParams()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, similarity double, distance int, first_word long, n_shingles int"

    def searcher(path: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                index = load_index(path)
                rows = [(d, *x) for d, t in zip(b.column("doc_id").to_pylist(), texts(b)) if t for x in index.leaks(t)]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int32())
                cols = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in schema.split(", ")])

        return run

    result = docs.sparkSession.createDataFrame([], schema)
    for path in item_passes(benchmark, p):
        result = result.unionByName(source.mapInArrow(searcher(path), schema))
    return result


def drop_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams | None = None) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are.

    A benchmark of several passes is met by numbered rows, written once: each
    pass gives the numbers of the rows that leak, so a task holds the index of
    one pass. Extra columns may have any names.
    """
    paths = item_passes(benchmark, params or LeakParams())

    def leaks_in(path: str, text: Column) -> Column:
        @F.pandas_udf("boolean")
        def leaks(t):
            index = load_index(path)
            return t.map(lambda x: bool(x) and bool(index.leaks(x)))

        return leaks(F.coalesce(text.cast("string"), F.lit("")))

    if len(paths) < 2:
        for path in paths:
            docs = docs.where(~leaks_in(path, F.col("text")))
        return docs
    row, hit = free_names(docs, "__row", "__hit")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()))
    hits = reduce(DataFrame.unionByName, [rows.where(leaks_in(path, F.col("text"))).select(F.col(row).alias(hit)) for path in paths])
    return rows.join(materialise(hits), F.col(row) == F.col(hit), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
