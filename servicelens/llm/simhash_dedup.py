"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at a distance of at most 2r share a variant within r bits of
both. Each distinct fingerprint emits all its variants within half the radius;
they are shuffled by the leading bits of the variant, so that one row stands
for all variants of a fingerprint that begin alike, and the receiving task
writes these out and meets equal ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.llm.common import free_names, materialise, texts
from servicelens.llm.components import connected_components

BITS = 64
SEED = 42
#: Shingles whose bits are counted at a time; bounds the memory of one very long text.
STEP = 1 << 16
#: Heads that a bucket has on average, at most.
BUCKET = 1 << 16
#: Variants that a task holds at a time; larger buckets are cut by further leading bits.
VARIANTS = 1 << 22


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """Unsigned XXH64 (seed 42) of each run of ``words`` words, in order, repeats included.

    A-Z are lower-cased; words are runs of other bytes than 20 and 09-0D hex.
    A text with fewer words gives one hash, of all its words; none give none.
    """
    toks = text.encode("utf-8", "surrogatepass").lower().split()
    if not toks:
        return np.empty(0, np.uint64)
    joined = b" ".join(toks)
    if len(toks) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, toks), np.int64, len(toks)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(toks) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the hashes have it; no hashes give zero."""
    if not len(hashes):
        return 0
    count = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), STEP):
        count += np.unpackbits(hashes[i : i + STEP].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long. A NULL text counts as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(shingle_hashes(t or "", words)) for t in texts(b)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _masks(bits: int, most: int, shift: int = 0) -> np.ndarray:
    """All masks with up to ``most`` set bits of the ``bits`` bits from ``shift`` on."""
    out = [sum(1 << (shift + i) for i in c) for k in range(most + 1) for c in combinations(range(bits), k)]
    return np.array(out, np.uint64)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _variants(fps: np.ndarray, head: int, known: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """All variants of ``fps`` within ``half`` bits whose first ``known`` bits are ``head``, with their owners."""
    low = BITS - known
    base = (fps & np.uint64((1 << low) - 1)) | np.uint64(head << low) if known else fps
    left = half - _popcount(base ^ fps)
    made, owner = [], []
    for k in range(half + 1):
        own = np.flatnonzero(left == k)
        if len(own):
            m = _masks(low, k)
            made.append((base[own][:, None] ^ m[None, :]).ravel())
            owner.append(np.repeat(own, len(m)))
    return np.concatenate(made), np.concatenate(owner)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member index of each of n nodes' groups under the links a-b."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _links(fps: np.ndarray, head: int, known: int, half: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join all fingerprints of a bucket which meet in one of its variants."""
    left = half - _popcount((fps >> np.uint64(BITS - known)) ^ np.uint64(head)) if known else np.full(len(fps), half)
    fps, left = fps[left >= 0], left[left >= 0]
    if len(fps) < 2:
        return []
    low = BITS - known
    room = np.array([1, 1 + low, 1 + low + low * (low - 1) // 2] + [len(_masks(low, k)) for k in range(3, half + 1)])
    if low and int(room[left].sum()) > VARIANTS:  # the same by further leading bits
        step = min(4, low)
        return [x for nxt in range(1 << step) for x in _links(fps, (head << step) | nxt, known + step, half)]
    made, owner = _variants(fps, head, known, half)
    order = np.argsort(made, kind="stable")
    made, owner = made[order], owner[order]
    same = made[1:] == made[:-1]
    if not same.any():
        return []
    a, b = owner[:-1][same], owner[1:][same]
    near = _popcount(fps[a] ^ fps[b]) <= 2 * half  # verify
    pair = np.unique(np.minimum(a, b)[near] * len(fps) + np.maximum(a, b)[near])
    root = _forest(len(fps), pair // len(fps), pair % len(fps))
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return [(fps[moved], fps[root[moved]])]


def head_bits(n: int, distance: int, least: int = 14, most: int = 30) -> int:
    """Leading bits that give a bucket at most ``BUCKET`` of the variants' heads of ``n`` fingerprints, on average.

    Any number of bits gives the same links; more of them mean smaller
    buckets, and more rows a fingerprint (106 at 14 bits, 466 at 30).
    """
    bits = least
    while bits < most and n * len(_masks(bits, distance // 2)) > BUCKET << bits:
        bits += 1
    return bits


def ball_links(fps: DataFrame, distance: int = 4, prefix_bits: int = 14) -> DataFrame:
    """Distinct ``fp`` -> (u, v), links which connect all fingerprints within ``distance`` bits.

    ``distance`` must be even. Fingerprints that meet in one variant are all
    within ``distance`` of each other, so the links of a bucket are thinned to
    a spanning forest: connectivity is kept, pairs within a large group are
    never all emitted.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    half = distance // 2
    heads = F.array(*[F.lit(int(m)) for m in _masks(prefix_bits, half)])
    rows = (
        fps.select("fp", F.explode(heads).alias("m"))
        .select(F.shiftrightunsigned("fp", BITS - prefix_bits).bitwiseXOR(F.col("m")).cast("int").alias("bucket"), "fp")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()

        def out(head: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for u, v in _links(np.unique(np.concatenate(held)), head, prefix_bits, half):
                new = [p for p in zip(u.view(np.int64).tolist(), v.view(np.int64).tolist()) if p not in seen]
                if len(seen) > 1 << 20:
                    seen.clear()
                seen.update(new)
                if new:
                    yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in new], pa.int64()) for i in (0, 1)], names=["u", "v"])

        head, held = None, []
        for b in batches:
            buckets = b.column("bucket").to_numpy()
            values = b.column("fp").to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.diff(buckets)) + 1
            for part, value in zip(np.split(buckets, cuts), np.split(values, cuts)):
                if not len(part):
                    continue
                if head is not None and part[0] != head:
                    yield from out(head, held)
                    held = []
                head = int(part[0])
                held.append(value.copy())
        if held:
            yield from out(head, held)

    return rows.mapInArrow(meet, "u long, v long")


def simhash_groups(docs: DataFrame, words: int = 4, distance: int = 4) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all documents, and the group of each distinct fingerprint.

    Returns ``(rows, groups)``: rows (doc_id, fp) with one row for each row of
    ``docs``, and groups (fp, rep, label, component_id). ``rep`` is the
    smallest doc_id with that fingerprint, ``label`` the smallest fingerprint
    of the group and ``component_id`` its smallest doc_id (NULL ids are passed
    over; NULL if the group has no other).
    """
    rows = materialise(fingerprints(docs, words))
    reps = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    links = materialise(ball_links(reps, distance, head_bits(reps.count(), distance)))
    labels = materialise(connected_components(links).select(F.col("node").alias("fp"), "label"))
    grouped = materialise(labels.join(reps, "fp"))
    least = materialise(grouped.groupBy("label").agg(F.min("rep").alias("component_id")))
    grouped = materialise(grouped.join(least, "label").select("fp", "label", "component_id"))
    groups = reps.join(grouped, "fp", "left").select(
        "fp", "rep", F.coalesce("label", "fp").alias("label"),
        F.when(F.col("label").isNull(), F.col("rep")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return rows, materialise(groups)


def simhash_dedup(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) for each row of ``docs``.

    Repeated rows each get their row; NULL and empty texts have the
    fingerprint zero and are linked like any other; a NULL doc_id keeps its
    row and never becomes a component_id unless its group has no other id
    (component_id is NULL then). An empty table gives no rows. Other columns
    are not read.
    """
    rows, groups = simhash_groups(docs, words, distance)
    return rows.join(groups.select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_representatives(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest doc_id.

    All columns are kept as they are. Rows whose doc_id is NULL or occurs more
    than once are told apart by their fingerprint, and one row of each kept
    (doc_id, fingerprint) stays. Extra columns may have any names.
    """
    rows, groups = simhash_groups(docs, words, distance)
    own, kept, of = free_names(docs, "__id", "__fp", "__of")
    keepers = materialise(
        groups.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "fp")).alias("k"))
        .select(F.col("k.rep").alias(own), F.col("k.fp").alias(kept))
    )
    odd = materialise(
        rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias(own))
    )
    if odd.isEmpty():
        return docs.join(keepers.select(own), docs["doc_id"].cast("long") == F.col(own), "left_semi")
    names = docs.columns
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own))
    plain = docs.join(odd, same, "left_anti").join(keepers.select(own), F.col("doc_id").cast("long") == F.col(own), "left_semi")

    @F.pandas_udf("long")
    def fp(text):
        return text.map(lambda t: int(np.uint64(fingerprint(shingle_hashes(t or "", words))).view(np.int64)))

    repeated = (
        docs.join(odd, same, "left_semi").withColumn(of, fp(F.col("text").cast("string")))
        .join(keepers, same & (F.col(of) == F.col(kept)), "left_semi")
        .dropDuplicates(["doc_id", of]).select(*names)
    )
    return plain.unionByName(repeated)
