"""Phrase collocations by multikey three-way quicksort of suffix pointers.

A suffix is a word position and the up to four words from there to the end of
its piece. Words that are too rare for any phrase end a suffix. All suffixes
of the corpus are routed by their leading words, so that a task has every
suffix of a leading pair; it sorts pointers to them word by word with the
three-way quicksort, down to the greatest depth. The sizes of the partitions
of equal words are the phrases' counts, and a partition that has become
smaller than the least count is abandoned.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from servicelens.llm.common import materialise, texts

#: Words of a block of documents (a longer document is a block of its own).
BLOCK_WORDS = 1 << 20
#: Suffixes that a bucket has on average, at most.
BUCKET_ROWS = 250_000
#: Bytes that end a piece, and those between words; a dot alone stands for all ends.
TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b".......... ")


@dataclass(frozen=True)
class PhraseParams:
    #: Words of the longest phrase.
    depth: int = 4
    #: Occurrences of a phrase, at least.
    least: int = 30
    #: Units of the score, which is at most half of them.
    scale: int = 2_000_000
    #: A phrase is dropped if a longer one around it has so many percent of its occurrences.
    covered_percent: int = 80
    #: Phrases reported a language.
    top: int = 2000
    #: A leading pair is dealt over many tasks if it has a share of 1 in so many of the words; there are no more of these than that.
    split: int = 8192


# ------------------------------------------------------------------ the sort
def multikey_counts(words: np.ndarray, weight: np.ndarray, least: int, abandon_from: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of equal leading words, by three-way quicksort of pointers to the rows of ``words``.

    A row is a suffix, padded with 0. For each number of words up to the width
    there is (prefixes, counts): the prefixes of so many words that weigh
    ``least`` or more. Before word ``abandon_from`` (from 0) nothing is too
    light. All partitions of one depth are split in one step: each takes its
    middle suffix as pivot and deals its pointers into smaller, equal and
    greater words. Equal ones go on with the next word, the others again with
    the same, and those too light not at all.
    """
    found = []
    at, size = np.arange(len(words)), np.full(min(1, len(words)), len(words))
    for depth in range(words.shape[1]):
        need = least if depth >= abandon_from else 0
        deeper, deeper_size, prefixes, counts = [], [], [], []
        while len(at):
            part = np.repeat(np.arange(len(size)), size)
            key = words[at, depth]
            pivot = key[np.cumsum(size) - size + size // 2]
            side = np.sign(key - pivot[part])
            again, again_size = [], []
            for s in (-1, 0, 1):
                mine = side == s
                pointers, number = at[mine], np.bincount(part[mine], minlength=len(size))
                total = np.bincount(part[mine], weights=weight[pointers], minlength=len(size)).astype(np.int64)
                on = (number > 0) & (total >= need) & ((s != 0) | (pivot > 0))
                kept, number_kept = pointers[np.repeat(on, number)], number[on]
                if s:
                    again.append(kept)
                    again_size.append(number_kept)
                elif len(kept):
                    prefixes.append(words[kept[np.cumsum(number_kept) - number_kept], : depth + 1])
                    counts.append(total[on])
                    deeper.append(kept)
                    deeper_size.append(number_kept)
            at, size = np.concatenate(again), np.concatenate(again_size)
        found.append((np.concatenate(prefixes), np.concatenate(counts)) if prefixes else (words[:0, : depth + 1], np.empty(0, np.int64)))
        at, size = (np.concatenate(deeper), np.concatenate(deeper_size)) if deeper else (at[:0], size[:0])
    return found


def merged(words: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows once, with their weights summed."""
    if not len(words):
        return words, weight
    words = np.ascontiguousarray(words)
    keys = words.view(np.uint64) if words.shape[1] * words.itemsize % 8 == 0 else words
    order = np.lexsort(keys.T)
    words, weight = words[order], weight[order]
    new = np.flatnonzero(np.append(True, (words[1:] != words[:-1]).any(1)))
    return words[new], np.add.reduceat(weight, new)


# ------------------------------------------------------------------ jobs
def word_blocks(docs: DataFrame, split: int) -> DataFrame:
    """(block, lang, word, second, code, n, line): what later jobs read of each block of documents.

    There is a row for each word and language with its count; a row for each
    pair of words, ``second`` being the other one, with a share of 1 in ``split``
    or more of the block's words; and a row with all codes in ``line``. Codes
    count from 1 within the block; 0 stands for the end of a piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = count(TaskContext.get().partitionId() << 32)
        codes, numbers, lines, size = {}, count(1), [], 0

        def out(block: int, size: int, **cols) -> pa.RecordBatch:
            kinds = {"lang": pa.string(), "word": pa.string(), "second": pa.string(), "code": pa.int64(), "n": pa.int64(), "line": pa.binary()}
            return pa.RecordBatch.from_pydict({"block": pa.array(np.full(size, block, np.int64)), **{
                c: pa.array(cols[c], pa.binary()).cast(kind) if c in ("word", "second") and c in cols else pa.array(cols[c], kind) if c in cols else pa.nulls(size, kind)
                for c, kind in kinds.items()}})

        def close() -> Iterator[pa.RecordBatch]:
            block, line = next(blocks), np.concatenate(lines)
            times, text, of_lang = np.bincount(line, minlength=next(numbers)), {}, {}
            for lang, own in codes.items():
                words = [w for w in own if w != b"."]
                for i in range(0, len(words), 50_000):
                    part = words[i : i + 50_000]
                    code = np.array([own[w] for w in part], np.int64)
                    yield out(block, len(part), lang=[lang] * len(part), word=part, code=code, n=times[code])
                text.update((own[w], w) for w in words)
                of_lang.update((own[w], lang) for w in words)
            pair, n = np.unique((line[:-1] << 32 | line[1:])[(line[:-1] > 0) & (line[1:] > 0)], return_counts=True)
            heavy = n * split >= len(line)
            a, b = (pair[heavy] >> 32).tolist(), (pair[heavy] & 0xFFFFFFFF).tolist()
            yield out(block, len(a), lang=[of_lang[x] for x in a], word=[text[x] for x in a], second=[text[x] for x in b], n=n[heavy])
            yield out(block, 1, line=[line.astype("<i4").tobytes()])

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), texts(b)):
                data = (text or "").encode().lower().translate(TABLE).replace(b".", b" . ").split()
                if not data:
                    continue
                if lang not in codes:
                    codes[lang] = defaultdict(numbers.__next__, {b".": 0})
                lines.append(np.fromiter(map(codes[lang].__getitem__, data), np.int64, len(data)))
                lines.append(np.zeros(1, np.int64))
                size += len(data)
                if size >= BLOCK_WORDS:
                    yield from close()
                    codes, numbers, lines, size = {}, count(1), [], 0
        if lines:
            yield from close()

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "block long, lang string, word string, second string, code long, n long, line binary")


def frequent_words(blocks: DataFrame, least: int) -> DataFrame:
    """(id, lang, word, f): the words that occur ``least`` times in a language, numbered from 1 with few gaps."""
    counted = blocks.where("code is not null").groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    rows = materialise(counted.withColumn("m", F.monotonically_increasing_id()))  # the part's number, and the row's in the part
    parts = rows.select(F.max(F.shiftright("m", 33)) + 1).scalar()
    number = F.col("m").bitwiseAND(F.lit((1 << 33) - 1)) * parts + F.shiftright("m", 33) + 1
    return materialise(rows.select(number.alias("id"), "lang", "word", "f"))


def heavy_pairs(blocks: DataFrame, words: DataFrame, total: int, split: int) -> np.ndarray:
    """Leading pairs, as ids, that one task should not have alone; at most ``split`` of them.

    A pair counts by the blocks where its share is 1 in ``split``, so all others
    have fewer than twice that share of the corpus.
    """
    told = blocks.where("second is not null").groupBy("lang", "word", "second").agg(F.sum("n").alias("n")).where(F.col("n") * split >= total)
    second = words.select("lang", F.col("word").alias("second"), F.col("id").alias("b"))
    got = told.join(words.select("lang", "word", F.col("id").alias("a")), ["lang", "word"]).join(second, ["lang", "second"]).select("a", "b").collect()
    return np.array([(r["a"], r["b"]) for r in got], np.int64).reshape(-1, 2)


def suffixes(line: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of at least two words: a row each, padded with 0 from the end of the piece on."""
    padded = np.append(line, np.zeros(depth, line.dtype))
    head = np.flatnonzero((padded[: len(line)] > 0) & (padded[1 : len(line) + 1] > 0))
    rows = np.empty((len(head), depth), line.dtype)
    rows[:, 0], rows[:, 1] = padded[head], padded[head + 1]
    for k in range(2, depth):
        rows[:, k] = np.where(rows[:, k - 1] > 0, padded[head + k], 0)
    return rows


def _hash(words: np.ndarray) -> np.ndarray:
    """A number of each row; equal rows have equal ones."""
    h = np.zeros(len(words), np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def routed_suffixes(blocks: DataFrame, words: DataFrame, heavy: np.ndarray, buckets: int, kind: str, p: PhraseParams) -> DataFrame:
    """(bucket, deep, suffixes, weights): the distinct suffixes of a block with their counts, by bucket of the leading pair.

    Suffixes of heavy pairs are dealt by all their words and are ``deep``:
    a bucket has all of a whole suffix then, but not all of its pair.
    """
    ids = blocks.where("code is not null").select("block", "lang", "word", "code").join(words, ["lang", "word"]).select("block", "code", "id")
    lines = blocks.where("line is not null").select(F.col("block").alias("at"), "line")
    apart = np.sort(_hash(heavy))

    def run(line: pa.Table, known: pa.Table) -> pa.Table:
        rows, weight = np.empty((0, p.depth), kind), np.empty(0, np.int64)
        if line.num_rows and known.num_rows:
            codes = np.frombuffer(line.column("line")[0].as_py(), "<i4")
            of = np.zeros(int(codes.max()) + 1, kind)
            of[known.column("code").to_numpy()] = known.column("id").to_numpy()
            rows = suffixes(of[codes], p.depth)
            rows, weight = merged(rows, np.ones(len(rows), np.int64))
        pair = _hash(rows[:, :2])
        deep = np.zeros(len(rows), bool)
        if len(apart):
            deep = apart[np.minimum(np.searchsorted(apart, pair), len(apart) - 1)] == pair
        bucket = (np.where(deep, _hash(rows), pair) % np.uint64(buckets)).astype(np.int64) * 2 + deep
        order = np.argsort(bucket, kind="stable")
        rows, weight, bucket = rows[order], weight[order].astype("<i4"), bucket[order]
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = [*cut[1:].tolist(), len(rows)]
        return pa.table({
            "bucket": pa.array(bucket[cut] // 2, pa.int64()), "deep": pa.array(bucket[cut] % 2 == 1),
            "suffixes": pa.array([rows[a:b].tobytes() for a, b in zip(cut.tolist(), ends)], pa.binary()),
            "weights": pa.array([weight[a:b].tobytes() for a, b in zip(cut.tolist(), ends)], pa.binary())})

    return lines.groupBy("at").cogroup(ids.groupBy("block")).applyInArrow(run, "bucket long, deep boolean, suffixes binary, weights binary")


def phrase_counts(routed: DataFrame, kind: str, p: PhraseParams) -> DataFrame:
    """(w0, w1, ..., f): the ids of each phrase of two words or more, 0 after its end, and its count if that is ``least`` or more."""
    names = [f"w{k}" for k in range(p.depth)]

    def run(t: pa.Table) -> pa.Table:
        out, counts = [np.empty((0, p.depth), np.int64)], [np.empty(0, np.int64)]
        for deep in (False, True):
            own = t.filter(pc.equal(t.column("deep"), deep))
            rows = np.frombuffer(b"".join(own.column("suffixes").to_pylist()), kind).reshape(-1, p.depth)
            weight = np.frombuffer(b"".join(own.column("weights").to_pylist()), "<i4")
            # the counts of a deep suffix's first words are parts of a sum, so that nothing before its last word is too light
            for prefix, n in multikey_counts(rows, weight, p.least, p.depth - 1 if deep else 0)[1:]:
                out.append(np.pad(prefix.astype(np.int64), ((0, 0), (0, p.depth - prefix.shape[1]))))
                counts.append(n)
        whole = np.concatenate(out)
        return pa.table({**{c: pa.array(whole[:, k]) for k, c in enumerate(names)}, "f": pa.array(np.concatenate(counts))})

    found = routed.groupBy("bucket").applyInArrow(run, ", ".join(f"{c} long" for c in [*names, "f"]))
    return found.groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= p.least)


def _phrase(ids: list[Column], depth: int) -> Column:
    """The ids as a key, padded with 0."""
    return F.struct(*[(ids[k] if k < len(ids) else F.lit(0).cast("long")).alias(f"w{k}") for k in range(depth)])


def collocations(docs: DataFrame, params: PhraseParams | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``depth`` words.

    a counts the phrase's occurrences within pieces, n all words of the
    language. The phrase is cut in two where floor(scale * a / (l + r)) is
    least (then at the first word possible), l and r being the counts of the
    two sides; that is its score. A phrase inside a longer one with
    ``covered_percent`` of its occurrences is dropped. Ranks are by score, a
    and the phrase in UTF-8 order.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends; words stand
    between spaces and tabs. A NULL text is empty, a NULL lang ``und``.
    Repeated rows count each, ids are not read, nor are other columns. An
    empty table, or one without a frequent phrase, gives no rows.
    """
    p = params or PhraseParams()
    spark = docs.sparkSession
    blocks = materialise(word_blocks(docs, p.split))
    words = frequent_words(blocks, p.least)
    langs = blocks.where("code is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    total = langs.agg(F.sum("n")).first()[0] or 0
    most = words.agg(F.max("id")).first()[0] or 0
    kind = "<i4" if most < 1 << 31 else "<i8"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ROWS), 1)
    found = materialise(phrase_counts(routed_suffixes(blocks, words, heavy_pairs(blocks, words, total, p.split), buckets, kind, p), kind, p))

    ids = [F.col(f"w{k}") for k in range(p.depth)]
    size = sum(F.when(w > 0, 1).otherwise(0) for w in ids)
    phrases = found.select(_phrase(ids, p.depth).alias("key"), *ids, size.alias("size"), F.col("f").alias("a"))
    counts = phrases.select("key", F.col("a").alias("f")).unionAll(words.select(_phrase([F.col("id")], p.depth).alias("key"), "f"))
    # the phrases around each one
    inner = [F.when(F.col("size") > m, F.when(ids[o + m - 1] > 0, _phrase(ids[o : o + m], p.depth))) for m in range(2, p.depth) for o in range(p.depth - m + 1)]
    kept = phrases
    if inner:
        around = phrases.select("a", F.explode(F.array_compact(F.array(*inner))).alias("key")).groupBy("key").agg(F.max("a").alias("longer"))
        covered = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * p.covered_percent
        kept = phrases.join(around, "key", "left").where(F.col("longer").isNull() | ~covered).drop("longer")
    cuts = F.array_compact(F.array(*[
        F.when(ids[k] > 0, F.struct(F.lit(k).alias("k"), _phrase(ids[:k], p.depth).alias("first"), _phrase(ids[k:], p.depth).alias("rest"))) for k in range(1, p.depth)]))
    cut = kept.select("key", "a", F.explode(cuts).alias("cut")).select("key", "a", "cut.*")
    cut = cut.join(counts.select(F.col("key").alias("first"), F.col("f").alias("l")), "first").join(counts.select(F.col("key").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.call_function("div", F.lit(p.scale).cast("decimal(18,0)") * F.col("a").cast("decimal(19,0)"), (F.col("l") + F.col("r")).cast("decimal(19,0)"))
    best = cut.groupBy("key", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("best"))
    # the words of what is left
    at = best.select("key", "a", "best", F.posexplode(F.array(*[F.col(f"key.w{k}") for k in range(p.depth)])).alias("at", "id")).where("id > 0")
    named = at.join(words.select("id", "lang", "word"), "id").groupBy("key", "a", "best").agg(
        F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    by = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= p.top)
    return ranked.join(langs, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))
