"""Audit of how the sources of a language differ, by chunk factorization.

Each document's whitespace chunks are counted; every globally distinct chunk is
cut into terms once; its terms are joined back, and give each term's documents
and occurrences. From these come smoothed term shares of each source and of
each language, and from the shares a chi-squared-like distance.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from servicelens.llm.common import materialise, texts

#: Letters of ASCII and all that is not ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
FOUND = re.compile(TERM).findall
#: A block of documents is closed at so many distinct chunks of each; a task merges so many rows at a time.
BLOCK_CHUNKS, MERGED_ROWS = 1 << 21, 100_000
#: Pairs of sources that a task sums at a time.
PAIRS = 1 << 19


@dataclass(frozen=True)
class DivergenceParams:
    #: Documents of a language that a kept term is in, at least.
    min_docs: int = 3
    #: Units that a share is counted in.
    scale: int = 1_000_000_000
    #: Terms reported a group.
    top_terms: int = 200


def merged(keys: np.ndarray, docs: tuple, occ: tuple, most: int) -> tuple[np.ndarray, pa.ListArray, np.ndarray, np.ndarray, np.ndarray]:
    """One row for each of ``keys``: (first rows' numbers, documents, where its occurrences start, sources, n).

    ``docs`` is (row, document), ``occ`` is (row, source, n). A key's documents
    are distinct, the ``most`` smallest of them; n is summed by source. The
    smallest of some parts' smallest are the smallest of all, so that a count
    up to ``most`` is exact however often rows are merged.
    """
    _, first, key = np.unique(keys, return_index=True, return_inverse=True)
    key = key.astype(np.int32)  # a task's rows are far fewer than 2**31
    own, doc = key[docs[0]], docs[1]
    order = np.lexsort((doc, own))
    own, doc = own[order], doc[order]
    new = np.append(True, (own[1:] != own[:-1]) | (doc[1:] != doc[:-1]))[: len(own)]
    own, doc = own[new], doc[new]
    rank = np.arange(len(own)) - np.searchsorted(own, own)
    own, doc = own[rank < most], doc[rank < most]
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(len(first) + 1)), pa.int32()), pa.array(doc, pa.int64()))
    own, source = key[occ[0]], occ[1]
    order = np.lexsort((source, own))
    own, source = own[order], source[order]
    new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (source[1:] != source[:-1]))[: len(own)])
    n = np.add.reduceat(occ[2][order], new, dtype=np.int64) if len(new) else occ[2].astype(np.int64)
    return first, lists, np.searchsorted(own[new], np.arange(len(first) + 1)), source[new], n


def _rows(names: list[str], langs: pa.Array, words: pa.Array, docs: pa.ListArray, at: np.ndarray, sources: pa.Array, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    occ = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([sources, pa.array(n, pa.int64())], names=["source", "n"]))
    whole = pa.RecordBatch.from_arrays([langs, words, docs, occ], names=names)
    for i in range(0, whole.num_rows, 20_000):
        yield whole.slice(i, 20_000)


def chunk_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, chunk, docs, occ): a row for each chunk of a language in a block of documents.

    ``docs`` are up to ``min_docs`` of the documents that have the chunk,
    ``occ`` all its occurrences by source. Chunks are the lower-cased runs
    between ASCII white space, which no term spans. Documents are rows:
    repeated ones count each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 40)

        def fresh():
            return defaultdict(count().__next__), defaultdict(count().__next__), defaultdict(count().__next__), [], [], [], [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            entry = np.repeat(np.arange(len(codes), dtype=np.int32), [len(c) for c in codes])
            code, n = np.concatenate(codes), np.concatenate(counts)
            codes.clear()
            counts.clear()
            lang, source = np.array(doc_lang, np.int32)[entry], np.array(doc_source, np.int32)[entry]
            row = np.arange(len(code), dtype=np.int32)
            first, lists, at, by, total = merged(lang.astype(np.int64) * len(words) + code, (row, np.array(doc_number)[entry]), (row, source, n), min_docs)
            text = pa.array(list(words), pa.binary()).cast(pa.string())
            yield from _rows(["lang", "chunk", "docs", "occ"], pa.array(list(langs), pa.string()).take(pa.array(lang[first])), text.take(pa.array(code[first])),
                             lists, at, pa.array(list(sources), pa.string()).take(pa.array(by)), total)

        words, langs, sources, doc_lang, doc_source, doc_number, codes, counts, size = fresh()
        for b in batches:
            for lang, source, t in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), texts(b)):
                own = Counter((t or "").encode().lower().split())
                if not own:
                    continue
                codes.append(np.fromiter(map(words.__getitem__, own), np.int32, len(own)))
                counts.append(np.fromiter(own.values(), np.int32, len(own)))
                doc_lang.append(langs[lang])
                doc_source.append(sources[source])
                doc_number.append(next(numbers))
                size += len(own)
                if size >= BLOCK_CHUNKS:
                    yield from close()
                    words, langs, sources, doc_lang, doc_source, doc_number, codes, counts, size = fresh()
        if codes:
            yield from close()

    kept = docs.select(_name("lang"), _name("source"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "lang string, chunk string, docs array<bigint>, occ array<struct<source:string,n:bigint>>")


def _name(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)


def term_parts(chunks: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, docs, occ): each distinct chunk is cut into terms once, and its terms take its documents and occurrences.

    Equal chunks of all blocks come together, sorted, where the common ones are
    spread over tasks by Spark's rebalancing; a task then merges what it has of
    each term, so that a term of many chunks leaves it in few rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, Counter())  # the last chunk, which may go on in the next batch

        def close(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal known
            t = pa.Table.from_batches(held).combine_chunks()
            chunk, lang = (t.column(c).combine_chunks().dictionary_encode() for c in ("chunk", "lang"))
            terms: defaultdict = defaultdict(count().__next__)
            of, sizes, times = [], [], []
            for c in chunk.dictionary:
                c = c.as_py()
                if known[0] != c:
                    known = (c, Counter(FOUND(c)))
                of += [terms[x] for x in known[1]]
                times += known[1].values()
                sizes.append(len(known[1]))
            if not of:
                return
            of, times, sizes = np.array(of), np.array(times), np.array(sizes)
            start, code = np.cumsum(sizes) - sizes, chunk.indices.to_numpy()
            # a row for each term of each chunk's row
            row = np.repeat(np.arange(len(code)), sizes[code])
            entry = np.arange(len(row)) - np.repeat(np.cumsum(sizes[code]) - sizes[code], sizes[code]) + start[code[row]]
            own = lang.indices.to_numpy()[row]
            docs, occ = t.column("docs").combine_chunks(), t.column("occ").combine_chunks()
            to_doc, to_occ = _spread(docs.offsets.to_numpy(), row), _spread(occ.offsets.to_numpy(), row)
            source = occ.values.field("source").dictionary_encode()
            n = occ.values.field("n").to_numpy()[to_occ[1]] * times[entry][to_occ[0]]
            first, lists, at, by, total = merged(
                own * len(terms) + of[entry], (to_doc[0], docs.values.to_numpy()[to_doc[1]]), (to_occ[0], source.indices.to_numpy()[to_occ[1]], n), min_docs)
            yield from _rows(["lang", "term", "docs", "occ"], lang.dictionary.take(pa.array(own[first])), pa.array(list(terms), pa.string()).take(pa.array(of[entry][first])),
                             lists, at, source.dictionary.take(pa.array(by)), total)

        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= MERGED_ROWS:
                yield from close(held)
                held, size = [], 0
        if held:
            yield from close(held)

    dealt = chunks.hint("rebalance", "chunk").sortWithinPartitions("chunk")
    return dealt.mapInArrow(run, "lang string, term string, docs array<bigint>, occ array<struct<source:string,n:bigint>>")


def _spread(offsets: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``row``, position in the values) of each element of the lists that ``row`` names."""
    size = (offsets[1:] - offsets[:-1])[row]
    place = np.repeat(np.arange(len(row)), size)
    return place, np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size) + offsets[row][place]


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, total, sources): the terms in ``min_docs`` documents of a language or more, with their occurrences in all and by source."""
    parts = term_parts(chunk_counts(docs, min_docs), min_docs)
    whole = parts.groupBy("lang", "term").agg(F.collect_list("docs").alias("docs"), F.flatten(F.collect_list("occ")).alias("occ"))
    enough = whole.where(F.size(F.array_distinct(F.flatten("docs"))) >= min_docs).select("lang", "term", F.explode("occ").alias("o"))
    by_source = enough.groupBy("lang", "term", F.col("o.source").alias("source")).agg(F.sum("o.n").alias("n"))
    return by_source.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources"))


def _share(n: Column, total: Column, terms: Column, scale: int) -> Column:
    """1 + floor(scale * (n + 1) / (total + terms)), in decimals: the product may pass 64 bits."""
    return (F.lit(1) + F.call_function("div", F.lit(scale).cast("decimal(38,0)") * (n + 1), (total + terms).cast("decimal(20,0)"))).cast("long")


def _distance(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q); p and q are below 2**30, so the square is below 2**60."""
    return F.call_function("div", (p - q) * (p - q), q)


def shared_terms(terms: DataFrame) -> DataFrame:
    """(lang, a, b, high, low): over the terms that both sources have, what the distance of a to b is beyond the terms' own sums.

    For sources a and b with shares p, and p0 for a term without occurrence, a
    shared term adds f(pa, pb) - f(pa, p0b) - f(p0a, pb) + f(p0a, p0b). Each
    task sums over its terms, so a pair leaves it once a buffer and not once
    a term. The sum is high * 2**32 + low.
    """

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def summed(key: np.ndarray, high: np.ndarray, low: np.ndarray) -> tuple:
        order = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.diff(key[order], prepend=-1))
        return key[order][at], np.add.reduceat(high[order], at), np.add.reduceat(low[order], at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: defaultdict = defaultdict(count().__next__)  # (lang, source) -> number
        held: list[tuple] = []
        waiting = 0

        def out(rows: tuple) -> pa.RecordBatch:
            known = list(names)
            a, b = (rows[0] >> 32).tolist(), (rows[0] & 0xFFFFFFFF).tolist()
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([known[x][0] for x in a], pa.string()), "a": pa.array([known[x][1] for x in a], pa.string()),
                "b": pa.array([known[x][1] for x in b], pa.string()), "high": pa.array(rows[1]), "low": pa.array(rows[2])})

        for batch in batches:
            lists, inner = batch.column("sources"), batch.column("sources").values
            offsets = lists.offsets.to_numpy()
            size = np.diff(offsets)
            row = np.repeat(np.arange(len(size)), size)
            lang, source = batch.column("lang").dictionary_encode(), inner.field("source").dictionary_encode()
            known, at = np.unique(lang.indices.to_numpy()[row].astype(np.int64) * len(source.dictionary) + source.indices.to_numpy(), return_inverse=True)
            code = np.array([names[lang.dictionary[int(x) // len(source.dictionary)].as_py(), source.dictionary[int(x) % len(source.dictionary)].as_py()] for x in known], np.int64)[at]
            p, p0 = inner.field("p").to_numpy(), inner.field("p0").to_numpy()
            # each element stands left of all of its list; some of the left ones at a time
            width = size[row]
            cuts = [*np.flatnonzero(np.diff(np.cumsum(width) // PAIRS, prepend=-1)).tolist(), len(row)]
            for i, j in zip(cuts, cuts[1:]):
                x = np.repeat(np.arange(i, j), width[i:j])
                y = _spread(offsets, row[i:j])[1]
                x, y = x[x != y], y[x != y]
                v = f(p[x], p[y]) - f(p[x], p0[y]) - f(p0[x], p[y]) + f(p0[x], p0[y])
                held.append(summed(code[x] << 32 | code[y], v >> 32, v & 0xFFFFFFFF))
                waiting += len(held[-1][0])
                if waiting > PAIRS:
                    held = [summed(*map(np.concatenate, zip(*held)))]
                    if (waiting := len(held[0][0])) > PAIRS // 2:
                        yield out(held.pop())
                        waiting = 0
        if held:
            yield out(summed(*map(np.concatenate, zip(*held))))

    grouped = terms.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("sources"))
    return grouped.select("lang", "sources").mapInArrow(run, "lang string, a string, b string, high long, low long")


def source_divergence(docs: DataFrame, params: DivergenceParams | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank, n): how each (lang, source) group differs from the others and from its language.

    Shares are p = 1 + floor(scale * (n + 1) / (N + V)) over the V terms that
    are in ``min_docs`` documents of the language, n being the occurrences and
    N their sum. Part ``pair``: each other source of the language with the sum
    over all V terms of floor((p - q)**2 / q), q its share. Part ``term``: the
    ``top_terms`` terms of the greatest floor((p - q)**2 / q) among those that
    the group has with p > q, q the language's share; n has their occurrences.
    Ties go to the smaller item in UTF-8 order.

    A NULL text, lang or source is read as ''. A document is a row, so
    repeated rows count each. A group without terms still has shares; a
    language of one source has no pair; with no kept term pairs have the value
    0. An empty table gives no rows. Further columns are not read.
    """
    p = params or DivergenceParams()
    kept = materialise(kept_terms(docs, p.min_docs))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"), F.sum("total").alias("lang_n"))
    own = kept.select("lang", "term", "total", F.inline("sources"))
    found = docs.select(_name("lang"), _name("source")).distinct()
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count(F.lit(1)).alias("nz"))
    zero = F.lit(0).cast("long")
    groups = found.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("group_n", zero).alias("group_n"), F.coalesce("nz", zero).alias("nz"), F.coalesce("vocabulary", zero).alias("vocabulary"), "lang_n")
    groups = materialise(groups.withColumn("p0", F.when(F.col("vocabulary") > 0, _share(zero, F.col("group_n"), F.col("vocabulary"), p.scale))))

    shares = own.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("group_n"), F.col("vocabulary"), p.scale))
    q = _share(F.col("total"), F.col("lang_n"), F.col("vocabulary"), p.scale)
    terms = shares.withColumn("q", q).where("p > q").select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"), "n")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= p.top_terms)

    big = "decimal(38,0)"
    total = lambda value: F.sum(F.col("m").cast("decimal(20,0)") * value)
    other = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("p0b"), F.col("nz").alias("nzb"))
    # a group has far fewer distinct shares than terms; a source meets the others on each of these
    levels = shares.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count(F.lit(1)).alias("m"))
    alone = levels.join(other, "lang").where("a <> b").groupBy("lang", "a", "b").agg(
        total(_distance(F.col("p"), F.col("p0b"))).alias("over"), total(_distance(F.col("p0b"), F.col("p"))).alias("under"))
    both = shared_terms(shares.select("lang", "term", "source", "p", "p0")).groupBy("lang", "a", "b").agg(
        (F.sum(F.col("high").cast("decimal(20,0)")) * F.lit(1 << 32).cast("decimal(11,0)") + F.sum(F.col("low").cast("decimal(20,0)"))).cast(big).alias("both"))
    pairs = groups.select("lang", F.col("source").alias("a"), "vocabulary", "nz", "p0").join(other, "lang").where("a <> b")
    pairs = pairs.join(alone.select("lang", "a", "b", "over"), ["lang", "a", "b"], "left")
    pairs = pairs.join(alone.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), "under"), ["lang", "a", "b"], "left")
    pairs = pairs.join(both, ["lang", "a", "b"], "left")
    rest = (F.col("vocabulary") - F.col("nz") - F.col("nzb")).cast("decimal(20,0)") * _distance(F.col("p0"), F.col("p0b"))
    value = sum((F.coalesce(F.col(c).cast(big), F.lit(0).cast(big)) for c in ("over", "under", "both")), F.coalesce(rest.cast(big), F.lit(0).cast(big)))
    pairs = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.cast("long").alias("value"), F.lit(None).cast("long").alias("n"))
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    rows = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank", "n")
    return rows(pairs, "pair").unionAll(rows(terms, "term"))
