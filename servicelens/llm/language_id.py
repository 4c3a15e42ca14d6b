"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all learning rows. The weights are
trained by follow-the-regularised-leader with an elastic net on a bounded
sample of each language, and a temperature is fitted on rows kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens.llm.common import block_rows, fold, joined_blocks, summed_blocks, texts

UNKNOWN = "und"
BLOCKS = 64
#: Characters hashed at a time; bounds the memory of one very long text.
STEP = 1 << 18
SPACE = 32

_letters: list[np.ndarray] = []


@dataclass(frozen=True)
class LangParams:
    sizes: tuple[int, ...] = (1, 2, 3, 4)
    buckets: int = 1 << 15
    #: Bound of the training sample: expected rows of each language.
    rows_a_language: int = 1000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.2
    l2: float = 0.5
    calibration_part: int = 5
    seed: int = 3


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def ngram_counts(text: str | None, p: LangParams) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of the whole lower-cased text; none if it has no letter.

    All but letters count as one space; n-grams of spaces alone don't count.
    """
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letter_table()[code]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # a letter, or the first other character after one
    keep = np.where(letter, code, SPACE)[keep]
    code = np.concatenate(([SPACE], keep, [SPACE] * bool(keep[-1] != SPACE))).astype(np.uint64)
    total = np.zeros(p.buckets, np.int64)
    for at in range(0, len(code), STEP):
        part = code[at : at + STEP + max(p.sizes) - 1]
        own = min(STEP, len(code) - at)
        h = np.zeros(len(part), np.uint64)
        for n in range(1, max(p.sizes) + 1):
            if len(part) < n:
                break
            h = h[: len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1 :] + np.uint64(n)
            if n in p.sizes:
                mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
                slot = (mixed >> np.uint64(40)).astype(np.int64)[:own] % p.buckets
                if n == 1:
                    slot = slot[part[: len(slot)] != SPACE]
                total += np.bincount(slot, minlength=p.buckets)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class LangModel:
    params: LangParams
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def vector(self, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and TF-IDF values of length one; the last bucket is the intercept."""
        v = np.log1p(count) * self.idf[at]
        v = np.append(v / max(np.sqrt((v * v).sum()), 1e-12), 1.0)
        return np.append(at, self.params.buckets).astype(np.int32), v.astype(np.float32)

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at]

    def predict(self, text: str | None) -> tuple[str, float]:
        at, count = ngram_counts(text, self.params)
        if not len(at) or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*self.vector(at, count)) / self.temperature)
        return self.langs[int(p.argmax())], float(p.max())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train_ftrl(model: LangModel, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """Follow the regularised leader, one row at a time, over the coordinates that the row has."""
    p, rng = model.params, np.random.default_rng(model.params.seed)
    z = np.zeros_like(model.weights)
    n = np.zeros_like(model.weights)
    for _ in range(p.epochs):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            za, na = z[at], n[at]
            root = np.sqrt(na)
            w = -(za - np.sign(za) * p.l1) / ((p.beta + root) / p.alpha + p.l2)
            w[np.abs(za) <= p.l1] = 0.0
            error = softmax(x @ w)
            error[y] -= 1.0
            g = x[:, None] * error
            more = na + g * g
            z[at] = za + g - (np.sqrt(more) - root) / p.alpha * w
            n[at] = more
    model.weights = np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def fit_temperature(model: LangModel, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> float:
    """The temperature of least log loss on rows that were not trained on, by golden-section search of its logarithm."""
    if not rows:
        return 1.0
    logits = np.array([model.logits(at, x) for at, x, _ in rows])
    y = np.array([r[2] for r in rows])

    def loss(log_t: float) -> float:
        s = logits / np.exp(log_t)
        top = s.max(axis=1)
        return float((top + np.log(np.exp(s - top[:, None]).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    while high - low > 1e-4:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_language_model(docs: DataFrame, params: LangParams | None = None) -> LangModel:
    """Fit on all rows of ``docs`` with a non-null lang and a letter in their text.

    Document frequencies count all of them. The sample takes each row of a
    language with the same chance, given by a hash of its id, so that
    ``rows_a_language`` rows are expected; n-grams are counted in tasks, the
    driver sees the sample's counts alone. No such row gives a model without
    languages, which answers ``und``.
    """
    p = params or LangParams()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang is not null")
    sizes = {r.lang: r.n for r in source.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    model = LangModel(p, langs, np.ones(p.buckets), np.zeros((p.buckets + 1, len(langs))))
    if not langs:
        return model

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(p.buckets + 1)
        for b in batches:
            for t in texts(b):
                at = ngram_counts(t, p)[0]
                seen[at] += 1
                seen[-1] += len(at) > 0
        if seen[-1]:
            yield block_rows(seen, BLOCKS)

    df = joined_blocks(summed_blocks(source.select("text").mapInArrow(frequencies, "block int, v binary")), (p.buckets + 1,))
    model.idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [ngram_counts(t, p) for t in texts(b)]
            packed = [pa.array([x[i].astype("<i4").tobytes() for x in got], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), *packed], names=["doc_id", "lang", "at", "n"])

    chance = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    limit: Column = F.create_map(*[x for name in langs for x in (F.lit(name), F.lit(p.rows_a_language / sizes[name]))])[F.col("lang")]
    picked = source.where(chance < limit).mapInArrow(counts, "doc_id long, lang string, at binary, n binary").collect()
    place = {name: i for i, name in enumerate(langs)}
    rows = [(r.doc_id, (*model.vector(np.frombuffer(r.at, "<i4"), np.frombuffer(r.n, "<i4")), place[r.lang])) for r in picked if r.at]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1][2]))
    apart = [i % p.calibration_part == 0 for i in range(len(rows))] if len(rows) >= 10 * p.calibration_part else [False] * len(rows)
    train_ftrl(model, [r for (_, r), out in zip(rows, apart) if not out])
    model.temperature = fit_temperature(model, [r for (_, r), out in zip(rows, apart) if out])
    return model


def identify_language(docs: DataFrame, held_mod: int = 4, held_rest: int = 2, params: LangParams | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs``.

    Learns from the text and lang of rows whose crc32(doc_id) modulo
    ``held_mod`` is not ``held_rest``. Repeated rows each get their row; a
    NULL doc_id is neither held out nor learnt from; a NULL text, or one
    without a letter, is ``und`` with the score 0; an empty table gives no
    rows. Other columns are not read.
    """
    model = fit_language_model(docs.where(fold("doc_id", held_mod) != held_rest), params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(t) for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, lang_pred string, score double").select(
        "doc_id", F.coalesce(fold("doc_id", held_mod) == held_rest, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
