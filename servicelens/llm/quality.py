"""Quality classifier: ridge regression on random Fourier features, isotonically calibrated.

Document statistics are mapped to random Fourier features, whose inner product
approximates a Gaussian kernel. Each partition sums its share of the normal
equations; the sums give the ridge weights. Leave-one-out scores of the
labelled rows, counted in narrow bins, give the isotonic calibration.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.llm.common import block_rows, fold, joined_blocks, materialise, summed_blocks, texts

#: Byte classes counted in the UTF-8 text, by their bytes.
CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": (9, 10, 11, 12, 13, 32),
    "wide": range(128, 256), "stop": b".,;:?", "shout": b"!", "symbol": b"#$%&*@^~+=", "bar": b"|", "bracket": b"()[]{}<>/\\_",
}
STATS = (
    *CLASSES, "log_bytes", "log_words", "word_mean", "word_sd", "short_words", "long_words", "unique_words", "top_word",
    "repeated_lines", "words_a_line", "upper_words", "marked_words", "sentence_ends", "entropy",
)
BLOCKS = 64


@dataclass(frozen=True)
class RidgeParams:
    features: int = 256
    width: float = 4.0
    ridge: float = 1.0
    bins: int = 2048
    threshold: float = 0.3
    seed: int = 20240


def document_stats(text: str | None) -> np.ndarray:
    """The statistics of one whole text; NULL counts as empty."""
    out = np.zeros(len(STATS))
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return out
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(float)
    for i, own in enumerate(CLASSES.values()):
        out[i] = count[list(own)].sum() / len(data)
    share = count[count > 0] / len(data)
    words = data.split()
    n = max(1, len(words))
    size = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    seen = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    marked = sum(c for w, c in seen.items() if not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,"))
    upper = sum(c for w, c in seen.items() if len(w) > 1 and w.isupper())
    ends = sum(c for w, c in seen.items() if w[-1:] in b".!?")
    out[len(CLASSES):] = (
        np.log1p(len(data)), np.log1p(len(words)), size.mean(), size.std(), (size <= 3).sum() / n, (size >= 12).sum() / n,
        len(seen) / n, max(seen.values(), default=0) / n, 1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words) / max(1, len(lines))), upper / n, marked / n, ends / n, -(share * np.log(share)).sum(),
    )
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x) for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([document_stats(t) for t in texts(b)]).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), _lists(x)], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, x array<double>")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    col = b.column("x")
    return np.asarray(col.flatten()).reshape(len(col), len(STATS))


@dataclass
class QualityModel:
    """Everything that scoring needs; a few hundred kB whatever the corpus."""

    params: RidgeParams
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    inverse: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        wave = np.sqrt(2 / self.params.features) * np.cos(z @ self.turn + self.phase)
        return np.hstack([wave, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0.0, 1.0)


def pool_adjacent(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``value`` in weighted squares."""
    level: list[list[float]] = []
    for v, w in zip(value, weight):
        level.append([v, w, 1])
        while len(level) > 1 and level[-2][0] >= level[-1][0]:
            v2, w2, n2 = level.pop()
            v1, w1, n1 = level.pop()
            level.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([[v] * int(n) for v, _, n in level]) if level else np.zeros(0)


def fit_quality(stats: DataFrame, labels: DataFrame, label: str = "quality", params: RidgeParams | None = None) -> QualityModel:
    """Fit on all rows of ``stats`` that have a label. ``labels`` may repeat a doc_id: its mean counts.

    No labelled row at all gives a model that scores everything 0.5.
    """
    p = params or RidgeParams()
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).where("y is not null")
    own = own.groupBy("doc_id").agg(F.avg("y").alias("y"))
    train = materialise(stats.join(own, "doc_id").select("x", "y"))
    moments = train.select(
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(STATS))],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(len(STATS))], F.avg("y").alias("y"),
    ).first()
    rng = np.random.default_rng(p.seed)
    known = moments["y"] is not None
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(len(STATS))])
    scale = np.array([max(moments[f"s{i}"] or 0.0, 1e-6) for i in range(len(STATS))])
    model = QualityModel(
        p, mean, scale, rng.normal(0, 1 / p.width, (len(STATS), p.features)), rng.uniform(0, 2 * np.pi, p.features),
        np.zeros(p.features + 1), np.eye(p.features + 1), np.array([0.0]), np.array([moments["y"] if known else 0.5]),
    )
    if not known:
        return model
    wide = p.features + 1

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((wide, wide + 1)), 0
        for b in batches:
            z = model.features(_matrix(b))
            total += z.T @ np.column_stack([z, b.column("y").to_numpy()])
            rows += b.num_rows
        if rows:
            yield block_rows(total, BLOCKS)

    sums = joined_blocks(summed_blocks(train.mapInArrow(normal, "block int, v binary")), (wide, wide + 1))
    penalty = np.diag([p.ridge] * p.features + [1e-9])
    model.inverse = np.linalg.inv(sums[:, :wide] + penalty)
    model.weights = model.inverse @ sums[:, wide]

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z, y = model.features(_matrix(b)), b.column("y").to_numpy()
            lever = np.clip(((z @ model.inverse) * z).sum(axis=1), 0, 0.999)
            got = (z @ model.weights - lever * y) / (1 - lever)
            bins = np.clip((got + 0.5) / 2 * p.bins, 0, p.bins - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(y)], names=["bin", "y"])

    counts = train.mapInArrow(left_out, "bin int, y double").groupBy("bin").agg(F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).toPandas().sort_values("bin")
    model.knots = (counts["bin"].to_numpy() + 0.5) / p.bins * 2 - 0.5
    model.levels = pool_adjacent(counts["y"].to_numpy(), counts["n"].to_numpy())
    return model


def score_quality(docs: DataFrame, labels: DataFrame, held_mod: int = 5, held_rest: int = 0, params: RidgeParams | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Only labels of rows whose crc32(doc_id) modulo ``held_mod`` is not
    ``held_rest`` are learnt from. Repeated rows each get their row; a NULL
    doc_id is never held out; NULL and empty texts are scored by the
    statistics of an empty text; no labels give 0.5; an empty table gives no
    rows. Other columns are not read.
    """
    p = params or RidgeParams()
    stats = materialise(statistics(docs))
    model = fit_quality(stats, labels.where(fold("doc_id", held_mod) != held_rest), params=p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(_matrix(b)))], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(fold("doc_id", held_mod) == held_rest, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= p.threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, held_mod: int = 5, held_rest: int = 0, params: RidgeParams | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns as they are.

    The model is fitted as in ``score_quality``: statistics of all rows meet
    the labels, so no text is shuffled. Each row is then scored from its own
    text, so repeated rows and NULL ids need no join.
    """
    p = params or RidgeParams()
    model = fit_quality(statistics(docs), labels.where(fold("doc_id", held_mod) != held_rest), params=p)

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd

        return pd.Series(model.score(np.array([document_stats(t) for t in text]).reshape(-1, len(STATS))))

    return docs.where(score(F.col("text").cast("string")) >= p.threshold)
