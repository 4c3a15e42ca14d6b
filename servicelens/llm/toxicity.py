"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Each token is read as a word and as characters (its hashed beginnings and end).
The network scores every overlapping window of a text, and the text's score is
that of its worst window. It is trained on a bounded sample of labelled rows;
a toxic text teaches by its worst window alone, a clean one by its two worst.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.llm.common import fold, texts

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
PIECE = 1 << 18
#: Byte values that belong to a token: lower-case letters, digits and all bytes of other scripts.
LETTER = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


@dataclass(frozen=True)
class GruParams:
    window: int = 32
    stride: int = 16
    buckets: int = 1 << 15
    embed: int = 12
    hidden: int = 8
    attend: int = 8
    #: Bound of the training sample: labelled rows of each class, and their windows on average
    #: (a class has rows x sample_windows windows at most, of short and long rows alike).
    toxic_rows: int = 1500
    clean_rows: int = 4000
    sample_windows: int = 48
    epochs: int = 14
    batch: int = 64
    rate: float = 0.01
    threshold: float = 0.3
    seed: int = 11


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


#: Bytes of the token that each input hashes: the word, its beginnings (apart for words that go on and
#: words that are over), its end.
PREFIXES, SUFFIX = (4, 5, 6, 7), 4
INPUTS = 2 + len(PREFIXES)


def _bucket(h: np.ndarray, salt: int, buckets: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(salt * 0x94D049BB133111EB & (1 << 64) - 1)
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(40)).astype(np.int64) % buckets


def token_inputs(text: str | None, buckets: int) -> np.ndarray:
    """(tokens, INPUTS) hash buckets of the whole text. The hash of any byte range is a difference of running sums."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    out, at = [], 0
    while at < len(data):
        stop = min(len(data), at + PIECE)
        if stop < len(data):  # not within a token, unless it is longer than half a piece
            ends = np.flatnonzero(~LETTER[data[at + PIECE // 2 : stop]])
            stop = at + PIECE // 2 + int(ends[-1]) + 1 if len(ends) else stop
        piece = data[at:stop]
        at = stop
        edge = np.diff(LETTER[piece].astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(start):
            continue
        up, down = _power(max(PIECE, len(piece)) + 1)
        run = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)], out=run[1:])
        part = lambda a, b: (run[b] - run[a]) * down[a]
        ids = [_bucket(part(start, end), 1, buckets)]
        ids += [_bucket(part(start, np.minimum(start + m, end)) * np.uint64(2) + (end - start > m), m, buckets) for m in PREFIXES]
        ids.append(_bucket(part(np.maximum(end - SUFFIX, start), end), 99, buckets))
        out.append(np.stack(ids, axis=1).astype(np.int32))
    return np.concatenate(out) if out else np.empty((0, INPUTS), np.int32)


def window_starts(n: int, p: GruParams) -> np.ndarray:
    """Starts of all overlapping windows; the last one ends with the text."""
    if n <= p.window:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - p.window, p.stride), n - p.window)


def windows(ids: np.ndarray, p: GruParams) -> tuple[np.ndarray, np.ndarray]:
    """(windows, window, INPUTS) buckets and (windows, window) mask; a shorter text is filled up."""
    n = len(ids)
    starts = window_starts(n, p)
    at = starts[:, None] + np.arange(p.window)
    mask = at < n
    return (ids[np.minimum(at, n - 1)] if n else np.zeros((1, p.window, INPUTS), np.int32)), mask


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class GruScorer:
    """The network. Directions share no weights; each gate block is [update, reset, candidate]."""

    def __init__(self, p: GruParams):
        self.p = p
        rng = np.random.default_rng(p.seed)
        h, e = p.hidden, p.embed
        draw = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
        self.w = {"word": draw(p.buckets, e, scale=0.1), "char": draw(p.buckets, e, scale=0.1),
                  "va": draw(p.attend, scale=0.5), "wa": draw(2 * h, p.attend, scale=0.4), "ba": np.zeros(p.attend, np.float32),
                  "wo": draw(2 * h, scale=0.4), "bo": np.full(1, -1.0, np.float32)}
        for d in "fb":
            self.w |= {f"x{d}": draw(2 * e, 3 * h, scale=(2 * e) ** -0.5), f"u{d}": draw(h, 3 * h, scale=h**-0.5), f"c{d}": np.zeros(3 * h, np.float32)}

    def embed(self, ids: np.ndarray) -> np.ndarray:
        chars = self.w["char"][ids[..., 1]]
        for i in range(2, INPUTS):
            chars = chars + self.w["char"][ids[..., i]]
        return np.concatenate([self.w["word"][ids[..., 0]], chars / np.float32(INPUTS - 1)], axis=-1)

    def _direction(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States of one direction, time first; keep: also what the backward pass needs."""
        n, t, _ = x.shape
        h = self.p.hidden
        gates = (x.reshape(n * t, -1) @ self.w[f"x{d}"] + self.w[f"c{d}"]).reshape(n, t, 3 * h)
        u, uc = self.w[f"u{d}"][:, : 2 * h], self.w[f"u{d}"][:, 2 * h :]
        state, states, tape = np.zeros((n, h), np.float32), np.empty((t, n, h), np.float32), []
        whole = bool(mask.all())
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            zr = _sigmoid(gates[:, i, : 2 * h] + state @ u)
            z, r = zr[:, :h], zr[:, h:]
            cand = np.tanh(gates[:, i, 2 * h :] + (r * state) @ uc)
            new = state + z * (cand - state)
            if not whole:
                new = np.where(mask[:, i, None], new, state)
            if keep:
                tape.append((i, state, z, r, cand))
            state = states[i] = new
        return states, tape

    def forward(self, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logit of each window."""
        x = self.embed(ids)
        ahead, back = self._direction(x, mask, "f", keep), self._direction(x, mask, "b", keep)
        s = np.concatenate([ahead[0], back[0]], axis=2)
        a = np.tanh(s @ self.w["wa"] + self.w["ba"])
        e = a @ self.w["va"] + np.where(mask.T, 0, -1e9).astype(np.float32)
        e = np.exp(e - e.max(axis=0))
        weight = e / e.sum(axis=0)
        pooled = (weight[..., None] * s).sum(axis=0)
        logit = pooled @ self.w["wo"] + self.w["bo"][0]
        return logit, (x, s, a, weight, pooled, ahead[1], back[1]) if keep else None

    def logits(self, ids: np.ndarray, mask: np.ndarray, step: int = 2048) -> np.ndarray:
        return np.concatenate([self.forward(ids[i : i + step], mask[i : i + step])[0] for i in range(0, len(ids), step)])

    def gradients(self, ids: np.ndarray, mask: np.ndarray, target: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted cross entropy of the windows."""
        h, w = self.p.hidden, self.w
        logit, (x, s, a, weight, pooled, *tapes) = self.forward(ids, mask, keep=True)
        dl = (share * (_sigmoid(logit) - target)).astype(np.float32)
        g = {"bo": np.array([dl.sum()]), "wo": pooled.T @ dl}
        dp = dl[:, None] * w["wo"]
        dw = (s * dp).sum(axis=2)
        de = weight * (dw - (weight * dw).sum(axis=0))
        ds = weight[..., None] * dp
        g["va"] = np.einsum("tn,tna->a", de, a)
        da = de[..., None] * w["va"] * (1 - a * a)
        g["ba"], g["wa"] = da.sum(axis=(0, 1)), np.einsum("tnh,tna->ha", s, da)
        ds += da @ w["wa"].T
        dx = np.zeros_like(x)
        for d, tape, part in (("f", tapes[0], ds[..., :h]), ("b", tapes[1], ds[..., h:])):
            u = w[f"u{d}"]
            carry = np.zeros((len(ids), h), np.float32)
            gu, dg = np.zeros_like(u), np.zeros((*x.shape[:2], 3 * h), np.float32)
            for i, state, z, r, cand in reversed(tape):
                total = part[i] + carry
                live = mask[:, i, None]
                dn = np.where(live, total, 0)
                dc = dn * z * (1 - cand * cand)
                dz = dn * (cand - state) * z * (1 - z)
                drs = dc @ u[:, 2 * h :].T
                dr = drs * state * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                carry = np.where(live, dn * (1 - z), total) + drs * r + dzr @ u[:, : 2 * h].T
                gu[:, : 2 * h] += state.T @ dzr
                gu[:, 2 * h :] += (r * state).T @ dc
                dg[:, i] = np.concatenate([dzr, dc], axis=1)
            flat = dg.reshape(-1, 3 * h)
            g[f"u{d}"], g[f"c{d}"], g[f"x{d}"] = gu, flat.sum(axis=0), x.reshape(len(flat), -1).T @ flat
            dx += (flat @ w[f"x{d}"].T).reshape(x.shape)
        e = self.p.embed
        g["word"] = (ids[..., 0].ravel(), dx[..., :e].reshape(-1, e))
        g["char"] = (ids[..., 1:].reshape(-1), np.repeat(dx[..., e:].reshape(-1, e) / np.float32(INPUTS - 1), INPUTS - 1, axis=0))
        return g


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], p: GruParams) -> GruScorer:
    """Adam (adaptive steps for the rows of the embeddings that occur) over (window ids, mask, label)."""
    net, rng = GruScorer(p), np.random.default_rng(p.seed + 1)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    steps = 0
    for epoch in range(p.epochs):
        rate = p.rate * (1 - 0.9 * epoch / p.epochs)
        order = rng.permutation(len(rows))
        for i in range(0, len(order), p.batch):
            own = [rows[j] for j in order[i : i + p.batch]]
            ids, mask = np.concatenate([r[0] for r in own]), np.concatenate([r[1] for r in own])
            logit = np.concatenate([net.logits(ids[j : j + 4096], mask[j : j + 4096]) for j in range(0, len(ids), 4096)])
            take, target, share, at = [], [], [], 0
            for r in own:
                worst = np.argsort(-logit[at : at + len(r[0])])[: 1 if r[2] > 0.5 else 2]
                take += (at + worst).tolist()
                target += [r[2]] * len(worst)
                share += [1 / len(worst)] * len(worst)
                at += len(r[0])
            grads = net.gradients(ids[take], mask[take], np.array(target), np.array(share) / len(own))
            steps += 1
            for k, g in grads.items():
                if isinstance(g, tuple):
                    live, back = np.unique(g[0], return_inverse=True)
                    total = np.zeros((len(live), p.embed), np.float32)
                    np.add.at(total, back, g[1])
                    second[k][live] = 0.98 * second[k][live] + 0.02 * total * total
                    net.w[k][live] -= rate * total / (np.sqrt(second[k][live]) + 1e-6) * 0.5
                else:
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    net.w[k] -= (rate * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-7)).astype(np.float32)
    return net


def training_rows(docs: DataFrame, labels: DataFrame, label: str, p: GruParams) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """The bounded sample: of each class the rows first in the order of a hash, with all their windows.

    It ends with the class's number of rows, or before the row that would bring
    it over its total of windows (or of characters, eight for a token, which
    bounds what is read). No row is passed over for its length, unless it alone
    has more characters than the whole class may have. The rows are picked by
    id, so that texts are read for them only.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).where("doc_id is not null and y is not null")
    own = own.groupBy("doc_id").agg(F.max("y").alias("y"))
    most = 8 * (p.window + p.stride * (p.sample_windows - 1))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    ids = source.select("doc_id", F.length("text").alias("chars")).join(own, "doc_id").groupBy("doc_id", "y").agg(F.max("chars").alias("chars"))
    order = F.xxhash64("doc_id", F.lit(p.seed))
    classes = []
    for y, n in ((1, p.toxic_rows), (0, p.clean_rows)):
        rows, chars = [], 0
        for r in ids.where(((F.col("y") > 0.5) == F.lit(bool(y))) & (F.col("chars") <= most * n)).orderBy(order, "doc_id").limit(n).collect():
            chars += r.chars
            if chars > most * n:
                break
            rows.append(r)
        classes.append((n, rows))
    picked = [r.doc_id for _, rows in classes for r in rows]
    if not picked:
        return []
    text = {r.doc_id: r.text for r in source.where(F.col("doc_id").isin(picked)).dropDuplicates(["doc_id"]).collect()}
    out = {}
    for n, rows in classes:
        total = 0
        for r in rows:
            ids_, mask = windows(token_inputs(text.pop(r.doc_id), p.buckets), p)
            total += len(ids_)
            if total > n * p.sample_windows and total > len(ids_):
                break
            out[r.doc_id] = (ids_, mask, r.y)
    return [out[i] for i in sorted(out)]


def score_texts(net: GruScorer, group: list[str | None]) -> np.ndarray:
    """The worst window's score of each text. Windows are scored in blocks, across texts."""
    p = net.p
    out = np.full(len(group), -np.inf)
    held, size = [], 0

    def flush() -> None:
        nonlocal held, size
        for full in (True, False):  # windows that need no mask go together
            part = [x for x in held if bool(x[2].all()) == full]
            if part:
                got = net.logits(np.concatenate([x[1] for x in part]), np.concatenate([x[2] for x in part]))
                np.maximum.at(out, np.repeat([x[0] for x in part], [len(x[1]) for x in part]), got)
        held, size = [], 0

    for i, t in enumerate(group):
        ids = token_inputs(t, p.buckets)
        step = p.stride * 2048  # a very long text in overlapping parts
        for at in range(0, max(1, len(ids) - p.window + p.stride), step):
            ids_, mask = windows(ids[at : at + step + p.window], p)
            held.append((i, ids_, mask))
            size += len(ids_)
            if size >= 4096:
                flush()
    flush()
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def score_toxicity(docs: DataFrame, labels: DataFrame, held_mod: int = 4, held_rest: int = 2, params: GruParams | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Only labels of rows whose crc32(doc_id) modulo ``held_mod`` is not
    ``held_rest`` are learnt from. Repeated rows each get their row; a NULL
    doc_id is never held out; NULL and empty texts are one empty window; no
    labels leave the network untrained; an empty table gives no rows. Other
    columns are not read.
    """
    p = params or GruParams()
    rows = training_rows(docs, labels.where(fold("doc_id", held_mod) != held_rest), "toxic", p)
    net = train(rows, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                score = score_texts(net, list(texts(part)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(fold("doc_id", held_mod) == held_rest, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= p.threshold, 1).otherwise(0).alias("predicted"),
    )
