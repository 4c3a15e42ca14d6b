"""Fitted models: held-out accuracy, exact parts, awkward rows."""

import numpy as np
import pytest
from llm_cases import DOC_SCHEMA, LABEL_SCHEMA, empty_docs, label_rows, odd_docs, prose

from servicelens.llm.language_id import LangModel, LangParams, fit_temperature, identify_language, ngram_counts, softmax, train_ftrl
from servicelens.llm.quality import STATS, QualityModel, RidgeParams, document_stats, fit_quality, keep_good, pool_adjacent, score_quality, statistics
from servicelens.llm.queries import QUERIES
from servicelens.llm.toxicity import GruParams, GruScorer, score_texts, score_toxicity, token_inputs, train, training_rows, window_starts, windows

SF = "/root/testdata/sf0.1"


def key(r):
    return tuple((x is None, x) for x in r)


def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.mark.parametrize(("name", "label", "least"), [("op2_quality_classifier", "quality", 0.97), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_rows_are_told_apart(spark, name, label, least):
    got = QUERIES[name](spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    df = got.toPandas()
    assert len(df) == 10000 and df.doc_id.is_unique and df.score.between(0, 1).all()
    assert ((df.score >= 0.3) == (df.predicted == 1)).all()
    import zlib

    mod, rest = (5, 0) if label == "quality" else (4, 2)
    assert (df.held_out == [zlib.crc32(str(i).encode()) % mod == rest for i in df.doc_id]).all()
    held = df[df.held_out].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert auc(held.score.to_numpy(), held[label].to_numpy()) > least
    assert (held.predicted == held[label]).mean() > 0.95


def test_language_of_held_out_rows(spark):
    df = QUERIES["op6_language_id"](spark, SF).toPandas()
    assert list(df.columns) == ["doc_id", "held_out", "lang_pred", "score"] and len(df) == 10000 and df.score.between(0, 1).all()
    held = df[df.held_out].merge(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    assert (held.lang_pred == held.lang).mean() > 0.99


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) quality", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - toxic, toxic) toxic")
    scores = lambda f, x: [r.score for r in f(docs, x).orderBy("doc_id").collect()]
    assert scores(score_quality, labels) == pytest.approx(scores(score_quality, turned))
    assert scores(score_toxicity, labels) == pytest.approx(scores(score_toxicity, turned))
    other = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 4 = 2, 'xx', lang) lang")
    lang = lambda x: [(r.lang_pred, round(r.score, 9)) for r in identify_language(x).orderBy("doc_id").collect()]
    assert lang(docs) == lang(other)


def test_models_on_odd_rows(spark):
    df, labels = odd_docs(spark), spark.createDataFrame(label_rows(), LABEL_SCHEMA).selectExpr("*", "'x' as text", "'y' as y")
    ids = sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))
    for got in (score_quality(df, labels), score_toxicity(df, labels), identify_language(df)):
        rows = got.collect()
        assert sorted((r.doc_id for r in rows), key=lambda x: (x is None, x)) == ids
        assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    lang = {r.doc_id: r.lang_pred for r in identify_language(df).collect() if r.doc_id is not None}
    assert lang[4] == lang[5] == lang[6] == lang[10] == "und" and lang[9] != "und"
    kept = keep_good(df, labels)
    assert kept.columns == df.columns
    none = labels.where("false")
    assert {r.score for r in score_quality(df, none).collect()} == {0.5}
    assert keep_good(df, none).count() == df.count()
    assert len(score_toxicity(df, none).collect()) == df.count()
    assert {r.lang_pred for r in identify_language(df.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}
    for f in (score_quality, score_toxicity):
        assert f(empty_docs(spark), labels).collect() == []
    assert identify_language(empty_docs(spark)).collect() == [] and keep_good(empty_docs(spark), labels).collect() == []


def test_normal_equations_and_leave_one_out(spark):
    """The summed blocks give the ridge weights of the whole matrix; so does the calibration of left-out scores."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    p = RidgeParams(features=32, bins=1 << 20)
    stats = statistics(docs)
    m = fit_quality(stats.repartition(5), labels, params=p)
    rows = stats.join(labels, "doc_id").select("x", "quality").collect()
    x, y = np.array([r.x for r in rows]), np.array([float(r.quality) for r in rows])
    assert m.mean == pytest.approx(x.mean(axis=0)) and m.scale == pytest.approx(np.maximum(x.std(axis=0), 1e-6))
    z = m.features(x)
    a = z.T @ z + np.diag([1.0] * 32 + [1e-9])
    assert m.weights == pytest.approx(np.linalg.solve(a, z.T @ y), abs=1e-6)
    out = [z[i] @ np.linalg.solve(a - np.outer(z[i], z[i]), z.T @ y - z[i] * y[i]) for i in range(0, len(y), 40)]
    lever = ((z @ m.inverse) * z).sum(axis=1)
    quick = (z @ m.weights - lever * y) / (1 - lever)
    assert quick[::40] == pytest.approx(out, abs=1e-6)
    assert (np.diff(m.levels) >= 0).all() and (np.diff(m.knots) > 0).all()


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    p = RidgeParams(features=20000)
    d = len(STATS)
    m = QualityModel(p, np.zeros(d), np.ones(d), rng.normal(0, 1 / p.width, (d, p.features)), rng.uniform(0, 2 * np.pi, p.features), *[np.zeros(1)] * 4)
    x = rng.normal(size=(6, d))
    z = m.features(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * p.width**2))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_pool_adjacent():
    assert pool_adjacent(np.array([1.0, 0.0, 2.0, 2.0, 1.0]), np.array([1.0, 3.0, 1.0, 1.0, 2.0])).tolist() == pytest.approx([0.25, 0.25, 1.5, 1.5, 1.5])
    assert document_stats(None).tolist() == document_stats("").tolist() == [0.0] * len(STATS)


def test_ngrams_and_regression():
    p = LangParams(sizes=(1, 2), buckets=1 << 16)
    at, n = ngram_counts("Ab1ab", p)
    assert n.sum() == 4 + 6  # a b a b; _a ab b_ _a ab b_
    assert ngram_counts("123", p)[0].size == ngram_counts(None, p)[0].size == 0
    long = "abc " * 200_000
    assert ngram_counts(long, p)[1].sum() == 600_000 + 800_000
    rng = np.random.default_rng(1)
    m = LangModel(LangParams(buckets=40, l1=1.0), ["p", "q"], np.ones(40), np.zeros((41, 2)))
    rows = []
    for i in range(400):
        y = i % 2
        at = np.unique(np.append(rng.integers(4, 40, 6), y))
        rows.append((*m.vector(at, np.ones(len(at), int)), y))
    train_ftrl(m, rows)
    assert (m.weights[4:40] == 0).mean() > 0.5 and m.weights[0, 0] > 0 > m.weights[0, 1]
    assert np.mean([m.logits(a, x).argmax() == y for a, x, y in rows]) == 1.0
    t = fit_temperature(m, [(a, x, y if i % 5 else 1 - y) for i, (a, x, y) in enumerate(rows)])
    sure = np.mean([softmax(m.logits(a, x) / t).max() for a, x, _ in rows])
    assert sure == pytest.approx(0.8, abs=0.03)


def test_gradients_equal_differences():
    net = GruScorer(GruParams(buckets=50, window=6, stride=3))
    net.w = {k: v.astype(float) * 1.5 for k, v in net.w.items()}
    ids, mask = windows(token_inputs("a bb ccc dd e fff gg hh iii jj", 50), net.p)
    mask = mask.copy()
    mask[0, 4:] = False
    target = np.array([1.0] + [0.0] * (len(ids) - 1))
    g = net.gradients(ids, mask, target, np.ones(len(ids)))

    def loss():
        z = net.forward(ids, mask)[0].astype(float)
        return (np.log1p(np.exp(z)) - target * z).sum()

    for k, grad in g.items():
        dense = np.zeros_like(net.w[k])
        if isinstance(grad, tuple):
            np.add.at(dense, grad[0], grad[1])
        else:
            dense += grad
        at = np.unravel_index(np.abs(dense).argmax(), dense.shape)
        old = net.w[k][at]
        net.w[k][at] = old + 1e-3
        up = loss()
        net.w[k][at] = old - 1e-3
        down = loss()
        net.w[k][at] = old
        assert dense[at] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=1e-5), k


def test_windows_cover_all_tokens_and_long_texts_score_alike():
    p = GruParams()
    for n in (1, 31, 32, 33, 48, 100, 1000):
        starts = window_starts(n, p)
        assert set(np.minimum(starts[:, None] + np.arange(p.window), n - 1).ravel().tolist()) == set(range(n))
        assert (np.diff(starts) <= p.stride).all()
    rng = np.random.default_rng(3)
    say = lambda bad, n: " ".join(["vile" if bad and i == n // 2 else f"w{rng.integers(300)}" for i in range(n)])
    rows = [(*windows(token_inputs(say(i % 2, 20 + i % 90), p.buckets), p), float(i % 2)) for i in range(400)]
    net = train(rows, GruParams(epochs=6))
    long = say(False, 70_000) + " vile " + say(False, 3000)
    got = score_texts(net, ["", None, say(True, 400), say(False, 400), long, say(False, 40_000)])
    assert got[2] > 0.5 > got[3] and got[4] > 0.5 > got[5]
    one = [score_texts(net, [t])[0] for t in (long, "")]
    assert one == pytest.approx([got[4], got[0]], abs=1e-5)


def test_token_hash_does_not_depend_on_the_place():
    a = token_inputs("zeta alpha zeta", 1 << 15)
    assert (a[0] == a[2]).all() and (a[0] != a[1]).any()
    text = " ".join(f"tok{i}" for i in range(60_000))
    cut = token_inputs(text, 1 << 15)
    assert len(cut) == 60_000 and (cut[59_999] == token_inputs("tok59999", 1 << 15)[0]).all()


def test_long_rows_are_in_the_toxicity_sample(spark):
    """With all their windows, and the total of windows bounds the rows of each class."""
    lengths = {i: 3000 if i % 4 == 0 else 20 for i in range(40)}
    docs = spark.createDataFrame([(i, prose(i, n), "en", "s", 0) for i, n in lengths.items()], DOC_SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i < 20)) for i in range(40)], LABEL_SCHEMA)
    p = GruParams()
    size = {i: len(window_starts(n, p)) for i, n in lengths.items()}
    rows = training_rows(docs, labels, "toxic", p)
    assert [len(r[0]) for r in rows] == [size[i] for i in range(40)] and max(size.values()) > p.sample_windows
    assert [r[2] for r in rows] == [float(i < 20) for i in range(40)]
    p = GruParams(toxic_rows=12, clean_rows=12)
    for y in (0, 1):
        own = [len(r[0]) for r in training_rows(docs, labels, "toxic", p) if r[2] == y]
        assert 0 < len(own) <= 12 and sum(own) <= 12 * p.sample_windows and max(own) > p.sample_windows
