"""Substring dedup, decontamination and top-k search against plain definitions."""

import collections
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from llm_cases import DOC_SCHEMA, empty_docs, odd_docs, prose

import servicelens
from servicelens.llm.decontaminate import LeakIndex, LeakParams, benchmark_leaks, count_similarity, drop_leaks, item_passes, load_index, window_fingerprints
from servicelens.llm.mtree import MTree, TreeParams, top_k
from servicelens.llm.simhash_dedup import fingerprint, shingle_hashes
from servicelens.llm.substring_dedup import chunk_cuts, drop_spans, duplicate_spans, gear_hashes

ITEM_SCHEMA = "item_id long, text string"


def plain_leaks(docs, items, words=5, least=0.8):
    """Best similarity of any window of the item's length, by shingle counts, for all pairs."""
    out = {}
    for d, text in docs:
        low = (text or "").lower().split()
        for i, item in items:
            want = (item or "").lower().split()
            k = min(words, len(want))
            if not k:
                continue
            grams = lambda x, k=k: [tuple(x[j : j + k]) for j in range(len(x) - k + 1)] if len(x) >= k else [tuple(x)] if x else []
            a, b = grams(low), collections.Counter(grams(want))
            n = min(len(a), sum(b.values()))
            for s in range(len(a) - n + 1) if n else ():
                w = collections.Counter(a[s : s + n])
                both = sum((w & b).values())
                sim = both / (n + sum(b.values()) - both)
                if sim >= least:
                    out[d, i] = max(out.get((d, i), 0), sim)
    return out


def leak_cases():
    rng = random.Random(4)
    items = [(i, prose(500 + i, 8 + 3 * i)) for i in range(14)] + [(50, "two words"), (51, ""), (52, None), (53, prose(500, 8)), (54, "a a a a a a a a a a")]
    docs = []
    for j in range(60):
        body = prose(j, 30 + j).split()
        for _ in range(j % 3):
            item = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):  # near copies
                if item:
                    item[rng.randrange(len(item))] = "other"
            at = rng.randrange(len(body))
            body[at:at] = item
        docs.append((j, " ".join(body) if j % 2 else "\n".join(body).upper()))
    return docs, items


def test_leaks_equal_brute_force(spark):
    docs, items = leak_cases()
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], DOC_SCHEMA)
    bench = spark.createDataFrame(items, ITEM_SCHEMA)
    want = plain_leaks(docs, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in benchmark_leaks(df, bench).collect()}
    assert got == pytest.approx(want) and any(s < 1 for s in want.values())
    clean = sorted(r.doc_id for r in drop_leaks(df, bench).collect())
    assert clean == sorted(d for d, _ in docs if d not in {x for x, _ in want})


def test_leaks_in_several_passes(spark):
    docs, items = leak_cases()
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], DOC_SCHEMA)
    got = {(r.doc_id, r.item_id): r.similarity for r in benchmark_leaks(df, spark.createDataFrame(items, ITEM_SCHEMA), LeakParams(items_a_pass=4)).collect()}
    assert got == pytest.approx(plain_leaks(docs, items))


def test_rows_without_leaks_in_several_passes(spark):
    docs, items = leak_cases()
    rows = [(d, t, "en", "s", 0) for d, t in docs] + [(None, items[3][1], "en", "s", 0), (None, None, None, None, None), (7, "clean words only", "en", "s", 0)]
    df = spark.createDataFrame(rows, DOC_SCHEMA).selectExpr("*", "'mine' as __row", "'mine' as __hit", "'mine' as `a.b`")
    bench, p = spark.createDataFrame(items, ITEM_SCHEMA), LeakParams(items_a_pass=4)
    assert len(item_passes(bench, p)) > 2 and item_passes(bench.limit(0), p) == []
    bad = {d for d, _ in plain_leaks(docs, items)}
    got = drop_leaks(df, bench, p)
    assert got.columns == df.columns
    want = sorted([str(d) for d, _ in docs if d not in bad] + ["None", "7"])
    assert sorted(str(r.doc_id) for r in got.collect()) == want


def test_pass_files_hold_each_item_once(spark):
    items = [(i % 40, prose(i % 40, 20)) for i in range(120)]  # repeated items count once
    paths = item_passes(spark.createDataFrame(items, ITEM_SCHEMA), LeakParams(items_a_pass=7))
    held = [i for p in paths for i in load_index(p).ids]
    assert sorted(held) == list(range(40)) and len(paths) > 3


def test_leaks_of_odd_rows(spark):
    df = odd_docs(spark)
    bench = spark.createDataFrame([(1, prose(3, 80)), (None, prose(7, 90)), (2, "word"), (3, None)], ITEM_SCHEMA).selectExpr("*", "1 as similarity", "2 as doc_id")
    got = sorted(((r.doc_id, r.item_id) for r in benchmark_leaks(df, bench).collect()), key=str)
    assert got == sorted([(3, 1), (3, 1), (None, None), (None, None), (9, 2)], key=str)
    assert drop_leaks(df, bench).columns == df.columns and drop_leaks(df, bench).count() == df.count() - 5
    assert benchmark_leaks(empty_docs(spark), bench).collect() == []
    assert drop_leaks(df, bench.limit(0)).count() == df.count()


def test_blocks_give_all_within_the_radius():
    p = LeakParams()
    items = [(i, prose(i, 40)) for i in range(200)]
    index = LeakIndex(items, p)
    c = index.classes[5, 36]
    rng = np.random.default_rng(1)
    fps = c.fps[rng.integers(0, 200, 300)].copy()
    for i in range(len(fps)):
        for b in rng.permutation(64)[: rng.integers(0, 30)]:
            fps[i] ^= np.uint64(1 << int(b))
    w, t, far = c.candidates(fps, p)
    want = {(i, j) for i in range(300) for j in range(200) if int(fps[i] ^ c.fps[j]).bit_count() <= p.radius}
    assert set(zip(w.tolist(), t.tolist())) == want and (far <= p.radius).all()


def test_window_fingerprints():
    h = shingle_hashes(prose(5, 100), 5)
    got = window_fingerprints(h, np.arange(0, 60), 30)
    assert got.tolist() == [fingerprint(h[i : i + 30]) for i in range(60)]
    assert count_similarity(np.array([1, 1, 2]), np.array([1, 2, 2])) == pytest.approx(0.5)


def test_gear_hash_and_cuts():
    data = np.frombuffer(prose(2, 400).encode(), np.uint8)
    h = 0
    from servicelens.llm.substring_dedup import GEAR

    plain = []
    for c in data:
        h = ((h << 2) + int(GEAR[c])) & 0xFFFFFFFF
        plain.append(h)
    assert gear_hashes(data).tolist() == plain
    start, stop, words = chunk_cuts(data, 12)
    assert words.sum() == 400 and words.max() <= 24 and (words[1:-1] <= 12).all()
    text = data.tobytes()
    assert b" ".join(text[a:b] for a, b in zip(start, stop)) == text
    shifted = np.frombuffer(b"some new words here " + text, np.uint8)
    other = {shifted.tobytes()[a:b] for a, b in zip(*chunk_cuts(shifted, 12)[:2])}
    assert sum(text[a:b] not in other for a, b in zip(start, stop)) <= 3


def span_docs():
    passage, line = prose(900, 51), prose(901, 10)
    rows = []
    for i in range(40):
        body = prose(i, 60).split()
        if i % 4 == 1:
            body[7 + i % 5 : 7 + i % 5] = passage.split()
        if i % 4 == 2:
            body[3:3] = line.split()
        rows.append((i, " ".join(body)))
    return rows, passage


def test_long_passages_are_found_and_short_lines_left(spark):
    rows, passage = span_docs()
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOC_SCHEMA)
    spans = duplicate_spans(df)
    got = spans.collect()
    assert sorted(r.doc_id for r in got) == [i for i in range(40) if i % 4 == 1 and i > 1]
    text = dict(rows)
    for r in got:
        cut = text[r.doc_id].encode()[r.start : r.stop].decode()
        assert cut in passage and len(cut.split()) == r.n_words >= 20 and r.first_doc_id == 1 and r.first_doc_ids[0] == 1 and set(r.first_doc_ids) <= {i for i in range(r.doc_id) if i % 4 == 1}
    kept = {r.doc_id: r.text for r in drop_spans(df, spans).collect()}
    cuts = {r.doc_id: r for r in got}
    for d, t in rows:
        want = (t.encode()[: cuts[d].start] + t.encode()[cuts[d].stop :]).decode() if d in cuts else t
        assert kept[d] == want


def test_passages_that_open_with_short_words_are_found(spark):
    """Nine one-letter words first: the sure run is 20 words, the shortest there can be."""
    rows, later = [], []
    for s in range(300):
        rng = random.Random(7000 + s)
        passage = " ".join([rng.choice("abcdefghij") for _ in range(9)] + prose(8000 + s, 42).split())
        for i in (2 * s, 2 * s + 1):
            rows.append((i, f"{prose(20_000 + i, 40)} {passage} {prose(30_000 + i, 40)}", "en", "s", 0))
        later.append(2 * s + 1)
    got = duplicate_spans(spark.createDataFrame(rows, DOC_SCHEMA)).collect()
    assert {r.doc_id for r in got} == set(later) and min(r.n_words for r in got) < 24


def test_copies_of_short_documents_are_found(spark):
    rows = [(100 * n + i, prose(40_000 + n, n)) for n in range(1, 31) for i in range(3)]
    rows += [(5000, "word"), (5001, " word\n"), (5002, "word other"), (5003, prose(1, 60) + " word"), (5004, "")]
    got = duplicate_spans(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOC_SCHEMA)).collect()
    want = [(100 * n + i, 0, len(prose(40_000 + n, n)), n, 100 * n) for n in range(1, 31) for i in (1, 2)] + [(5001, 1, 5, 1, 5000)]
    assert sorted((r.doc_id, r.start, r.stop, r.n_words, r.first_doc_id) for r in got) == want


def test_texts_of_one_id_have_their_own_spans(spark):
    a, b = prose(50_000, 120), prose(50_001, 120)
    first, second = f"{prose(50_002, 30)} {a} {prose(50_003, 30)}", f"{b} {prose(50_004, 50)}"
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in [(1, a), (2, b), (7, first), (7, second), (7, second), (8, first)]], DOC_SCHEMA)
    got = duplicate_spans(df)
    alone = duplicate_spans(df.where("doc_id < 7").unionByName(df.where("doc_id = 8")))
    key = lambda r: (r.start, r.stop, r.n_words, r.first_doc_id)
    rows = [r for r in got.collect() if r.doc_id == 7]
    assert len(rows) == 2 and len({r.text_hash for r in rows}) == 2
    assert sorted(r.first_doc_id for r in rows) == [1, 2] and all(r.n_words >= 97 for r in rows)
    assert [key(r) for r in rows if r.first_doc_id == 1] == [key(r) for r in alone.where("doc_id = 8").collect()]
    cuts = {r.first_doc_id: r for r in rows}
    left = lambda t, r: (t.encode()[: r.start] + t.encode()[r.stop :]).decode()
    want = sorted([left(first, cuts[1]), left(second, cuts[2]), left(second, cuts[2])])
    assert sorted(r.text for r in drop_spans(df, got).collect() if r.doc_id == 7) == want


def test_spans_of_odd_rows(spark):
    df = odd_docs(spark)
    got = duplicate_spans(df).collect()
    assert [(r.doc_id, r.first_doc_id) for r in got] == [(2, 1)]  # repeated rows of one id are one document
    assert duplicate_spans(empty_docs(spark)).collect() == []
    assert drop_spans(df, duplicate_spans(df)).columns == df.columns


def test_all_long_repeats_of_the_table_are_found(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = collections.defaultdict(set)
    for r in df.select("doc_id", "text").collect():
        w = r.text.split()
        for k in range(len(w) - 50):
            seen[tuple(w[k : k + 51])].add(r.doc_id)
    want = {d for v in seen.values() for d in v - {min(v)}}
    assert want and want <= {r.doc_id for r in duplicate_spans(df).collect()}


VEC_SCHEMA = "vec_id long, embedding array<float>"


def plain_top(rows, k, mod):
    use = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    ints = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in use]
    out = []
    for q, v in ints:
        if q % mod == 0:
            best = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in ints if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_of_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [0.5] * 6) for i in range(60)] + [(201, [0.5] * 6)] * 5  # ties, repeated rows
    rows += [(300, None), (320, [1.0, None] * 3), (340, [float("nan")] + [0.1] * 5), (360, [float("inf")] * 6), (None, [9.0] * 6), (380, []), (400, [0.25] * 3)]
    df = spark.createDataFrame(rows, VEC_SCHEMA).selectExpr("*", "1 as score", "2 as rank", "3 as tree")
    for p in (TreeParams(), TreeParams(vectors_a_tree=40, queries_a_block=3, page=8, fanout=3)):
        assert sorted(map(tuple, top_k(df, 20, 20, p).collect())) == plain_top(rows, 20, 20)
    assert top_k(df.limit(0)).collect() == []
    assert sorted(map(tuple, top_k(df.where("vec_id < 5")).collect())) == plain_top(rows[:5], 20, 20)


def test_vectors_of_the_query_id_take_no_place(spark):
    """An id with many vectors, all nearer to each other than any other is."""
    rng = random.Random(3)
    rows = [(20, [2 + rng.uniform(0, 1) for _ in range(6)]) for _ in range(60)]
    rows += [(1000 + 20 * i + 1, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(100)]
    every = sorted((x for x in plain_top(rows, len(rows), 20)), key=lambda x: (-x[3], x[2]))
    want = [(20, n + 1, i, s) for n, (_, _, i, s) in enumerate(every[:20])]  # of all its vectors together
    df = spark.createDataFrame(rows, VEC_SCHEMA)
    for p in (TreeParams(), TreeParams(vectors_a_tree=40, queries_a_block=3, page=8, fanout=3)):
        assert sorted(map(tuple, top_k(df, 20, 20, p).collect())) == want


def test_top_k_over_several_steps_of_trees(spark):
    """Bounds go from tree to tree; large components need more than single precision."""
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [rng.uniform(-1e5, 1e5) for _ in range(6 + i % 3)]) for i in range(60)]
    df = spark.createDataFrame(rows, VEC_SCHEMA)
    p = dict(vectors_a_tree=30, queries_a_block=3, page=8, fanout=3)
    for some, steps in ((rows[:150], 1), (rows[:150], 2), (rows, 2)):
        got = top_k(df.where(f"vec_id <= {some[-1][0]}"), 20, 20, TreeParams(trees_a_task=steps, **p)).collect()
        assert sorted(map(tuple, got)) == plain_top(some, 20, 20)


def test_top_k_sends_no_pairs_to_the_driver():
    """All queries, once for each of the trees, have over 2 MB, which is what the driver takes."""
    code = """
import random
from pyspark.sql import SparkSession
from servicelens.llm.mtree import TreeParams, top_k
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.driver.maxResultSize", "2m").getOrCreate())
rng = random.Random(6)
rows = [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(4000)]
df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
print("rows", top_k(df, 20, 20, TreeParams(vectors_a_tree=64, queries_a_block=64, page=32)).count())
"""
    env = os.environ | {"PYTHONPATH": os.pathsep.join([os.path.dirname(os.path.abspath(servicelens.__path__[0])), os.environ.get("PYTHONPATH", "")])}
    run = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "rows 4000" in run.stdout, run.stderr[-2000:]


def test_tree_bounds_save_computations():
    """Clustered vectors: the stored bounds leave most pages unread, and the answer is exact."""
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(60, 8)) * 200
    x = np.floor(centre[rng.integers(0, 60, 4000)] + rng.normal(size=(4000, 8)) * 4)
    ids = np.arange(4000)
    tree = MTree(ids, x, TreeParams(page=32, fanout=8))
    assert sorted(tree.ids.tolist()) == ids.tolist()
    share = []
    for q in range(0, 4000, 200):
        got, computed = tree.search(x[q], q, 20)
        want = sorted((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:20]
        assert got == [(-s, i) for s, i in want]
        share.append(computed / 4000)
    assert np.mean(share) < 0.5
