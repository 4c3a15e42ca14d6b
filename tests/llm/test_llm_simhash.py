"""SimHash near-duplicates against plain definitions."""

import collections
import random

import numpy as np
import xxhash
from llm_cases import DOC_SCHEMA, empty_docs, odd_docs, prose

from servicelens.llm.components import connected_components
from servicelens.llm.simhash_dedup import _forest, _links, ball_links, fingerprint, head_bits, keep_representatives, shingle_hashes, simhash_dedup


def plain_fingerprint(text, words=4):
    toks = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        toks = toks.replace(c, " ")
    toks = [t for t in toks.split(" ") if t]
    if not toks:
        return 0
    shingles = [" ".join(toks[i : i + words]) for i in range(len(toks) - words + 1)] or [" ".join(toks)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(rows):
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                group[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return [(d, f"{fps[i]:016x}", min(least[find(i)], default=None)) for i, (d, _) in enumerate(rows)]


def key(r):
    return tuple((x is None, x) for x in r)


def test_fingerprint_equals_definition():
    for t in ["", "one", "A b C", "a b c d", prose(1, 50).upper(), "ÀÉ É ß\x0bx\x0cy  z", prose(2, 700)]:
        assert fingerprint(shingle_hashes(t, 4)) == plain_fingerprint(t)


def test_matches_spark_xxhash64(spark):
    """The shingle hash is Spark's own xxhash64 of the string."""
    t = "some words of a shingle"
    own = spark.sql(f"select xxhash64('{t}') h").first().h
    assert int(shingle_hashes(t, 9)[0]) == own % (1 << 64)


def test_odd_rows_equal_brute_force(spark):
    df = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = [tuple(r) for r in simhash_dedup(df).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got, key=key) == sorted(plain_groups(rows), key=key)


def test_near_copies_equal_brute_force(spark):
    rows = []
    for i in range(60):
        base = prose(i % 9, 150).split()
        for j in range(i // 9):
            base[(17 * j + i) % 150] += "x"
        rows.append((i * 3 + 1, " ".join(base)))
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOC_SCHEMA)
    got = [tuple(r) for r in simhash_dedup(df).select("doc_id", "fingerprint", "component_id").collect()]
    want = plain_groups(rows)
    assert sorted(got) == sorted(want)
    assert any(d != c for d, _, c in want)
    kept = [r.doc_id for r in keep_representatives(df).collect()]
    assert sorted(kept) == sorted({c for _, _, c in want})


def test_whole_table_equals_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = [tuple(r) for r in simhash_dedup(df).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got) == sorted(plain_groups(rows))


def test_links_join_a_dense_ball_in_small_pieces(spark, monkeypatch):
    """Everything within four bits is joined, also where buckets are cut further."""
    import servicelens.llm.simhash_dedup as m

    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = {int(c) for c in centre}
    for c in centre:
        for _ in range(40):
            v = int(c)
            for b in rng.integers(0, 64, 3):
                v ^= 1 << int(b)
            fps.add(v)
    fps = np.array(sorted(fps), np.uint64)
    near = [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 4]
    want = _forest(len(fps), np.array([a for a, _ in near]), np.array([b for _, b in near]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    links = [(place[r.u], place[r.v]) for r in ball_links(df, prefix_bits=6).collect()]
    assert all(int(fps[a] ^ fps[b]).bit_count() <= 64 for a, b in links)
    got = _forest(len(fps), np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert (got == want).all()
    monkeypatch.setattr(m, "VARIANTS", 500)
    pieces = [(place[int(np.int64(a))], place[int(np.int64(b))]) for u, v in _links(fps, 0, 0, 2) for a, b in zip(u.view(np.int64), v.view(np.int64))]
    again = _forest(len(fps), np.array([a for a, _ in pieces]), np.array([b for _, b in pieces]))
    assert (again == want).all()


def test_components_of_a_hub_a_chain_and_a_ring(spark):
    edges = [(0, i) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000 + i, 2000 + (i + 1) % 30) for i in range(30)] + [(5000, 5000), (7, 0)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(400)} | {1000 + i: 1000 for i in range(61)} | {2000 + i: 2000 for i in range(30)}
    assert got == want


def test_keep_representatives_of_odd_rows(spark):
    df = odd_docs(spark)
    kept = keep_representatives(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=lambda x: (x is None, x))
    # 2 copies 1; the repeated 3 stays once; 4, 5, 6 and a NULL id have no word; the NULL id with its own text stays once
    assert ids == [1, 3, 4, 8, 9, 10, 11, 12, None]
    assert {r.score for r in kept.select("score").collect()} == {"mine"}


def test_empty(spark):
    assert simhash_dedup(empty_docs(spark)).collect() == []
    assert keep_representatives(empty_docs(spark)).collect() == []


def test_buckets_stay_small_however_many_fingerprints():
    assert head_bits(0, 4) == head_bits(10**6, 4) == 14
    for n in (10**8, 10**9, 10**10, 10**12):
        bits = head_bits(n, 4)
        heads = 1 + bits + bits * (bits - 1) // 2
        assert 14 < bits <= 30 and (n * heads / 2**bits <= 1 << 16 or bits == 30)
        lower = bits - 1
        assert n * (1 + lower + lower * (lower - 1) // 2) / 2**lower > 1 << 16


def test_links_are_the_same_for_any_number_of_leading_bits(spark):
    rng = random.Random(8)
    near = []
    for _ in range(60):
        base = rng.getrandbits(64)
        near += [base, *(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(3))]
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in set(near)], "fp long").repartition(5)

    def groups(bits):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for r in ball_links(df, prefix_bits=bits).collect():
            root[find(r.u)] = find(r.v)
        out = {}
        for x in list(root):
            out.setdefault(find(x), set()).add(x)
        return {frozenset(g) for g in out.values()}

    assert groups(14) == groups(17) == groups(21) and len(groups(14)) == 60
