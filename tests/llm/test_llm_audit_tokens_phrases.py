"""Source divergence, token files and collocations against brute force, and their odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import DOC_SCHEMA, empty_docs, odd_docs, odd_rows, prose

from servicelens.llm import collocations as C
from servicelens.llm import token_files as T
from servicelens.llm.common import table
from servicelens.llm.divergence import DivergenceParams, source_divergence

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 0) for i, (t, lang, source) in enumerate(rows)], DOC_SCHEMA)


# ------------------------------------------------------------------ divergence
def divergence(rows, min_docs=3, top=200, scale=10**9):
    df, n, groups = defaultdict(set), Counter(), set()
    for i, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for w in TERM.findall((text or "").translate(A_Z)):
            df[lang, w].add(i)
            n[lang, source, w] += 1
    out = []
    for lang, source in groups:
        kept = [w for (x, w), d in df.items() if x == lang and len(d) >= min_docs]
        mine = [s for x, s in groups if x == lang]
        of = lambda s: {w: n[lang, s, w] for w in kept}
        share = lambda c: {w: 1 + scale * (k + 1) // (sum(c.values()) + len(kept)) for w, k in c.items()}
        p, q = share(of(source)), share({w: sum(n[lang, s, w] for s in mine) for w in kept})
        pairs = [(s, sum((p[w] - r[w]) ** 2 // r[w] for w in kept)) for s in mine if s != source for r in [share(of(s))]]
        terms = [(w, (p[w] - q[w]) ** 2 // q[w]) for w in kept if n[lang, source, w] and p[w] > q[w]]
        for part, items in (("pair", pairs), ("term", terms)):
            items = sorted(items, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, w, v, k) for k, (w, v) in enumerate(items[: top if part == "term" else None], 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.drop("n").collect())


def test_divergence_equals_brute_force_with_odd_rows(spark):
    rows = [(t, lang, source) for _, t, lang, source, _ in odd_rows()]
    rows += [(f"The {prose(i % 4, 30)} (the) the-the, {'é' * (i % 3)}x THE", ("en", "de", None)[i % 3], ("a", "b", None, "c c")[i % 4]) for i in range(60)]
    df = docs_of(spark, rows).selectExpr("*", "'mine' as term", "'mine' as value", "1 as total", "2 as p0")
    assert result(source_divergence(df.repartition(5))) == divergence(rows)
    small = result(source_divergence(df.repartition(3), DivergenceParams(min_docs=1, top_terms=4)))
    assert small == divergence(rows, 1, 4) and max(r[5] for r in small if r[2] == "term") == 4
    assert result(source_divergence(odd_docs(spark))) == divergence([(t, lang, s) for _, t, lang, s, _ in odd_rows()])


def test_a_document_counts_once_whatever_chunks_a_term_is_in(spark):
    rows = [("word word, (word) -word-", "en", "a"), ("word", "en", "b"), ("other", "en", "a"), ("other,", "en", "a"), ("(other)", "en", "b"), *[("extra", "en", "a")] * 3]
    got = result(source_divergence(docs_of(spark, rows)))
    assert {r[3] for r in got if r[2] == "term"} == {"other", "extra"}
    assert got == divergence(rows)


def test_divergence_without_terms_and_of_an_empty_table(spark):
    assert result(source_divergence(empty_docs(spark))) == []
    assert result(source_divergence(docs_of(spark, [("", "en", "a"), ("12", "en", "b"), (None, "de", "a")]))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


# ------------------------------------------------------------------ token files
@pytest.fixture(scope="module")
def word_bpe():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def encoded(library, rows):
    """(doc_id, start, n_tokens, crc) by the library on whole texts; NULL ids last."""
    out, at = [], 0
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_tokens_equal_whole_texts_by_the_library(spark, word_bpe):
    path, library = word_bpe
    rows = sorted((r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.001", "documents").collect())
    got = sorted(tuple(r) for r in T.token_codes(table(spark, "/root/testdata/sf0.001", "documents"), path).collect())
    assert got == encoded(library, rows)


def test_odd_texts_and_special_strings(word_bpe):
    import pyarrow as pa

    path, library = word_bpe
    encoder = T.Encoder(open(path).read())
    assert encoder.plain
    odd = ["a<|endoftext|>b c", "IT'S don't I 've 're''s", "é É É ÀÉ ünïcode 漢字 😀 ΑΣ ẖ H̱", "x y　z \x1c q \x85 \x00 \x7f", "", None, " \n", "a1b2 <c> $%& ½",
           "y" * 3000 + " 12 " * 500]
    ids, ends = encoder.encode(pa.array(odd, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode(t or "", add_special_tokens=False).ids for t in odd]
    other = T.Encoder(open(path).read())
    other.plain = False  # of a tokenizer with other rules all chunks go through the library
    assert other.encode(pa.array(odd, pa.string()))[0].tolist() == ids.tolist()


def test_odd_rows_order_and_starts(spark, word_bpe):
    path, library = word_bpe
    got = [tuple(r) for r in T.token_codes(odd_docs(spark).repartition(4), path).collect()]
    want = Counter((d, n, crc) for d, _, n, crc in encoded(library, [(r[0], r[1]) for r in odd_rows()]))
    assert Counter((d, n, crc) for d, _, n, crc in got) == want
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got[:-1])]).tolist()
    ids = [r[0] for r in got]
    assert ids == sorted((x for x in ids if x is not None)) + [None] * ids.count(None)
    assert T.token_codes(empty_docs(spark), path).collect() == []


def test_files_give_any_token_alone(spark, word_bpe, tmp_path):
    path, library = word_bpe
    manifest = T.write_token_files(odd_docs(spark), path, 1, folder=f"file://{tmp_path}/out", file_tokens=2000).orderBy("part", "seq").collect()
    assert len(manifest) > 1 and sum(m.n_docs for m in manifest) == len(odd_rows())
    for m in manifest:
        f = T.TokenFile(m.path)
        whole = f.tokens(0, f.n_tokens)
        assert f.n_tokens == m.n_tokens == len(whole)
        for i in np.random.default_rng(1).integers(0, f.n_tokens, 40).tolist():
            assert f.token(i) == whole[i]
        ids, first = f.documents()
        assert len(ids) == m.n_docs and first[-1] == f.n_tokens and all(whole[x - 1] == 1 for x in first[1:])


def test_codes_of_all_lengths(tmp_path):
    rng = np.random.default_rng(3)
    ids = (rng.integers(0, 1 << 32, 5000, dtype=np.uint64) >> rng.integers(0, 32, 5000).astype(np.uint64)).astype(np.uint32)
    (tmp_path / "x").write_bytes(T.file_bytes([7, None], np.array([4999, 1]), ids))
    f = T.TokenFile(str(tmp_path / "x"))
    assert len(f.levels) == 4 and f.documents()[0] == [7, None]
    for a, b in [(0, 5000), (511, 513), (512, 1024), (4999, 5000), (17, 17), *((int(x), min(5000, int(x) + 700)) for x in rng.integers(0, 5000, 30))]:
        assert (f.tokens(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        (tmp_path / "y").write_bytes(b"no tokens" * 9)
        T.TokenFile(str(tmp_path / "y"))


# ------------------------------------------------------------------ collocations
def phrases(rows, least=30, top=2000, covered=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(A_Z)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + d]) for d in range(1, 5) for i in range(len(w) - d + 1))
    found = {k: v for k, v in f.items() if len(k) > 2 and v >= least}
    around = Counter()
    for k, v in found.items():
        for m in range(2, len(k) - 1):
            for o in range(1, len(k) - m + 1):
                around[k[0], *k[o : o + m]] = max(around[k[0], *k[o : o + m]], v)
    by = defaultdict(list)
    for k, a in found.items():
        if 100 * around[k] < covered * a:
            sides = [(f[k[:c]], f[k[0], *k[c:]]) for c in range(2, len(k))]
            score, _, l, r = min((2_000_000 * a // (x + y), i, x, y) for i, (x, y) in enumerate(sides))
            by[k[0]].append((-score, -a, " ".join(k[1:]).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, v in by.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1))


@pytest.mark.parametrize("split", [8192, 8])
def test_collocations_equal_brute_force(spark, split):
    rng = np.random.default_rng(4)
    words = "The of new york city is on he x'y é 漢 a\x0bb".split(" ")
    rows = [(("en", None, "und", "de")[i % 4], ("New York City is, " if i % 3 else "of the of the. ") + " ".join(rng.choice(words, 40)) + rng.choice(list(".,;\n\t "))) for i in range(200)]
    rows += [("en", None), (None, ""), ("fr", "one two")]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOC_SCHEMA).selectExpr("*", "'x' as word", "1 as block", "2 as a", "3 as key").repartition(5)
    for least, top in ((30, 2000), (5, 3)):
        got = sorted(tuple(r) for r in C.collocations(docs, C.PhraseParams(least=least, top=top, split=split)).collect())
        assert got == phrases(rows, least, top) and got


def test_collocations_of_odd_and_empty_tables(spark):
    rows = [(r[2], r[1]) for r in odd_rows()]
    got = sorted(tuple(r) for r in C.collocations(odd_docs(spark), C.PhraseParams(least=2)).collect())
    assert got == phrases(rows, 2) and got
    assert C.collocations(empty_docs(spark)).collect() == []
    assert C.collocations(odd_docs(spark)).collect() == []


def test_quicksort_counts_and_abandons():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 4, (3000, 4)).astype(np.int32)
    w[:, 0] += 1
    for k in range(1, 4):
        w[:, k] *= w[:, k - 1] > 0
    weight = rng.integers(1, 4, 3000)
    for least, from_ in ((40, 0), (1, 0), (40, 3)):
        for d, (prefix, n) in enumerate(C.multikey_counts(w, weight, least, from_)):
            want = Counter()
            for r, x in zip(w.tolist(), weight.tolist()):
                if r[d]:
                    want[tuple(r[: d + 1])] += x
            assert dict(zip(map(tuple, prefix.tolist()), n.tolist())) == {k: v for k, v in want.items() if d < from_ or v >= least}
    assert all(len(p) == 0 for p, _ in C.multikey_counts(w[:0], weight[:0], 3))
