"""Each pipeline stage against a plain version on its own input, and the awkward rows."""

import collections
import pathlib

import pytest
from llm_cases import LABEL_SCHEMA, empty_docs, label_rows, odd_docs, prose
from test_llm_simhash import plain_groups
from test_llm_text_ops import plain_leaks

import __spark_entry__ as entry
import corpus_pipeline as pipe
from servicelens.llm.mixing import MixParams
from servicelens.llm.quality import score_quality
from servicelens.llm.sharding import lookup_table, shard_names, slot_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_a_whole_table(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for i, (_, stage) in enumerate(pipe.STAGES):
        stage(spark, kept[-1], sf).write.parquet(str(tmp_path / str(i)))
        kept.append(spark.read.parquet(str(tmp_path / str(i))))
    assert all(k.columns == COLUMNS for k in kept[:-1]) and kept[-1].columns == [*COLUMNS, "shard"]
    rows = [[(r.doc_id, r.text) for r in k.collect()] for k in kept]
    good = {r.doc_id for r in score_quality(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    assert sorted(d for d, _ in rows[1]) == sorted(good)
    groups = plain_groups(rows[1])
    assert sorted(d for d, _ in rows[2]) == sorted({c for _, _, c in groups}) and len(rows[2]) < len(rows[1])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held = collections.defaultdict(set)
    for i, t in items:
        for w in range(len(t.lower().split()) - 4):
            held[tuple(t.lower().split()[w : w + 5])].add(i)
    touching = [(d, t) for d, t in rows[2] if any(tuple(x[j : j + 5]) in held for x in [t.lower().split()] for j in range(len(x) - 4))]
    leaks = {d for d, _ in plain_leaks(touching, items)}
    assert sorted(d for d, _ in rows[3]) == sorted(d for d, _ in rows[2] if d not in leaks) and leaks
    size = collections.Counter()
    for r in kept[3].collect():
        size[r.source] += len(r.text.split())
    count = collections.Counter(rows[4])
    assert set(count) == set(rows[3]) and set(count.values()) <= {1, 2}
    drawn = collections.Counter()
    for r in kept[4].collect():
        drawn[r.source] += len(r.text.split())
    ratio = {s: drawn[s] / size[s] for s in size}
    assert min(ratio.values()) == pytest.approx(1.0, abs=0.05) and max(ratio.values()) <= MixParams().max_repetition + 0.1
    table = lookup_table(shard_names(64), 6553)
    slots = kept[4].select("doc_id", slot_of(6553).alias("slot")).collect()
    assert sorted((r.doc_id, r.shard) for r in kept[5].collect()) == sorted((r.doc_id, table[r.slot]) for r in slots)
    assert sorted((r.doc_id, r.shard) for r in pipe.run(spark, sf).collect()) == sorted((r.doc_id, r.shard) for r in kept[5].collect())


def test_stages_on_odd_and_empty_rows(spark, tmp_path):
    spark.createDataFrame(label_rows(), LABEL_SCHEMA).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(3, 80)), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd_docs(spark), empty_docs(spark)):
        n = docs.count()
        for i, (name, stage) in enumerate(pipe.STAGES):
            got = stage(spark, docs, str(tmp_path))
            assert set(got.columns) == set(docs.columns) | ({"shard"} if name == "sharding" else set())
            rows = got.count()
            if name == "sharding":
                assert rows == n
            if name == "source_mixing":
                assert n <= rows <= 2 * n
            assert (rows > 0) == (n > 0)


def test_registration():
    names = entry.queries()
    assert "pipeline" in names and [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert set(entry.oracle_sql()) <= set(names)


def test_nothing_else_imports_the_subpackage():
    root = pathlib.Path(entry.__file__).parent
    for f in [*root.glob("servicelens/**/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        # the test of a copy without the subpackage names it to assert that it is not there
        if "llm" not in f.relative_to(root).parts and f.name != "test_entry_without_llm.py":
            assert "servicelens.llm" not in f.read_text() and "corpus_pipeline" not in f.read_text(), f
