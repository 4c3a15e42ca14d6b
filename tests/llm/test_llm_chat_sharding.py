"""Chat rotation, sharding and mixing against plain definitions."""

import collections
import math

import pytest
from llm_cases import DOC_SCHEMA, empty_docs, odd_docs, prose

from servicelens.llm.chat import ChatParams, rotate
from servicelens.llm.mixing import MixParams, find_exponent, mixed
from servicelens.llm.sharding import ShardParams, lookup_table, shard_counts, shard_names, with_shard, write_shards

CHAT_SCHEMA = "conv_id long, turn long, role string, text string"
CHAT = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_end|> there"), (1, 2, "assistant", ""), (1, 3, "guide one", "ünï 漢"), (1, 3, "user", "tie"),
    (1, 1, "user", "hi <|im_end|> there"), (2, 0, "user", None), (2, None, None, "lost"), (3, 0, "system", "alone"), (None, 5, "user", "x"), (None, 600, "user", "later"),
]


def plain_rotation(rows, span=512):
    out = {}
    clean = {(c, t, (r or "").strip(" ") or "unknown", x or "") for c, t, r, x in rows}
    for conv in {c for c, *_ in clean}:
        own = [x for x in clean if x[0] == conv]
        for me in {r for _, _, r, _ in own} - {"system"}:
            for part in {0 if t is None else t // span for _, t, _, _ in own}:
                seen = sorted((x for x in own if (0 if x[1] is None else x[1] // span) == part), key=lambda x: (x[1] is not None, x[1] or 0, x[2], x[3]))
                text, spans = "", []
                for _, _, role, body in seen:
                    text += "<|im_start|>" + ("assistant" if role == me else role if role == "system" else "user name=" + "_".join(role.split())) + "\n"
                    at = len(text)
                    text += body.replace("<|", "< |") + "<|im_end|>"
                    if role == me:
                        spans.append((at, len(text)))
                    text += "\n"
                out[conv, me, part] = (len(seen), text, spans)
    return out


def test_rotation_equals_definition(spark):
    df = spark.createDataFrame(CHAT, CHAT_SCHEMA).selectExpr("*", "'mine' as perspective", "1 as part", "2 as spans")
    got = {(r.conv_id, r.perspective, r.part): (r.n_turns, r.text, [tuple(s) for s in r.spans]) for r in rotate(df).collect()}
    assert got == plain_rotation(CHAT)
    for (_, _, _), (_, text, spans) in got.items():
        assert all(text[a:b].endswith("<|im_end|>") and "<|im_start|>" not in text[a:b] for a, b in spans)


def test_rotation_in_parts_and_empty(spark):
    rows = [(1, i, "ab"[i % 2], f"t{i}") for i in range(40)]
    got = {(r.conv_id, r.perspective, r.part): (r.n_turns, r.text, [tuple(s) for s in r.spans]) for r in rotate(spark.createDataFrame(rows, CHAT_SCHEMA), ChatParams(turns_a_part=16)).collect()}
    assert got == plain_rotation(rows, 16) and len(got) == 6
    assert rotate(spark.createDataFrame([], CHAT_SCHEMA)).collect() == []


def test_rows_without_a_conversation_are_dialogues_of_their_own(spark):
    rows = [(None, i % 5, "ab"[i % 2], f"t{i}") for i in range(60)] + [(None, 1, "b", "t1"), (None, None, "a", ""), (None, 3, "system", "s")]
    rows += [(1, 0, "a", "x"), (1, 1, "b", "y")]
    got = rotate(spark.createDataFrame(rows, CHAT_SCHEMA)).collect()
    alone = [r for r in got if r.conv_id is None]
    assert len(alone) == 61 and {r.n_turns for r in alone} == {1}  # the repeat counts once, system turns alone give none
    assert sum(len(r.spans) for r in alone) == 61
    assert sorted((r.perspective, r.n_turns) for r in got if r.conv_id == 1) == [("a", 2), ("b", 2)]


@pytest.mark.parametrize(("n", "slots"), [(1, 2), (3, 7), (64, 6553), (10, 1009)])
def test_lookup_table(n, slots):
    names = shard_names(n)
    table = lookup_table(names, slots)
    share = collections.Counter(table)
    assert len(table) == slots and max(share.values()) - min(share.values()) <= 1 and len(share) == n
    assert table == lookup_table(names, slots)


def test_lookup_table_moves_little():
    a, b = lookup_table(shard_names(20), 2003), lookup_table(shard_names(19), 2003)
    moved = sum(x != y and x != 19 for x, y in zip(a, b))
    assert moved / 2003 < 0.15
    with pytest.raises(ValueError):
        lookup_table(shard_names(4), 1000)


def test_sharding_of_odd_rows(spark, tmp_path):
    df = odd_docs(spark)
    got = with_shard(df)
    assert got.columns[-1] == "shard" and sorted(got.columns) == sorted(df.columns)
    rows = got.collect()
    assert len(rows) == df.count() and all(0 <= r.shard < 64 for r in rows)
    by = collections.defaultdict(set)
    for r in rows:
        by[r.doc_id, r.text if r.doc_id is None else 0].add(r.shard)
    assert all(len(v) == 1 for v in by.values())
    write_shards(got.select("doc_id", "text", "shard"), str(tmp_path / "out"), files_a_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, shard_counts(back).collect())) == sorted(map(tuple, shard_counts(got).collect()))
    assert with_shard(empty_docs(spark)).collect() == []


def test_shards_are_even(spark):
    got = shard_counts(with_shard(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), ShardParams(8, 809))).collect()
    assert max(r.n_docs for r in got) < 1.15 * 10000 / 8


def corpus(spark):
    rows, i = [], 0
    for source, n in (("big", 900), ("mid", 300), ("small", 60), (None, 20)):
        for _ in range(n):
            rows.append((i, prose(i, 5 + i % 23), "en", source, 0))
            i += 1
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.mark.parametrize("p", [MixParams(), MixParams(max_repetition=4.0), MixParams(target="entropy", entropy_share=0.9), MixParams(budget_tokens=9000, max_repetition=2.0)])
def test_mixing_meets_budgets(spark, p):
    df = corpus(spark)
    tokens = {r.doc_id: len((r.text or "").split()) for r in df.collect()}
    source = {r.doc_id: r.source for r in df.collect()}
    size = collections.Counter()
    for d, n in tokens.items():
        size[source[d]] += n
    share = {s: n / sum(size.values()) for s, n in size.items()}
    weights = lambda a: {s: x**a / sum(y**a for y in share.values()) for s, x in share.items()}
    entropy = lambda w: -sum(x * math.log(x) for x in w.values())
    ratio = lambda w: max(w[s] / share[s] for s in w) / min(w[s] / share[s] for s in w)
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        over = entropy(weights(mid)) >= p.entropy_share * math.log(len(share)) if p.target == "entropy" else ratio(weights(mid)) > p.max_repetition
        low, high = (mid, high) if over else (low, mid)
    w = weights(low)
    total = p.budget_tokens or max(size[s] / w[s] for s in w)
    got = mixed(df, p).collect()
    drawn = collections.Counter()
    for r in got:
        drawn[r.source] += tokens[r.doc_id]
    for s in w:
        assert 0 <= drawn[s] - round(total * w[s]) <= max(n for d, n in tokens.items() if source[d] == s) + 1
    times = collections.Counter((r.doc_id, r["__epoch"]) for r in got)
    assert set(times.values()) == {1}
    full = {s: round(total * w[s]) // size[s] for s in w}
    count = collections.Counter(r.doc_id for r in got)
    assert all(count[d] in (full[source[d]], full[source[d]] + 1) for d in tokens)


def test_epochs_are_different_permutations(spark):
    got = mixed(corpus(spark), MixParams(budget_tokens=60000, max_repetition=1.2)).where("source = 'big'").collect()
    order = lambda e: [r.doc_id for r in sorted((x for x in got if x["__epoch"] == e), key=lambda x: x["__order"])]
    assert sorted(order(0)) == sorted(order(1)) and order(0) != order(1) and order(0) != sorted(order(0))


def test_mixing_of_odd_rows(spark):
    df = odd_docs(spark)
    got = mixed(df)
    assert got.columns == [*df.columns, "__epoch", "__order"]
    first = got.where("__epoch = 0").count()
    assert first == df.count()
    assert mixed(empty_docs(spark)).collect() == []
    only = spark.createDataFrame([(1, "", "en", "s", 0), (2, None, "en", "s", 0)], DOC_SCHEMA)
    assert sorted(r.doc_id for r in mixed(only).collect()) == [1, 2]


def test_exponent_of_one_source(spark):
    assert find_exponent(spark.createDataFrame([("s", 3, 10)], "skey string, n_docs long, tokens long"), MixParams()) == 1.0
