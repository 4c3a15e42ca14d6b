"""Small tables that hold the awkward cases."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(1000)}" for _ in range(n))


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows() -> list[tuple]:
    """NULLs in each column, empty and very long texts, ties and repeated rows."""
    long_text = prose(99, 60_000)
    rows = [
        (1, prose(1, 120), "en", "a", 1), (2, prose(1, 120), "en", "a", 1), (3, prose(3, 80), "de", "b", 1), (3, prose(3, 80), "de", "b", 1),
        (4, None, "en", "a", None), (5, "", "fr", "b", 0), (6, " \t\n ", None, None, 3), (None, prose(7, 90), "en", "a", 1),
        (None, prose(7, 90), "en", "a", 1), (None, None, None, None, None), (8, long_text, "en", "c", len(long_text)),
        (9, "word", "en", None, 4), (10, "1234 !!", "en", "c", 7), (11, "ÀÉ ünïcode 漢字 😀", "fr", "c", 9), (12, prose(12, 200), "en", "a", 1),
    ]
    return rows


def odd_docs(spark, extra: bool = True):
    df = spark.createDataFrame(odd_rows(), DOC_SCHEMA)
    if extra:  # names that the operators use for their own results
        for c in ("score", "shard", "fp", "label", "component_id", "tokens", "x", "skey", "digest", "u", "predicted", "rep"):
            df = df.selectExpr("*", f"'mine' as {c}")
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def label_rows(n: int = 13) -> list[tuple]:
    return [(i, i % 2, int(i % 3 == 0)) for i in range(n)] + [(1, None, None), (None, 1, 1), (3, 1, 0), (3, 1, 0), (900, 0, 1)]


LABEL_SCHEMA = "doc_id long, quality int, toxic int"
