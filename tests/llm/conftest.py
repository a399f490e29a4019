import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n, words=("the", "of", "and", "night", "river", "stone", "garden", "quiet", "window", "letter", "harbour", "signal")):
    draw = random.Random(seed)
    return " ".join(draw.choice(words) + draw.choice(["", "", "s", "ed", "ing"]) + (draw.choice("abcdefgh") if draw.random() < 0.5 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows, extra columns with clashing names."""
    base = prose(1, 60)
    rows = [
        (1, base, "en", "a", 0),
        (2, base, "en", "a", 0),
        (2, base, "en", "a", 0),
        (3, None, "en", None, None),
        (4, "", None, "a", 0),
        (5, " \t\n ", "en", "a", 0),
        (None, base, None, None, None),
        (None, None, None, None, None),
        (6, prose(2, 60), "fr", "b", 1),
        (7, prose(2, 59) + " é ☃ 😀 \x00 \x01", "fr", "b", 1),
        (8, prose(3, 20000), "en", "b", 2),
        (9, "x" * 300_000, "en", "b", 2),
        (10, "word", "en", "a", 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = ["n_words", "kept", "counts", "spans", "key", "hash", "epoch", "score", "_quality_counts", "component_id", "domain", "last", "passes", "n_tokens", "ids"]
    return docs.selectExpr("*", *[f"'x' as {c}" for c in clashing])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}
