from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """Rows of the smallest documents table."""
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in all columns, empty and blank texts, repeated rows, repeated ids, a long text, clashing column names."""
    long = words(random.Random(1), 60_000)
    rows = [
        (1, None, None, "x"), (None, None, None, None), (2, "", "b", "x"), (3, " \n\t ", "a", "x"), (None, long[:900], "a", None),
        (4, long, "a", "x"), (4, long, "a", "x"), (5, long[:2000], "c", "x"), (5, "other " + long[3000:4000], None, "x"),
        (6, "あい \U0001f600 <|endoftext|> \x00 Ünï \x85   café", "b", "x"), (7, "word", "b", "x"), (7, "word", "b", "x"),
        (-8, long[:2000], "a", "x"), (1 << 62, "Ab " * 5000, "a", "x"),
    ]
    kinds = "doc_id long, text string, source string, kept string"
    df = spark.createDataFrame(rows, kinds)
    clash = ["row", "size", "pattern", "hash", "name", "span", "doc", "first", "more", "fp", "label", "n", "id", "own", "score", "passes", "found"]
    for c in clash:
        df = df.selectExpr("*", f"kept AS {c}")
    return df.repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.filter("doc_id = 12345")
