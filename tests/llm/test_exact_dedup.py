"""Exact duplicates against plain grouping, and the coded exchange."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from terracell.llm import exact_dedup

from .conftest import words


def plain(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    out = Counter()
    for text, ids in groups.items():
        ids.sort(key=lambda d: (d is None, d or 0))
        for k, d in enumerate(ids):
            out[d, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def check(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert Counter(map(tuple, exact_dedup.duplicates(df, **options).collect())) == plain(rows)


@pytest.mark.parametrize("options", [{}, {"spare": -6}, {"owned": 8}, {"spare": -6, "owned": 8}])
def test_against_plain_groups(spark, corpus, options):
    """Also with so short fingerprints that most rows are suspects, and with many owners."""
    rng = random.Random(1)
    rows = [(d, t) for d, t, _ in corpus] + [(5000 + i, rng.choice(corpus)[1]) for i in range(60)]
    rows += [(6000 + i, f"a{rng.choice([' ', '  ', chr(9), chr(13) + chr(10), chr(11)])}b{rng.choice(['', ' '])}") for i in range(30)]
    rows += [(7000 + i, t) for i, t in enumerate([" a b", "a\x85b", "a\xa0b", "a\u2003b", "A b", None, "", " ", "\t\n"])]
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), **options)


def test_odd_rows(odd, nothing):
    check(odd)
    assert exact_dedup.duplicates(nothing).count() == 0


def test_hot_group_and_missing_ids(spark):
    rows = [(None if i % 4 == 0 else i, "same  text" if i % 3 else f"text {i // 6}") for i in range(600)] + [(None, "no id")] * 5
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(9))


def test_codes_give_back_what_they_took():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 3000):
        for top in (n + 1, 10 * n + 5, 1 << 40, 1 << 60):
            values = np.unique(rng.integers(0, top, n))
            k, code = exact_dedup.encode(values)
            assert (exact_dedup.decode(code, len(values), k) == values).all()
    dense = np.unique(rng.integers(0, 1 << 28, 8000))
    assert len(exact_dedup.encode(dense)[1]) * 8 < 18 * len(dense)


def test_only_suspects_are_shuffled_with_their_texts(spark):
    """What is known of a part meets its rows where they are written."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = random.Random(3)
        df = spark.createDataFrame([(i, words(rng, 20)) for i in range(50)] + [(100, "x"), (101, "x")], "doc_id long, text string").repartition(3)
        plan = exact_dedup.duplicates(df)._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        joins = [x for x in lines if "SortMergeJoin [part" in x]
        # One side of each such join is moved, the flags; the rows are read in their buckets.
        moved = [x for x in lines if "Exchange hashpartitioning(part" in x]
        assert joins and len(moved) <= len(joins) and "Bucketed: true" in plan
        check(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
