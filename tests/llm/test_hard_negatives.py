"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from terracell.llm import hard_negatives

KINDS = "vec_id long, embedding array<float>, label int, anchor string, score string, q string, rid string"


def plain(rows, every=100, keep=(5, 5), low=80, high=100):
    last = lambda i: (i is None, i or 0)
    use = []
    for i, v, y, *_ in rows:
        if v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, [math.floor(256 * float(np.float32(x))) for x in v], y))
    out = Counter()
    for k, (i, v, y) in enumerate(use):
        if i is None or i % every:
            continue
        score = [(sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in use]
        near = sorted((s for m, s in enumerate(score) if m != k and s[2] == y), key=lambda s: (-s[0], last(s[1])))[: keep[0]]
        for p, j, _ in near:
            hard = sorted((s for s in score if s[2] != y and low * p <= high * s[0] <= high * p), key=lambda s: (-s[0], last(s[1])))[: keep[1]]
            for rank, (n, h, _) in enumerate(hard, 1):
                out[i, j, rank, h, p, n] += 1
    return out


def got(df):
    return Counter(map(tuple, df.collect()))


def vectors(rng, n, dims, labels, ids=None):
    base = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    for i in range(n):
        v = [b + rng.gauss(0, 0.4) for b in rng.choice(base)]
        yield (i if ids is None else rng.choice(ids), v, rng.randrange(labels), None, None, None, None)


def test_against_all_pairs(spark):
    rng = random.Random(1)
    rows = list(vectors(rng, 700, 9, 3))
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    want = plain(rows, 10)
    assert want and got(hard_negatives.mine(df, 10)) == want
    # Anchors in several blocks give the same.
    assert got(hard_negatives.mine(df, 10, block=13)) == want


def test_ties_repeated_rows_and_odd_components(spark):
    rng = random.Random(2)
    rows = list(vectors(rng, 60, 3, 2, [0, 100, 200, 5, 7, None, -100]))
    rows += rows[:12]
    # Whole ties, also between rows of one id, and a large group of one vector.
    rows += [(i, [1.0, 0.0, 0.5], i % 2, "x", "x", "x", "x") for i in range(40)]
    nan, inf = float("nan"), float("inf")
    rows += [(100, None, 1), (100, [1.0, None, 1.0], 1), (100, [nan, 1.0, 1.0], 1), (300, [1.0, inf, 0.0], 0), (300, [1.0, -inf, 0.0], 0), (300, [1.0, 1.0, 1.0], None)]
    rows += [(400, [], 1), (400, [2.0], 0), (401, [1.0, 1.0, 1.0, 7.5], 1), (None, [0.5, 0.5, 0.5], 0)]
    rows = [(*r, *[None] * (7 - len(r))) for r in rows]
    df = spark.createDataFrame(rows, KINDS).repartition(4)
    assert got(hard_negatives.mine(df)) == plain(rows)


def test_no_rows_and_no_anchors(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0], i % 2, None, None, None, None) for i in range(1, 9)], KINDS)
    for rows in (df, df.filter("vec_id > 50")):
        out = hard_negatives.mine(rows)
        assert out.count() == 0
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_relabelling(spark):
    rng = random.Random(3)
    rows = list(vectors(rng, 200, 5, 10))
    df = spark.createDataFrame(rows, KINDS)
    label = hard_negatives.F.expr("IF(id % 7 = 0, (label + 1) % 10, label)")
    moved = [(i, v, (y + 1) % 10 if i % 7 == 0 else y, *x) for i, v, y, *x in rows]
    assert got(hard_negatives.mine(df, relabel=label)) == plain(moved)


@pytest.mark.parametrize("size, width", [(100, 4), (100_000, 8)])
def test_packed_products_are_exact(size, width):
    rng = np.random.default_rng(4)
    for n, dims in ((1, 1), (3, 64), (1000, 17)):
        v = rng.integers(-size, size + 1, (n, dims))
        anchor = rng.integers(-size, size + 1, dims)
        assert hard_negatives.field_width(size, dims) == width
        packed = hard_negatives.Packed(v, width)
        assert (packed.scores(anchor.tolist()) == v @ anchor).all()
    # The extremes of a field.
    v = np.array([[size] * 8, [-size] * 8, [0] * 8])
    assert hard_negatives.Packed(v, width).scores([-size] * 8).tolist() == [-8 * size * size, 8 * size * size, 0]


def test_scores_beyond_a_long_are_refused(spark):
    df = spark.createDataFrame([(100, [1e30, 1.0], 1, None, None, None, None)], KINDS)
    with pytest.raises(ValueError, match="long"):
        hard_negatives.mine(df)
