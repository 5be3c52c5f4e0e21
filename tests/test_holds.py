"""Features wholly inside buffers, counted block by block."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracell import grid
from terracell.functions.geometry import APOTHEM
from terracell.operators import counting
from terracell.operators.buffers import buffer_holds

EDGES = "fid long, x1 double, y1 double, x2 double, y2 double, v long"


def gon(dx, dy, r):
    turn = math.atan2(dy, dx) % (math.pi / 16) - math.pi / 32
    return math.hypot(dx, dy) * math.cos(turn) < r * APOTHEM


def features(n, wide, seed):
    """Lines, rings, open lines, shapes of one spot, and lines that lack a corner."""
    rng, rows = random.Random(seed), []
    for fid in range(n):
        x, y, v = rng.uniform(0, 2000), rng.uniform(0, 2000), rng.choice([None, 1, 2, 3])
        corners = [(x + rng.uniform(0, wide), y + rng.uniform(-wide, wide)) for _ in range(rng.choice([1, 2, 2, 2, 3, 5]))]
        ends = list(zip(corners, corners[1:])) or [(corners[0], corners[0])]
        if len(corners) == 5:
            ends.append((corners[-1], corners[0]))
        rows += [(fid, *a, *b, v) for a, b in ends]
        if fid % 50 == 7:
            rows.append((fid, x, y, None, y, v))
    return rows


def plain(units, rows, r):
    out = {}
    for u, x, y in units:
        held = {}
        for fid, x1, y1, x2, y2, v in rows:
            ok = None not in (x1, y1, x2, y2) and gon(x1 - x, y1 - y, r) and gon(x2 - x, y2 - y, r)
            held[fid] = (held.get(fid, (True, v))[0] and ok, v)
        values = [v for ok, v in held.values() if ok]
        if values:
            known = [v for v in values if v is not None]
            out[u] = (len(values), sum(known) if known else None)
    return out


@pytest.mark.parametrize("wide, held_rows", [(60, None), (400, None), (150, 300)])
def test_held_features_by_blocks(spark, monkeypatch, wide, held_rows):
    if held_rows:
        monkeypatch.setattr(grid, "HELD_ROWS", held_rows)
    rng = random.Random(wide)
    units = [(f"u{i}", rng.uniform(0, 2000), rng.uniform(0, 2000)) for i in range(60)]
    rows = features(600, wide, wide + 1)
    us = spark.createDataFrame([*units, ("none", None, 1.0)], "tot_reg_cd string, x double, y double")
    found = buffer_holds(us, spark.createDataFrame(rows, EDGES), 300, {"n": F.lit(1), "v": F.col("v")})
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    assert {r[0]: (r["n"], r["v"]) for r in found.collect()} == plain(units, rows, 300)


@pytest.mark.parametrize("parts", [1, 4, 12])
def test_classes_of_lines_leave_no_line_out(monkeypatch, parts):
    """Any number of classes gives the sums of the plain test."""
    monkeypatch.setattr(counting, "_fineness", lambda *_: parts)
    rng = np.random.default_rng(parts)
    x, y = rng.uniform(0, 5000, (2, 20_000))
    xs, ys = np.stack((x, x + rng.uniform(-300, 300, 20_000)), 1), np.stack((y, y + rng.uniform(-200, 300, 20_000)), 1)
    value, ux, uy = rng.integers(0, 9, 20_000), *rng.uniform(-200, 5200, (2, 40))
    first, count = np.arange(20_000) * 2, np.full(20_000, 2)
    found = sum(g.sums(ux, uy, 900.0, "poly32")[0] for g in counting._hold_grids(xs.ravel(), ys.ravel(), first, count, [value], 900.0))
    for k in range(40):
        held = [counting.in_zone(xs[:, i] - ux[k], ys[:, i] - uy[k], 900.0, "poly32") for i in (0, 1)]
        assert found[k] == value[held[0] & held[1]].sum()
