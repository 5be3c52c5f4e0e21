"""Polygon areas in buffers, measured block by block."""

from __future__ import annotations

import math
import random

import pytest
from conftest import ring

from terracell.operators import counting
from terracell.operators.buffers import buffer_areas


@pytest.mark.parametrize("wide", [40, 700])
def test_areas_by_blocks_are_those_of_the_cover(spark, wide):
    rng, edges = random.Random(wide), []
    for _ in range(60):
        x, y, turn = rng.uniform(0, 1500), rng.uniform(0, 1500), rng.uniform(0, 1)
        corners = [(x + wide * k * math.cos(a + turn), y + wide * k * math.sin(a + turn)) for a, k in ((0, 1), (1, 0.6), (2.2, 1), (3.5, 0.4), (5, 0.9))]
        edges += ring(corners, code=rng.choice([1, 2, 3, None]))
    rows = [(f"u{i}", rng.uniform(-300, 1800), rng.uniform(-300, 1800)) for i in range(80)]
    units = spark.createDataFrame([*rows, ("none", None, 1.0)], "tot_reg_cd string, x double, y double")
    layer = spark.createDataFrame(edges, "code int, seg int, x1 double, y1 double, x2 double, y2 double")
    got, want = (
        {(r["tot_reg_cd"], r["code"]): r["area"] for r in buffer_areas(units, layer.filter("code IS NOT NULL"), ["code"], 300, steps=steps).collect()}
        for steps in (None, 0)
    )
    assert any(v > 1 for v in want.values())
    for key in {*got, *want}:
        assert got.get(key, 0.0) == pytest.approx(want.get(key, 0.0), abs=1e-4)


def test_areas_are_planned_by_blocks(spark):
    layer = spark.createDataFrame(ring([(0, 0), (900, 0), (900, 900), (0, 900)], code=1))
    units = spark.createDataFrame([("a", 450.0, 450.0), ("b", 0.0, 0.0), ("c", 3000.0, 0.0)], "tot_reg_cd string, x double, y double")
    found = buffer_areas(units, layer, ["code"], 100)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    full = 16 * math.sin(math.pi / 16) * 1e4
    assert {r[0]: r["area"] for r in found.collect()} == pytest.approx({"a": full, "b": full / 4})


def test_a_round_of_the_outline_sweeps_the_whole(spark):
    x, y = counting.gon_start(10.0)
    assert counting.in_zone(*(counting.np.array([v * 0.999999]) for v in (x, y)), 10.0, "poly32")[0]
    assert not counting.in_zone(*(counting.np.array([v * 1.000001]) for v in (x, y)), 10.0, "poly32")[0]
