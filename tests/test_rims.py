from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracell import grid
from terracell.operators import counting, rims
from terracell.operators.buffers import buffer_areas, buffer_holds, buffer_lines, buffer_overlaps, buffer_points


def layer(lines: int, units: int, seed: int = 2) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    x, y = rng.integers(0, 1200, (2, lines)).astype(float)
    ends = [x, y, x + rng.integers(-300, 300, lines), y + rng.integers(-300, 300, lines)]
    # Along a side of a zone, along the axes, and no line at all.
    for i, (dx, dy) in enumerate([(rims.NY[3], -rims.NX[3]), (-rims.NY[20], rims.NX[20]), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)] * 5):
        ends[2][i], ends[3][i] = ends[0][i] + 200 * dx, ends[1][i] + 200 * dy
    ux, uy = rng.integers(-200, 1400, (2, units)).astype(float)
    ux[-1] = 2000.0
    return ends, rng.integers(0, 4, lines).astype(float), ux, uy


@pytest.mark.parametrize("part", [12, 40])
def test_lengths_by_sides_match_those_by_pieces(part, monkeypatch):
    """Few and many pieces and pairs at once, weights of nought, units far off."""
    ends, weight, ux, uy = layer(700, 120)
    want, pieces = counting.LineGrid(ends, [weight], 300.0).sums(ux, uy, 300.0, "poly32")
    got, rows = rims.gon_lengths(ends, weight, ux, uy, 300.0, 300.0 / part)
    assert got == pytest.approx(want, rel=1e-12, abs=1e-7)
    assert ((rows > 0) == (pieces > 0)).all() and (rows == 0).any()
    for name, value in (("HELD", 60), ("MET", 50), ("CHUNK", 70)):
        monkeypatch.setattr(rims, name, value)
    again, _ = rims.gon_lengths(ends, weight, ux, uy, 300.0, 300.0 / part)
    assert again == pytest.approx(want, rel=1e-12, abs=1e-7)


def test_many_lines_are_not_tested_one_by_one(monkeypatch):
    """Tests of pieces grew with units times lines; nearly all zones now share what a piece costs."""
    tested = []
    real = counting.shares
    monkeypatch.setattr(counting, "shares", lambda *a: tested.append(len(a[0])) or real(*a))
    ends, weight, ux, uy = layer(30_000, 400)
    length = float(np.hypot(ends[2] - ends[0], ends[3] - ends[1]).sum())
    assert rims.rim_size(400, 20, length / 1500, 1200, 1200, 300.0) is None
    assert rims.rim_size(20_000, 30_000, length, 1200, 1200, 300.0) is not None
    rims.gon_lengths(ends, weight, ux, uy, 300.0, 25.0)
    assert sum(tested) < 1_000


def test_zones_wider_than_tiles_do_not_repeat_features(spark, monkeypatch):
    """A zone that holds most of a layer made features go to every block of units; now each goes to one tile."""
    units = spark.range(60).selectExpr("cast(id as string) AS tot_reg_cd", "id * 37e0 % 1009 AS x", "id * 53e0 % 997 AS y")
    points = spark.range(400).selectExpr("id", "id * 71e0 % 1013 AS x", "id * 97e0 % 991 AS y")
    dealt = []
    real = grid.Tiles._grouped
    monkeypatch.setattr(grid.Tiles, "_grouped", lambda self, df: dealt.append(df) or real(self, df))
    lines = points.selectExpr("id AS fid", "x AS x1", "y AS y1", "x + id % 9 AS x2", "y + 3 AS y2")
    corners = [(0, 0), (5, 0), (0, 5), (0, 0)]
    sides = ", ".join(f"named_struct('x1', x + {p}, 'y1', y + {q}, 'x2', x + {a}, 'y2', y + {b})" for (p, q), (a, b) in zip(corners, corners[1:]))
    ring = points.selectExpr("id AS fid", "cast(id % 3 as int) AS code", f"inline(array({sides}))")
    full = {r["tot_reg_cd"]: r["n"] for r in buffer_points(units, points, 700, {"n": F.lit(1)}, steps=2).collect()}
    assert {r[0]: r["n"] for r in buffer_points(units, points, 700, {"n": F.lit(1)}).collect()} == full
    assert dealt[-1].count() == 400
    held = {r[0]: r["n"] for r in buffer_holds(units, lines, 700, {"n": F.lit(1)}, steps=0).collect()}
    assert {r[0]: r["n"] for r in buffer_holds(units, lines, 700, {"n": F.lit(1)}).collect()} == held
    assert dealt[-1].count() == 400
    areas = [{(r[0], r["code"]): r["area"] for r in buffer_areas(units, ring, ["code"], 90, steps=s, shape="disc").collect()} for s in (None, 1)]
    assert areas[0] == pytest.approx({k: v for k, v in areas[1].items() if k in areas[0]}, abs=1e-6)
    assert not any(abs(v) > 1e-6 for k, v in areas[1].items() if k not in areas[0])
    assert "FlatMapCoGroupsInArrow" in buffer_areas(units, ring, ["code"], 90, shape="disc")._jdf.queryExecution().toString()


@pytest.mark.parametrize("held,few", [(6_000_000, 2000), (40, 7)])
def test_tiles_parted_and_sliced_match_brute_force(spark, held, few, monkeypatch):
    monkeypatch.setattr(grid, "HELD_ROWS", held)
    monkeypatch.setattr(grid, "PART_UNITS", few)
    ends, weight, ux, uy = layer(300, 80, 5)
    want, _ = counting.LineGrid(ends, [weight], 150.0).sums(ux, uy, 150.0, "poly32")
    units = spark.createDataFrame([(str(i), float(a), float(b)) for i, (a, b) in enumerate(zip(ux, uy))], "tot_reg_cd string, x double, y double")
    lines = spark.createDataFrame([tuple(map(float, r)) for r in zip(*ends, weight)], "x1 double, y1 double, x2 double, y2 double, w double")
    got = {r[0]: r["w"] for r in buffer_lines(units, lines, 150, {"w": F.col("w")}).collect()}
    assert [got.get(str(i), 0.0) for i in range(80)] == pytest.approx(list(want), abs=1e-6)
    # Without any feature there are no tiles.
    assert buffer_lines(units, lines.filter("w > 99"), 150, {"w": F.col("w")}).count() == 0


def test_common_areas_are_measured_once(spark):
    """Pairs were found in two branches, and measured for a filter and for the result."""
    units = spark.range(40).selectExpr("cast(id as string) AS tot_reg_cd", "id * 37e0 % 199 AS x", "id * 53e0 % 197 AS y")
    plan = buffer_overlaps(units, 60)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("MapInArrow") == 1


def test_common_areas_clip_no_sides(monkeypatch):
    """Every pair of 32-gons clipped 32 sides; now their area follows from where their outlines cross."""
    rng = np.random.default_rng(6)
    dx, dy = rng.uniform(-620, 620, (2, 4000))
    turns = np.arange(64) * np.pi / 32 + 1e-5
    # Along and beside corners and sides, from next to nothing to next to no overlap, and at one spot.
    for d in (0.01, 1.0, 58.0, 300.0, 590.0, 597.0, 599.0, 599.9999):
        dx, dy = np.concatenate((dx, d * np.cos(turns))), np.concatenate((dy, d * np.sin(turns)))
    dx, dy = np.append(dx, 0.0), np.append(dy, 0.0)
    want, r = np.zeros(len(dx)), 300.0
    for k in range(32):
        (ax, ay), (bx, by) = ((r * np.cos(a * np.pi / 16), r * np.sin(a * np.pi / 16)) for a in (k, k + 1))
        cross = (ax - dx / 2) * (by - dy / 2) - (bx - dx / 2) * (ay - dy / 2)
        want += counting.shares(ax - dx, ay - dy, bx - dx, by - dy, r, "poly32") * cross
    want[-1] = 16 * np.sin(np.pi / 16) * r * r
    monkeypatch.setattr(counting, "shares", None)
    monkeypatch.setattr(counting, "spans", None)
    assert counting.gon_overlaps(dx, dy, r) == pytest.approx(want, abs=1e-4)
    assert np.abs(counting.gon_overlaps(dx, dy, r) - want)[:4000].max() < 1e-7
