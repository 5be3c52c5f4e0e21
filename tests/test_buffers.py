from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import ring, square
from pyspark.sql import functions as F

from terracell import grid
from terracell.functions.geometry import APOTHEM, in_poly32
from terracell.operators import counting
from terracell.operators.buffers import (
    buffer_areas,
    buffer_holds,
    buffer_lines,
    buffer_overlaps,
    buffer_pairs,
    buffer_points,
    buffer_points_nested,
    buffers,
)

GON = 16 * math.sin(math.pi / 16)  # area of the 32-gon of radius 1


def gon(dx, dy, r):
    turn = math.atan2(dy, dx) % (math.pi / 16) - math.pi / 32
    return math.hypot(dx, dy) * math.cos(turn) < r * APOTHEM


def units_of(spark, n=25, seed=3, spread=1000):
    rng = random.Random(seed)
    return [(f"u{i}", rng.uniform(0, spread), rng.uniform(0, spread)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "tot_reg_cd string, x double, y double")


def test_rim_of_the_two_shapes(spark):
    r = 100.0
    middle = math.pi / 32
    pts = spark.createDataFrame(
        [(r, 0.0), (r - 1e-6, 0.0), ((r - 0.2) * math.cos(middle), (r - 0.2) * math.sin(middle)), (r * APOTHEM * 0.999, 0.0)],
        "dx double, dy double",
    )
    got = [row[0] for row in pts.select(in_poly32(F.col("dx"), F.col("dy"), r)).collect()]
    # On a corner: outside (strict); just within it: inside; between polygon and disc: outside.
    assert got == [False, True, False, True]
    unit = frame(spark, [("a", 0.0, 0.0)])
    rim = spark.createDataFrame([(100.0, 0.0)], "x double, y double")
    assert buffer_points(unit, rim, r, {"n": F.lit(1)}, shape="disc").first()["n"] == 1
    assert buffer_points(unit, rim, r, {"n": F.lit(1)}).count() == 0


@pytest.mark.parametrize("steps", [0, 2, None])
@pytest.mark.parametrize("hot", [1_000_000, 10])
def test_points_match_brute_force_with_a_third_in_one_spot(spark, steps, hot, monkeypatch):
    monkeypatch.setattr(grid, "HOT_ROWS", hot)
    rng = random.Random(4)
    pts = [(rng.uniform(0, 1000), rng.uniform(0, 1000), rng.randrange(5)) for _ in range(600)]
    pts += [(500.0 + rng.uniform(-5, 5), 500.0 + rng.uniform(-5, 5), 1) for _ in range(200)] + [(510.0, 490.0, 2)] * 100
    us = units_of(spark) + [(f"h{i}", 500.0 + i, 480.0) for i in range(15)]
    df = spark.createDataFrame(pts, "x double, y double, v int")
    got = {
        r["tot_reg_cd"]: (r["n"], r["v"])
        for r in buffer_points(frame(spark, us), df, 150, {"n": F.lit(1), "v": F.col("v")}, steps=steps).collect()
    }
    for u, x, y in us:
        inside = [v for px, py, v in pts if gon(px - x, py - y, 150)]
        assert got.get(u, (0, 0)) == (len(inside), sum(inside))


def clipped(ax, ay, bx, by, r):
    """Length of a segment in the 32-gon around the origin."""
    t0, t1 = 0.0, 1.0
    for k in range(32):
        nx, ny = math.cos((k + 0.5) * math.pi / 16), math.sin((k + 0.5) * math.pi / 16)
        rate, room = nx * (bx - ax) + ny * (by - ay), r * APOTHEM - nx * ax - ny * ay
        if rate > 0:
            t1 = min(t1, room / rate)
        elif rate < 0:
            t0 = max(t0, room / rate)
        elif room <= 0:
            return 0.0
    return max(0.0, t1 - t0) * math.hypot(bx - ax, by - ay)


@pytest.mark.parametrize("steps", [0, 2])
def test_line_lengths_match_brute_force(spark, steps):
    rng = random.Random(5)
    segs = []
    for i in range(150):
        x, y = rng.uniform(0, 1000), rng.uniform(0, 1000)
        segs.append((i, x, y, x + rng.uniform(-300, 300), y + rng.uniform(-300, 300), 1.0 + i % 3))
    segs += [(900, 500.0, 400.0, 500.0, 600.0, 1.0), (901, 400.0, 500.0, 600.0, 500.0, 1.0), (902, 1.0, 1.0, 1.0, 1.0, 1.0)]
    us = units_of(spark) + [("c", 500.0, 500.0)]
    df = spark.createDataFrame(segs, "fid int, x1 double, y1 double, x2 double, y2 double, w double")
    got = {r[0]: r["l"] for r in buffer_lines(frame(spark, us), df, 120, {"l": F.col("w")}, steps=steps).collect()}
    for u, x, y in us:
        want = sum(w * clipped(a - x, b - y, c - x, d - y, 120) for _, a, b, c, d, w in segs)
        assert got.get(u, 0.0) == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("steps", [0, 2])
def test_polygon_areas(spark, steps):
    unit = frame(spark, [("a", 500.0, 500.0)])
    r = 100.0
    edges = (
        square(0, 0, 1000, fid=1, code=1)  # covers the buffer
        + square(500, 500, 400, fid=2, code=2)  # one quarter
        + square(490, 490, 20, fid=3, code=3)  # wholly inside
        + square(490, 490, 20, fid=4, code=3)  # the same again counts again
        + square(5000, 5000, 10, fid=5, code=4)  # nowhere near
        + square(0, 0, 1000, fid=6, code=5) + ring([(400, 400), (400, 600), (600, 600), (600, 400)], fid=6, code=5)  # hole
    )
    got = {x["code"]: x["area"] for x in buffer_areas(unit, spark.createDataFrame(edges), ["code"], r, steps=steps).collect()}
    full = GON * r * r
    assert got[1] == pytest.approx(full)
    assert got[2] == pytest.approx(full / 4)
    assert got[3] == pytest.approx(800.0)
    assert abs(got.get(4, 0.0)) < 1e-6 and abs(got.get(5, 0.0)) < 1e-6


@pytest.mark.parametrize("steps", [0, 1, 3])
def test_features_wholly_inside(spark, steps):
    rng = random.Random(6)
    segs = []
    for i in range(200):
        x, y, s = rng.uniform(0, 1000), rng.uniform(0, 1000), rng.choice([4, 15, 90])
        corners = [(x, y), (x + s, y + s / 3), (x + s / 2, y + s)] if i % 2 else [(x, y), (x + s, y - s)]
        part = ring(corners, fid=i) if i % 2 else ring(corners, fid=i)[:1]
        segs += [{**e, "v": i} for e in part]
    us = units_of(spark)
    df = spark.createDataFrame(segs)
    got = {
        r[0]: (r["n"], r["v"])
        for r in buffer_holds(frame(spark, us), df, 150, {"n": F.lit(1), "v": F.col("v")}, steps=steps).collect()
    }
    for u, x, y in us:
        held = [
            i for i in range(200)
            if all(gon(e["x1"] - x, e["y1"] - y, 150) and gon(e["x2"] - x, e["y2"] - y, 150) for e in segs if e["fid"] == i)
        ]
        assert got.get(u, (0, 0)) == (len(held), sum(held))


def test_overlaps_of_buffers(spark):
    us = frame(spark, [("a", 0.0, 0.0), ("b", 100.0, 0.0), ("c", 0.0, 0.0), ("d", 1000.0, 0.0)])
    got = {(r["tot_reg_cd"], r["other"]): r["area"] for r in buffer_overlaps(us, 100).collect()}
    full = GON * 1e4
    assert got["a", "a"] == pytest.approx(full) and got["a", "c"] == pytest.approx(full)
    assert got["a", "b"] == pytest.approx(got["b", "a"])
    # Lens of two discs, a little larger than that of the polygons within them.
    lens = 2 * 1e4 * math.acos(0.5) - 50 * math.sqrt(4e4 - 1e4)
    assert 0.98 * lens < got["a", "b"] < lens
    assert ("a", "d") not in got


def test_ring_and_radii(spark):
    unit = frame(spark, [("a", 0.0, 0.0)])
    pts = spark.createDataFrame([(i, float(i), 0.0) for i in range(0, 200)], "id int, x double, y double")
    pairs = buffer_pairs(unit, pts, 130, hole=100)
    assert sorted(r["id"] for r in pairs.collect()) == list(range(100, 130))
    assert [r["r"] for r in buffers(unit, [100, 300]).collect()] == [100.0, 300.0]


@pytest.mark.parametrize("steps", [0, 1, 4])
@pytest.mark.parametrize("shape", ["poly32", "disc"])
def test_nested_zones_match_brute_force(spark, steps, shape):
    """Radii far apart and close together, points in several conditions, some outside all zones."""
    rng = random.Random(steps)
    units = units_of(spark, 15, spread=3000)
    points = [(rng.uniform(-500, 3500), rng.uniform(-500, 3500), rng.random() < 0.4) for _ in range(400)]
    points += [(x, y, True) for _, x, y in units]
    radii = [700.0, 40.0, 710.0, 1500.0]
    df = spark.createDataFrame(points, "x double, y double, old boolean")
    measures = {"n": F.lit(1), "old": F.when(F.col("old"), 1).otherwise(0)}
    got = buffer_points_nested(frame(spark, units), df, radii, measures, shape=shape, steps=steps).collect()
    inside = gon if shape == "poly32" else (lambda dx, dy, r: dx * dx + dy * dy <= r * r)
    want = {u: [[sum(w for px, py, o in points for w in [f(o)] if inside(px - x, py - y, r)) for r in radii] for f in (lambda o: 1, int)] for u, x, y in units}
    assert {r["tot_reg_cd"]: [[v or 0 for v in r["n"]], [v or 0 for v in r["old"]]] for r in got} == {u: w for u, w in want.items() if w[0][3]}


def disc_area(corners, r):
    """Area that a polygon and the disc around the origin share: triangles inside, sectors outside, edge by edge."""
    total = 0.0
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):
        dx, dy = bx - ax, by - ay
        qa, qb, qc = dx * dx + dy * dy, ax * dx + ay * dy, ax * ax + ay * ay - r * r
        root = qb * qb - qa * qc
        t0, t1 = (max(0.0, min(1.0, (-qb + k * math.sqrt(root)) / qa)) for k in (-1, 1)) if root > 0 else (0.0, 0.0)
        for a, b in ((0.0, t0), (t1, 1.0)):
            px, py, qx, qy = ax + a * dx, ay + a * dy, ax + b * dx, ay + b * dy
            total += r * r / 2 * math.atan2(px * qy - py * qx, px * qx + py * qy)
        total += (t1 - t0) * (ax * by - ay * bx) / 2
    return total


@pytest.mark.parametrize("steps", [None, 0, 3])
def test_areas_of_true_discs(spark, steps):
    """Polygons around, inside, across and off the circles, with a hole, against the kernel over all edges."""
    r, rng = 100.0, random.Random(8)
    star = [((60 + 70 * (k % 2)) * math.cos(k * 0.45) + 140, (60 + 70 * (k % 2)) * math.sin(k * 0.45) + 120) for k in range(13)]
    shapes = {
        "all": [(-1000, -1000), (2000, -1000), (2000, 2000), (-1000, 2000)], "half": [(100, -1000), (2000, -1000), (2000, 2000), (100, 2000)],
        "small": [(95, 95), (105, 95), (105, 105), (95, 105)], "star": star, "strip": [(-500, 90), (700, 90), (700, 91), (-500, 91)],
    }
    rows = [e for k, v in shapes.items() for e in ring([(float(x), float(y)) for x, y in v], code=k)]
    hole = [(80.0, 80.0), (80.0, 150.0), (150.0, 150.0), (150.0, 80.0)]
    rows += ring([(0.0, 0.0), (200.0, 0.0), (200.0, 200.0), (0.0, 200.0)], code="holed") + ring(hole, code="holed")
    units = [("u", 100.0, 100.0), ("v", 100.0, 350.0)] + [(f"w{i}", rng.uniform(0, 250), rng.uniform(0, 250)) for i in range(12)]
    got = buffer_areas(frame(spark, units), spark.createDataFrame(rows), ["code"], r, steps=steps, shape="disc").collect()
    got = {(g["tot_reg_cd"], g["code"]): g["area"] for g in got}
    shapes["holed"] = [(0, 0), (200, 0), (200, 200), (0, 200)]
    for u, x, y in units:
        for code, corners in shapes.items():
            want = disc_area([(a - x, b - y) for a, b in corners], r)
            if code == "holed":
                want += disc_area([(a - x, b - y) for a, b in hole], r)
            assert got.get((u, code), 0.0) == pytest.approx(want, abs=1e-6), (u, code)
        assert got[u, "all"] == pytest.approx(math.pi * r * r)


def test_lenses_of_discs(spark):
    us = frame(spark, [("a", 0.0, 0.0), ("b", 100.0, 0.0), ("c", 0.0, 0.0), ("d", 200.0, 0.0)])
    got = {(r["tot_reg_cd"], r["other"]): r["area"] for r in buffer_overlaps(us, 100, shape="disc").collect()}
    assert got["a", "b"] == got["b", "a"] == pytest.approx(2 * 1e4 * math.acos(0.5) - 50 * math.sqrt(4e4 - 1e4))
    assert got["a", "c"] == got["a", "a"] == pytest.approx(math.pi * 1e4) and ("a", "d") not in got


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_of_zones_are_neither_broadcast_nor_shuffled(spark):
    """Spark takes exploded cells for as small as the units and would send them through the driver."""
    units = spark.range(300).selectExpr("cast(id as string) AS tot_reg_cd", "id * 37e0 % 1009 AS x", "id * 53e0 % 997 AS y")
    points = spark.range(3000).selectExpr("id * 71e0 % 1013 AS x", "id * 97e0 % 991 AS y")
    plans = [
        _plan(buffer_points(units, points, 100, {"n": F.lit(1)}, steps=2)),
        _plan(buffer_points_nested(units, points, [50, 100], {"n": F.lit(1)}, steps=2)),
        _plan(buffer_pairs(units, points, 100)),
        _plan(buffer_overlaps(units, 30)),
    ]
    for plan in plans:
        assert "BroadcastExchange" not in plan and "SortMergeJoin" not in plan


def test_parted_blocks_and_crowded_layers_count_the_same(spark, monkeypatch):
    units = spark.range(400).selectExpr("cast(id as string) AS tot_reg_cd", "id * 37e0 % 1009 AS x", "id * 53e0 % 997 AS y")
    points = spark.range(2000).selectExpr("id", "id * 71e0 % 1013 AS x", "id * 97e0 % 991 AS y")
    near = F.hypot(points.x - units.x, points.y - units.y) <= 90
    want = {r["tot_reg_cd"]: r["n"] for r in units.crossJoin(points.withColumnRenamed("id", "pid")).filter(near).groupBy("tot_reg_cd").agg(F.count("pid").alias("n")).collect()}

    def found():
        rows = buffer_points(units, points, 90, {"n": F.lit(1)}, shape="disc", steps=2).collect()
        pairs = buffer_pairs(units, points, 90, shape="disc").groupBy("tot_reg_cd").count().collect()
        assert {r["tot_reg_cd"]: r["count"] for r in pairs} == want
        return {r["tot_reg_cd"]: r["n"] for r in rows}

    monkeypatch.setattr(grid, "PART_UNITS", 3)
    assert found() == want
    monkeypatch.setattr(grid, "HELD_ROWS", 1)
    assert found() == want


@pytest.mark.parametrize("shape", ["poly32", "disc"])
def test_counting_by_blocks_agrees_with_covers(spark, shape, monkeypatch):
    monkeypatch.setattr(grid, "PART_UNITS", 20)
    units = spark.range(150).selectExpr("cast(id as string) AS tot_reg_cd", "id * 37e0 % 1009 AS x", "id * 53e0 % 997 AS y")
    points = spark.range(6000).selectExpr("id * 71e0 % 1013 AS x", "id * 97e0 % 991 AS y", "CASE WHEN id % 3 = 0 THEN id END AS v")
    measures = {"n": F.lit(1), "v": F.col("v")}
    counted = buffer_points_nested(units, points, [150, 40, 3], measures, shape=shape)
    covered = buffer_points_nested(units, points, [150, 40, 3], measures, shape=shape, steps=2)
    assert "FlatMapCoGroupsInArrow" in _plan(counted)

    def told(df):
        return {r[0]: (r["n"], r["v"]) for r in df.selectExpr("tot_reg_cd", "transform(n, e -> coalesce(e, 0)) AS n", "v").collect()}

    assert told(counted) == told(covered)
    one = {r[0]: (r[1], r[2]) for r in buffer_points(units, points, 40, measures, shape=shape).collect()}
    assert one == {r[0]: (r[1], r[2]) for r in buffer_points(units, points, 40, measures, shape=shape, steps=1).collect()}


def test_lines_measured_by_blocks_agree_with_covers(spark, monkeypatch):
    monkeypatch.setattr(grid, "PART_UNITS", 20)
    units = spark.range(120).selectExpr("cast(id as string) AS tot_reg_cd", "id * 37e0 % 1009 AS x", "id * 53e0 % 997 AS y")
    # Short and long lines, level and upright ones, one without length, one without a weight, one whose weight is not finite.
    lines = spark.range(800).selectExpr(
        "id * 71e0 % 1013 AS x1", "id * 97e0 % 991 AS y1", "id * 71e0 % 1013 + id * 31 % 400 * (id % 3 - 1) AS x2", "id * 97e0 % 991 + id * 17 % 300 * (id % 4 - 1) AS y2",
        "CASE WHEN id = 5 THEN double('NaN') WHEN id % 10 > 0 THEN id % 7 + 0.5e0 END AS w",
    )
    for shape in ("poly32", "disc"):
        for chosen in (lines, lines.filter("NOT isnan(w)")):
            got, want = (
                {r[0]: r[1] for r in buffer_lines(units, chosen, 150, {"w": F.col("w")}, shape=shape, steps=steps).collect()} for steps in (None, 2)
            )
            want = {k: v or 0.0 for k, v in want.items()}
            assert {k: got.get(k, 0.0) for k in want} == pytest.approx(want, rel=1e-12, abs=1e-7, nan_ok=True)
    assert "FlatMapCoGroupsInArrow" in _plan(buffer_lines(units, lines, 150, {"w": F.col("w")}))


def test_overlapping_buffers_stay_one_row_a_pair(spark):
    units = spark.range(40).selectExpr("cast(id as string) AS tot_reg_cd", "id * 37e0 % 199 AS x", "id * 53e0 % 197 AS y")
    found = buffer_overlaps(units, 60)
    plan = _plan(found)
    # No side of a buffer becomes a row, nothing is grouped by pairs.
    assert "ArrowEvalPython" in plan and "Aggregate" not in plan
    area = {(r[0], r["other"]): r["area"] for r in found.collect()}
    assert all(a == pytest.approx(area[v, u], rel=1e-9) for (u, v), a in area.items())
    assert len(area) > 40 and all(area[str(i), str(i)] == pytest.approx(GON * 3600) for i in range(40))


def test_pairs_join_no_cells_of_zones(spark):
    """Cells of zones were shuffled to meet the points; now units and points move once, and what lies far from all units not at all."""
    units = spark.range(300).selectExpr("cast(id as string) AS tot_reg_cd", "id * 37e0 % 1009 AS x", "id * 53e0 % 997 AS y")
    points = spark.range(3000).selectExpr("id", "id * 71e0 % 1013 AS x", "id * 97e0 % 991 + if(id % 3 = 0, 1e6, 0e0) AS y")
    for found in (buffer_pairs(units, points, 100), buffer_pairs(units, points, 100, hole=80, keep=["id"]), buffer_overlaps(units, 30, shape="disc")):
        plan = _plan(found)
        assert "MapInArrow" in plan and "Join" not in plan
    blocks = grid.Blocks(units, 100, 100, grid.Density(300, 100, 10))
    dealt = blocks.deal(points, F.col("x"), F.col("y"), F.lit(0.0))
    assert dealt.filter("y >= 1e6").isEmpty() and dealt.select("id").distinct().count() == 2000


@pytest.mark.parametrize("hole", [0.0, 80.0])
@pytest.mark.parametrize("shape", ["poly32", "disc"])
def test_pairs_of_a_block_match_brute_force(shape, hole, monkeypatch):
    """Chunks smaller than what a unit or a grid row finds, points on one spot and at the edge of the grid."""
    rng = np.random.default_rng(3)
    x, y = np.concatenate((rng.uniform(0, 500, 900), np.full(60, 500.0))), np.concatenate((rng.uniform(0, 400, 900), np.full(60, 400.0)))
    ux, uy = rng.uniform(-120, 620, 50), rng.uniform(-120, 520, 50)
    ux[:3], uy[:3] = x[:3], y[:3]
    dx, dy = (x[None] - ux[:, None]).ravel(), (y[None] - uy[:, None]).ravel()
    held = counting.in_zone(dx, dy, 100.0, shape)
    if hole:
        held &= ~counting.in_zone(dx, dy, hole, shape)
    pairs = counting.PairGrid(x, y, [np.arange(len(x))], 100.0)
    for chunk in (7, 100_000):
        monkeypatch.setattr(counting, "CHUNK", chunk)
        found = [np.stack(p, 1) for p in pairs.pairs(ux, uy, 100.0, shape, hole)]
        assert max(len(f) for f in found) <= chunk
        assert sorted(map(tuple, np.concatenate(found))) == list(zip(*np.nonzero(held.reshape(len(ux), len(x)))))


def test_pairs_keep_rows_without_a_place_out(spark):
    units = spark.createDataFrame([("a", 0.0, 0.0), ("b", None, 0.0), ("c", float("nan"), 0.0)], "tot_reg_cd string, x double, y double")
    points = spark.createDataFrame([(1, 0, 1, None), (2, None, 1, "n"), (3, 2, 2, "v")], "id int, x int, y int, v string")
    got = sorted(tuple(r) for r in buffer_pairs(units, points, 10).collect())
    assert got == [("a", 0.0, 0.0, 1, 0, 1, None), ("a", 0.0, 0.0, 3, 2, 2, "v")]
