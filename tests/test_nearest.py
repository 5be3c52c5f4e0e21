from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import square

from terracell import grid
from terracell.operators import counting
from terracell.operators import nearest as nearest_module
from terracell.operators.nearest import distance_to_all, distance_to_union, nearest


def frame(spark, rows):
    return spark.createDataFrame(rows, "tot_reg_cd string, x double, y double")


@pytest.mark.parametrize("hot", [1_000_000, 20])
def test_points_match_brute_force_when_crowded(spark, hot, monkeypatch):
    """Features: a crowded spot, a thin rest and one far away; units near, far and on an island."""
    monkeypatch.setattr(grid, "HOT_ROWS", hot)
    rng = random.Random(9)
    pts = [(f"p{i}", rng.gauss(500, 3), rng.gauss(500, 3)) for i in range(300)]
    pts += [(f"q{i}", rng.uniform(0, 20_000), rng.uniform(0, 20_000)) for i in range(300)] + [("z", -40_000.0, 10.0)]
    us = [(f"u{i}", rng.uniform(0, 20_000), rng.uniform(0, 20_000)) for i in range(80)]
    us += [(f"v{i}", rng.gauss(500, 5), rng.gauss(500, 5)) for i in range(60)] + [("w", 90_000.0, -70_000.0), ("y", -39_000.0, 0.0)]
    layer = spark.createDataFrame(pts, "name string, x double, y double")
    got = {r["tot_reg_cd"]: r for r in nearest(frame(spark, us), layer, carry=["name"]).collect()}
    for u, x, y in us:
        d, name = min((math.hypot(px - x, py - y), n) for n, px, py in pts)
        assert got[u]["distance"] == pytest.approx(d) and got[u]["name"] == name


def test_lines_match_brute_force(spark):
    rng = random.Random(10)
    segs = []
    for i in range(200):
        x, y = rng.uniform(0, 5000), rng.uniform(0, 5000)
        segs.append((x, y, x + rng.uniform(-900, 900), y + rng.uniform(-900, 900)))
    us = [(f"u{i}", rng.uniform(-1000, 6000), rng.uniform(-1000, 6000)) for i in range(100)]
    got = {r[0]: r[1] for r in nearest(frame(spark, us), spark.createDataFrame(segs, "x1 double, y1 double, x2 double, y2 double")).collect()}

    def distance(x, y, s):
        x1, y1, x2, y2 = s
        dx, dy = x2 - x1, y2 - y1
        t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
        return math.hypot(x - x1 - t * dx, y - y1 - t * dy)

    for u, x, y in us:
        assert got[u] == pytest.approx(min(distance(x, y, s) for s in segs))


def test_ties_go_to_the_first_name(spark):
    layer = spark.createDataFrame([("b", 10.0, 0.0), ("a", -10.0, 0.0), ("c", 0.0, 10.0)], "name string, x double, y double")
    assert nearest(frame(spark, [("u", 0.0, 0.0)]), layer, carry=["name"]).first()["name"] == "a"


def test_inside_a_polygon_the_distance_is_zero(spark):
    layer = spark.createDataFrame(square(0, 0, 100, fid=1) + square(300, 0, 100, fid=2))
    us = frame(spark, [("in", 50.0, 50.0), ("out", 150.0, 50.0), ("far", 0.0, -70.0)])
    got = {r[0]: r[1] for r in nearest(us, layer, areal=True).collect()}
    assert got == {"in": 0.0, "out": 50.0, "far": 70.0}


def test_a_crowded_spot_is_told_apart(spark, monkeypatch):
    """All but one of the points lie within two metres: the grid gets fine there, and few candidates are measured."""
    spot = spark.range(20_000).selectExpr("rand(3) * 2 AS x", "rand(4) * 2 AS y").union(spark.createDataFrame([(200_000.0, 0.0)], "x double, y double"))
    spot = spark.createDataFrame(spot.collect(), "x double, y double")
    seen = []
    join = nearest_module.cell_join

    def counted(left, right, *args, **more):
        out = join(left, right, *args, **more)
        seen.append(out)
        return out

    monkeypatch.setattr(nearest_module, "cell_join", counted)
    us = [(f"u{i}", 0.03 * i, 2 - 0.03 * i) for i in range(60)]
    got = {r[0]: r[1] for r in nearest(frame(spark, us), spot).collect()}
    points = [(r.x, r.y) for r in spot.collect()]
    for u, x, y in us:
        assert got[u] == pytest.approx(min(math.hypot(px - x, py - y) for px, py in points))
    assert seen[-1].count() < 60 * 64 * 16


def test_empty_layer(spark):
    empty = spark.createDataFrame([], "name string, x double, y double")
    us = frame(spark, [("u", 0.0, 0.0)])
    assert nearest(us, empty, carry=["name"]).count() == 0
    assert distance_to_union(us, empty, "tot_reg_cd").first()["distance"] is None


def test_long_features_are_narrowed_down_one_by_one(spark):
    """Ten coasts of 10,000 edges each: a unit measures a bounded number of edges of each, and none is missed."""
    coast = spark.range(100_000).selectExpr(
        "cast(id % 10 AS int) AS fid", "cast(floor(id/10) AS double)*7 AS x1", "(id % 10)*3000 + sin(floor(id/10)*0.01)*900 AS y1",
        "cast(floor(id/10)+1 AS double)*7 AS x2", "(id % 10)*3000 + sin((floor(id/10)+1)*0.01)*900 AS y2",
    )
    rng = random.Random(2)
    us = [(f"u{i}", rng.uniform(-3000, 73_000), rng.uniform(-9000, 36_000)) for i in range(12)]
    units = frame(spark, us)
    got = {(r["tot_reg_cd"], r["fid"]): r["distance"] for r in distance_to_all(units, coast, "tot_reg_cd", "fid").collect()}
    rows = coast.collect()

    def apart(x, y, r):
        dx, dy = r.x2 - r.x1, r.y2 - r.y1
        t = max(0.0, min(1.0, ((x - r.x1) * dx + (y - r.y1) * dy) / (dx * dx + dy * dy)))
        return math.hypot(x - r.x1 - t * dx, y - r.y1 - t * dy)

    for u, x, y in us[:4]:
        for f in range(10):
            assert got[u, f] == pytest.approx(min(apart(x, y, r) for r in rows if r.fid == f))
    assert len(got) == 120
    tried = nearest_module._pairs_to_all(units, coast, "tot_reg_cd", "fid").groupBy("tot_reg_cd", "fid").count()
    assert tried.agg({"count": "max"}).first()[0] < 2500 and tried.agg({"count": "avg"}).first()[0] < 700


def test_no_feature_gives_no_row(spark):
    empty = spark.createDataFrame([], "fid int, x1 double, y1 double, x2 double, y2 double")
    assert distance_to_all(frame(spark, [("u", 0.0, 0.0)]), empty, "tot_reg_cd", "fid").count() == 0


def test_one_row_per_feature(spark):
    layer = spark.createDataFrame([(1, 0, 0.0, 3.0, 5.0, 3.0), (1, 1, 0.0, 2.0, 5.0, 2.0), (2, 0, 7.0, 0.0, 8.0, 0.0)],
                                  "fid int, seg int, x1 double, y1 double, x2 double, y2 double")
    got = distance_to_all(frame(spark, [("u", 0.0, 0.0)]), layer, "tot_reg_cd", "fid")
    assert {r["fid"]: r["distance"] for r in got.collect()} == {1: 2.0, 2: 7.0}


def brute(x, y, segs):
    def squared(s):
        x1, y1, x2, y2 = s
        dx, dy = x2 - x1, y2 - y1
        t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / ((dx * dx + dy * dy) or 1.0)))
        return (x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2

    return math.sqrt(min(squared(s) for s in segs))


@pytest.mark.parametrize("pieces", [2_000_000, 300])
def test_grids_of_a_block_find_the_nearest_edge(pieces, monkeypatch):
    """Crowded and thin places, edges without length, level and upright ones, units among them and far off."""
    monkeypatch.setattr(counting, "PIECES", pieces)
    rng = random.Random(21)
    segs = [(x, y, x + rng.uniform(-400, 400), y + rng.uniform(-400, 400)) for x, y in [(rng.uniform(0, 3000), rng.uniform(0, 3000)) for _ in range(150)]]
    segs += [(x, y, x, y) for x, y in [(rng.gauss(700, 4), rng.gauss(700, 4)) for _ in range(150)]]
    segs += [(10.0, 20.0, 900.0, 20.0), (50.0, -30.0, 50.0, 2000.0), (-9000.0, 40.0, -9000.0, 41.0)]
    units = [(rng.uniform(-200, 3200), rng.uniform(-200, 3200)) for _ in range(120)] + [(rng.gauss(700, 5), rng.gauss(700, 5)) for _ in range(60)]
    units += [(50_000.0, -70_000.0), (-8999.0, 0.0), (50.0, 100.0), (-1000.0, 20.0)]
    ends = [np.array(c) for c in zip(*segs)]
    got = np.sqrt(counting.least_distances(ends, *[np.array(c) for c in zip(*units)]))
    assert got == pytest.approx([brute(x, y, segs) for x, y in units], abs=1e-7)
    assert np.isinf(counting.least_distances([np.zeros(0)] * 4, np.zeros(2), np.zeros(2))).all()


def test_lines_are_not_cut_finer_for_blocks_to_meet_them(spark, monkeypatch):
    """Blocks of a layer, slices of their edges and parts of their units agree with brute force; units far from all edges too."""
    for name, value in (("BLOCK_EDGES", 100), ("BLOCK_AIM", 10), ("HELD_EDGES", 20), ("HELD_UNITS", 3)):
        monkeypatch.setattr(nearest_module, name, value)
    rng = random.Random(22)
    segs = [(x, y, x + rng.uniform(-900, 900), y + rng.uniform(-900, 900)) for x, y in [(rng.uniform(0, 5000), rng.uniform(0, 5000)) for _ in range(400)]]
    us = [(f"u{i}", rng.uniform(-800, 5800), rng.uniform(-800, 5800)) for i in range(150)] + [("far", 90_000.0, 3.0), ("none", None, 1.0)]
    layer = spark.createDataFrame([*segs, (None, 1.0, 2.0, 3.0)], "x1 double, y1 double, x2 double, y2 double")
    monkeypatch.setattr(nearest_module, "_finest", counted(nearest_module._finest, asked := []))
    got = {r[0]: r[1] for r in nearest(frame(spark, us), layer).collect()}
    assert got == pytest.approx({u: brute(x, y, segs) for u, x, y in us if x is not None})
    assert len(asked) == 1
    # Without a unit far off nothing goes by the cells that cut all lines.
    near_ = [u for u in us[:150] if max(abs(u[1] - 2500), abs(u[2] - 2500)) < 2500]
    assert nearest(frame(spark, near_), layer).count() == len(near_) and len(asked) == 1


def counted(run, calls):
    def call(*args):
        calls.append(args)
        return run(*args)

    return call
