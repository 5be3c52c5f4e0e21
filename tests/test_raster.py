from __future__ import annotations

import math
import random
import statistics

import pytest
from conftest import ring, square

from terracell.operators.overlay import tile_polygons
from terracell.operators.raster import RasterGrid, add_rasters, buffer_tile_mean, mosaic, ring_shares, sample, zonal_statistics
from terracell.operators.raster import _blocks_of, cells_in_polygons, row_intervals, zonal_sums

GRID = RasterGrid(0.0, 0.0, 10.0)


def cells(spark, n=30, hole=None):
    rows = [(c, r, None if (c, r) == hole else float(c + 100 * r)) for c in range(n) for r in range(n)]
    return spark.createDataFrame(rows, "col int, row int, val double")


def test_sample_drops_or_keeps_units_off_the_raster(spark):
    us = spark.createDataFrame([("a", 15.0, 25.0), ("n", 35.0, 5.0), ("off", -5.0, 5.0)], "tot_reg_cd string, x double, y double")
    raster = cells(spark, hole=(3, 0))
    assert {r[0]: r["val"] for r in sample(us, raster, GRID).collect()} == {"a": 201.0, "n": None}
    assert {r[0]: r["val"] for r in sample(us, raster, GRID, outer=True).collect()} == {"a": 201.0, "n": None, "off": None}


def test_zonal_statistics_skip_nodata_and_empty_zones(spark):
    zones = spark.createDataFrame(square(0, 0, 20, zone="z") + square(1000, 1000, 5, zone="away") + square(290, 290, 100, zone="partly"))
    got = {r["zone"]: r for r in zonal_statistics(cells(spark, hole=(1, 1)), tile_polygons(zones, ["zone"]), GRID, {"val": "dem"}).collect()}
    values = [0.0, 1.0, 100.0]
    assert set(got) == {"z", "partly"}
    assert (got["z"]["dem_count"], got["z"]["dem_sum"], got["z"]["dem_min"], got["z"]["dem_max"]) == (3, 101.0, 0.0, 100.0)
    assert got["z"]["dem_std"] == pytest.approx(statistics.pstdev(values))
    assert got["partly"]["dem_count"] == 1


def test_mean_of_tile_means_differs_from_mean_of_cells(spark):
    # Unit at the meeting of tiles 0 and 1: 100 columns per tile.
    wide = spark.createDataFrame([(c, 0, 1.0 if c < 100 else 4.0) for c in range(97, 106)], "col int, row int, val double")
    us = spark.createDataFrame([("a", 985.0, 5.0)], "tot_reg_cd string, x double, y double")
    assert buffer_tile_mean(us, wide, GRID, 40).first()["mean"] == pytest.approx(2.5)
    inside = [c for c in range(97, 106) if abs(c * 10 + 5 - 985) < 40 * 0.99]
    want = sum(1.0 if c < 100 else 4.0 for c in inside) / len(inside)
    assert buffer_tile_mean(us, wide, GRID, 40, cellwise=True).first()["mean"] == pytest.approx(want)


def test_ring_shares(spark):
    us = spark.createDataFrame([("a", 155.0, 155.0)], "tot_reg_cd string, x double, y double")
    got = ring_shares(us, cells(spark), GRID, 60, width=30.0).first()
    own = 1515.0
    ring = []
    for c in range(30):
        for r in range(30):
            dx, dy = c * 10 + 5 - 155, r * 10 + 5 - 155
            gon = [math.hypot(dx, dy) * math.cos(math.atan2(dy, dx) % (math.pi / 16) - math.pi / 32) < q * math.cos(math.pi / 32) for q in (60, 90)]
            if gon == [False, True]:
                ring.append(c + 100 * r - own)
    assert got["above_20"] == pytest.approx(sum(d > 20 for d in ring) / len(ring))
    assert got["below_50"] == pytest.approx(sum(d < -50 for d in ring) / len(ring))


def test_algebra_needs_every_source(spark):
    rows = [("p", 0, 0, 1.0), ("l", 0, 0, 2.0), ("a", 0, 0, 4.0), ("p", 1, 0, 1.0), ("l", 1, 0, None), ("a", 1, 0, 1.0), ("p", 2, 0, 9.0)]
    df = spark.createDataFrame([(k, "co", c, r, v) for k, c, r, v in rows], "kind string, gas string, col int, row int, val double")
    got = {(r["col"], r["row"]): r["val"] for r in add_rasters(df, "kind", ["p", "l", "a"], ["gas"]).collect()}
    assert got == {(0, 0): 7.0, (1, 0): None}


def test_algebra_counts_sources_not_rows(spark):
    rows = [("p", 0, 1, 1.0), ("p", 0, 2, 5.0), ("l", 0, 1, 2.0), ("a", 0, 1, 4.0), ("p", 1, 1, 1.0), ("p", 1, 2, 1.0), ("l", 1, 1, 2.0), ("p", 2, 1, 1.0), ("p", 2, 2, None),
            ("l", 2, 1, 2.0), ("a", 2, 1, 3.0)]
    df = spark.createDataFrame([(k, "co", c, 0, i, v) for k, c, i, v in rows], "kind string, gas string, col int, row int, rid int, val double")
    got = {r["col"]: r["val"] for r in add_rasters(df, "kind", ["p", "l", "a"], ["gas"], order="rid").collect()}
    assert got == {0: 11.0, 2: 6.0}


def test_mosaic_keeps_the_last(spark):
    df = spark.createDataFrame([(0, 0, 1.0, 1), (0, 0, 5.0, 2), (1, 0, 3.0, 1), (2, 0, 4.0, 1), (2, 0, None, 2), (3, 0, None, 1)], "col int, row int, val double, tile int")
    assert {(r["col"], r["val"]) for r in mosaic(df, "tile").collect()} == {(0, 5.0), (1, 3.0), (2, 4.0), (3, None)}
    assert {(r["col"], r["val"]) for r in mosaic(df, None).collect()} == {(0, 5.0), (1, 3.0), (2, 4.0), (3, None)}


def zones_of(spark):
    """Concave, holed, overlapping, sliver and shared-edge zones; some off the raster."""
    letter = [(0, 0), (100, 0), (100, 30), (40, 30), (40, 70), (100, 70), (100, 100), (0, 100)]
    star = [((40 + 90 * (k % 2)) * math.cos(k * 0.45) + 150, (40 + 90 * (k % 2)) * math.sin(k * 0.45) + 140) for k in range(13)]
    rows = ring([(float(x), float(y)) for x, y in letter], zone="c") + ring(star, zone="star")
    rows += square(120, 120, 100, zone="holed") + ring([(140.0, 140.0), (140.0, 190.0), (190.0, 190.0), (190.0, 140.0)], zone="holed")
    rows += square(5, 5, 10, zone="on centres") + square(201, 0, 3, zone="sliver") + square(-50, 250, 100, zone="partly") + square(900, 900, 50, zone="off")
    return spark.createDataFrame(rows)


def test_row_intervals_hold_the_cells_in_polygons(spark):
    tiles, raster = tile_polygons(zones_of(spark), ["zone"]), cells(spark)
    want = {(r["zone"], r["col"], r["row"]) for r in cells_in_polygons(raster, tiles, GRID).collect()}
    found = row_intervals(tiles, GRID).collect()
    got = {(r["zone"], c, r["row"]) for r in found for c in range(r["lo"], r["hi"] + 1)}
    assert {g for g in got if 0 <= g[1] < 30 and 0 <= g[2] < 30} == want
    # Rows of candidates follow the raster rows that a zone meets, not its cells.
    assert len(found) < len(want) / 4


def test_intervals_as_blocks(spark):
    rng = random.Random(3)
    ends = [(lo, lo + rng.choice([0, 1, 14, 15, 16, 40, 300, 5000, 20_000])) for lo in [-40, -16, -1, 0, 1, 15, 16, 255, 4095, *rng.choices(range(-9000, 9000), k=40)]]
    df = spark.createDataFrame([(i, *e) for i, e in enumerate(ends)], "row int, lo int, hi int")
    found = {}
    for r in _blocks_of(df).collect():
        found.setdefault(r["row"], []).append(range(r["idx"] * 16 ** r["lvl"], (r["idx"] + 1) * 16 ** r["lvl"]))
    for i, (lo, hi) in enumerate(ends):
        assert sorted(c for b in found[i] for c in b) == list(range(lo, hi + 1))
        assert len(found[i]) <= 90 + (hi - lo) // 4096


def test_zonal_statistics_by_blocks(spark):
    """All six statistics against the cells themselves; large values that hardly differ keep their deviation."""
    rng = random.Random(5)
    values = [(c, r, None if rng.random() < 0.1 else 1e6 + rng.random()) for c in range(30) for r in range(30) if rng.random() < 0.9]
    raster = spark.createDataFrame(values, "col int, row int, val double")
    tiles = tile_polygons(zones_of(spark), ["zone"])
    held = {}
    for r in cells_in_polygons(raster, tiles, GRID).join(raster, ["col", "row"]).collect():
        held.setdefault(r["zone"], []).append(r["val"])
    got = {r["zone"]: r for r in zonal_statistics(raster, tiles, GRID, {"val": "v"}).collect()}
    assert set(got) == set(held)
    for zone, cells_ in held.items():
        there = [v for v in cells_ if v is not None]
        assert got[zone]["v_count"] == len(there)
        if there:
            assert (got[zone]["v_min"], got[zone]["v_max"]) == (min(there), max(there))
            assert got[zone]["v_mean"] == pytest.approx(statistics.fmean(there)) and got[zone]["v_std"] == pytest.approx(statistics.pstdev(there), abs=2e-2)
    sums = {r["zone"]: r["val"] for r in zonal_sums(raster, tiles, GRID, ["val"]).collect()}
    assert sums == {z: pytest.approx(sum(v for v in c if v is not None)) if any(v is not None for v in c) else None for z, c in held.items()}
