from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from terracell import grid
from terracell.grid import Density, cell_join, cover_steps, disc_cover, level_sizes, measure_density, pyramid, with_cell


def test_hot_cells_are_split_without_changing_the_join(spark):
    rng = random.Random(1)
    # A third of the left rows and half of the right rows sit in one cell.
    left = spark.createDataFrame([(i, 0 if i % 3 == 0 else rng.randrange(40), 0) for i in range(900)], "l int, cx long, cy long")
    right = spark.createDataFrame([(i, 0 if i % 2 else rng.randrange(40), 0) for i in range(300)], "r int, cx long, cy long")
    plain = left.join(right, ["cx", "cy"])
    for peaks in ({"left_peak": 300}, {"right_peak": 150}, {"left_peak": 300, "right_peak": 150}):
        split = cell_join(left, right, hot_rows=20, **peaks)
        assert split.count() == plain.count()
        assert split.select("l", "r").exceptAll(plain.select("l", "r")).count() == 0


def test_density_counts_rows_cells_and_peak(spark):
    df = spark.createDataFrame([(5.0, 5.0)] * 7 + [(15.0, 5.0), (25.0, 5.0)], "x double, y double")
    assert measure_density(10, a=df)["a"] == Density(9, 3, 7)
    empty = df.filter("x < 0")
    assert measure_density(10, a=df, b=empty) == {"a": Density(9, 3, 7), "b": Density()}


@pytest.mark.parametrize("steps", [0, 1, 3])
def test_disc_cover_holds_every_point_once(spark, steps):
    """A point of the disc lies in exactly one cell of the cover, covered cells lie inside the disc."""
    units = spark.createDataFrame([(1, 12.3, -7.7)], "u int, x double, y double")
    rng = random.Random(2)
    r = 10.0
    pts = []
    while len(pts) < 400:
        dx, dy = rng.uniform(-r, r), rng.uniform(-r, r)
        pts.append((12.3 + dx, -7.7 + dy, math.hypot(dx, dy) <= r))
    cells = [row.asDict() for row in disc_cover(units, r, steps).collect()]
    for px, py, inside in pts:
        found = []
        for c in cells:
            size = r / 2 ** (c["lvl"] + 1)
            if (math.floor((px - grid.GRID_X0) / size), math.floor((py - grid.GRID_Y0) / size)) == (c["cx"], c["cy"]):
                found.append(c)
        if inside:
            assert len(found) == 1
        assert not any(c["covered"] for c in found) or inside


def test_pyramid_totals_add_up_on_every_level(spark):
    pts = spark.createDataFrame([(float(i % 37), float(i % 23), 1) for i in range(500)], "x double, y double, n int")
    levels = pyramid(with_cell(pts, 1.0), 3, ["n"], [])
    totals = {r["lvl"]: r["t"] for r in levels.groupBy("lvl").agg(F.sum("n").alias("t")).collect()}
    assert totals == {0: 500, 1: 500, 2: 500, 3: 500}


def test_steps_grow_with_the_fullest_cell():
    assert cover_steps(Density(100, 10, 512)) == 0
    steps = [cover_steps(Density(0, 0, 10**k)) for k in range(3, 9)]
    assert steps == sorted(steps) and steps[0] >= 1 and steps[-1] <= 6


def test_level_sizes_end_with_a_few_cells():
    sizes = level_sizes(10, 100_000)
    assert sizes[0] == 10 and all(b == 4 * a for a, b in zip(sizes, sizes[1:])) and 100_000 / sizes[-1] <= 4
    assert level_sizes(10, 20) == [10]
