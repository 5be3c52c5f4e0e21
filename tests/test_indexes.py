from __future__ import annotations

import random
import uuid

import pytest
from conftest import square
from pyspark.sql import functions as F

from terracell.operators import attributes
from terracell.operators.attributes import areal_weights
from terracell.operators.overlay import line_length_in_polygons, match_polygons, tile_polygons
from terracell.plans.registry import compute
from terracell.sources import indexes
from terracell.sources.layers import Layers


@pytest.fixture()
def shuffled(spark):
    """Joins that move both sides unless one lies in place."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def moved(df, columns):
    """Exchanges on the columns, and scans of bucketed tables, in the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].split("\n")
    keys = ", ".join(columns)
    import re

    plain = [re.sub(r"#\d+L?", "", x) for x in plan]
    return sum(f"Exchange hashpartitioning({keys}," in x for x in plain), sum("Bucketed: true" in x for x in plain)


def name():
    return f"t_{uuid.uuid4().hex}"


def zones(spark):
    return spark.createDataFrame([e for i in range(5) for j in range(5) for e in square(100.0 * i, 100.0 * j, 100.0, sigungu_cd=f"{i}{j}")])


def test_stored_tiles_give_the_same_and_stay_in_place(spark, shuffled, tmp_path):
    rng = random.Random(1)
    points = spark.createDataFrame([(i, rng.uniform(-20, 520), rng.uniform(-20, 520)) for i in range(400)], "id int, x double, y double")
    tiles = tile_polygons(zones(spark), ["sigungu_cd"])
    kept = indexes.store_tiles(tiles, table := name(), buckets=8, path=str(tmp_path))
    again = indexes.load_tiles(spark, table)
    assert (again.key, again.size, again.edges) == (tiles.key, tiles.size, tiles.edges) and kept.rows.count() == tiles.rows.count()
    got = match_polygons(points, again)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, match_polygons(points, tiles).collect()))
    # Only the points are dealt by cell; the tiles are read in their buckets.
    assert moved(got, ["cx", "cy"]) == (1, 1)
    segs = spark.createDataFrame([(0.0, 5.0, 450.0, 333.0)], "x1 double, y1 double, x2 double, y2 double")
    lengths = [{r[0]: round(r[1], 6) for r in line_length_in_polygons(segs, t).collect()} for t in (tiles, again)]
    assert lengths[0] == lengths[1]
    with pytest.raises(ValueError, match="holds no tiles"):
        indexes.load_tiles(spark, f"{table}_edges")


def test_border_variables_take_stored_tiles(spark, tmp_path):
    edges = zones(spark)
    rail = spark.createDataFrame([(1, 2010, 10.0, 10.0, 490.0, 350.0)], "fid int, year int, x1 double, y1 double, x2 double, y2 double")
    lay = Layers.from_frames({"border_edge": edges, "rail_seg": rail}, timeless=["border_edge"])
    kept = indexes.store_tiles(tile_polygons(edges, ["sigungu_cd"]), name(), path=str(tmp_path))
    one, two = (compute(lay, "border_rail", year=2010, **t).collect() for t in ({}, {"tiles": kept}))
    assert {r[0]: pytest.approx(r[1]) for r in one} == {r[0]: r[1] for r in two} and len(one) == 25
    with pytest.raises(ValueError, match="The tiles have key"):
        compute(Layers.from_frames({"border_edge_emd": edges.withColumnRenamed("sigungu_cd", "adm_dr_cd"), "rail_seg": rail}, timeless=["border_edge_emd"]), "border_rail", year=2010, border_type="emd", tiles=kept)
    with pytest.raises(ValueError, match="Invalid option 'tiles'"):
        compute(lay, "border_car_registration", year=2010, tiles=kept)


def test_stored_overlaps_stay_in_place(spark, shuffled, tmp_path, monkeypatch):
    monkeypatch.setattr(attributes, "BROADCAST_ROWS", 10)
    rows = [(f"c{i % 40}", f"b{i % 23}", 1.0 + i, 100.0 + i % 23) for i in range(500)]
    overlaps = spark.createDataFrame(rows, "center_reg_cd string, border_reg_cd string, area double, zone_area double")
    census = spark.createDataFrame([(f"b{i}", 10 * i) for i in range(20)], "border_reg_cd string, pop long")
    kept = indexes.store_overlaps(overlaps, name(), buckets=8, path=str(tmp_path / "o"))
    one, two = (areal_weights(o, census, {"pop": "p"}, "center_reg_cd", "border_reg_cd") for o in (overlaps, kept))
    assert {r[0]: pytest.approx(r[1]) for r in one.collect()} == {r[0]: r[1] for r in two.collect()}
    joined = kept.join(census, "border_reg_cd").groupBy("center_reg_cd").agg(F.sum("pop"))
    assert moved(joined, ["border_reg_cd"]) == (1, 1)
