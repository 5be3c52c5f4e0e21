from __future__ import annotations

import math

import random

import pytest
from pyspark.sql import functions as F

from terracell.functions.facilities import open_by_year_prefix, open_in_year
from terracell.functions.projection import to_metric
from terracell.operators.attributes import areal_weights, lookup_join, merge_by_id, negative_values, number_in_order
from terracell.operators.measures import invalid_rings
from terracell.operators import attributes
from terracell.operators.quantiles import column_quantiles, exact_quantiles, quantile_level
from terracell.sources.layers import Layers, read_layer
from terracell.sources.points import detect_xy, points_from_list, read_points_csv, validate_xy
from terracell.sources.rasters import drop_states, load_report, read_raster, with_raster_meta, write_raster
from terracell.sources.sinks import preview, write_result, write_sorted, write_table


def test_detect_xy():
    assert detect_xy(["id", "LON", "Latitude"]) == ("LON", "Latitude")
    with pytest.raises(ValueError, match="No coordinate column"):
        detect_xy(["id", "east", "north"])


def test_csv_rows_are_numbered_across_blocks_and_bad_ones_rejected(spark, tmp_path):
    rows = [f"{i},{'oops' if i % 100 == 7 else 127 + i / 1e5},37.1,extra" for i in range(1, 3001)]
    path = tmp_path / "points.csv"
    path.write_text("id,lng,lat,more\n" + "\n".join(rows) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        points = read_points_csv(spark, str(path))
        assert spark.read.option("header", True).csv(str(path)).rdd.getNumPartitions() > 1
        assert points.filter(F.col("row_no") != F.col("id").cast("long")).count() == 0
        good, rejects = validate_xy(points)
        assert good.count() == 2970 and dict(good.dtypes)["x"] == "double"
        assert [r["row_no"] for r in rejects.orderBy("row_no").collect()] == list(range(7, 3000, 100))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_inline_points_keep_their_order(spark):
    got = points_from_list(spark, [[127.0, 37.0], [128.0, 36.0]]).collect()
    assert [(r["point_id"], r["x"], r["y"]) for r in got] == [(1, 127.0, 37.0), (2, 128.0, 36.0)]


def test_projection(spark):
    df = spark.createDataFrame([(127.5, 38.0), (127.0, 37.5), (126.0, 33.5)], "x double, y double")
    got = [(r["x"], r["y"]) for r in to_metric(df).collect()]
    assert got[0] == pytest.approx((1_000_000, 2_000_000), abs=1e-6)
    # Meridian scale 0.9996 and known ground distances bound the others; the next test settles them.
    assert got[1][0] == pytest.approx(1_000_000 - 0.9996 * 44_196, rel=1e-4)
    assert to_metric(df, 5179) is df
    with pytest.raises(ValueError, match="Unsupported SRID 3857"):
        to_metric(df, 3857)


def test_projection_is_conformal_and_true_along_its_meridian(spark):
    """These two properties alone define the projection: northings of the central meridian are its scaled arc
    length on the ellipsoid (here by numerical integration), and small circles stay circles everywhere."""
    a, f, k0 = 6378137.0, 1 / 298.257222101, 0.9996
    e2 = f * (2 - f)

    def arc(lat1, lat2, n=20_000):
        h = math.radians(lat2 - lat1) / n
        curve = [a * (1 - e2) / (1 - e2 * math.sin(math.radians(lat1) + i * h) ** 2) ** 1.5 for i in range(n + 1)]
        return h / 3 * (curve[0] + curve[-1] + 4 * sum(curve[1:-1:2]) + 2 * sum(curve[2:-1:2]))

    lats = [33.0, 35.5, 37.0, 38.0, 38.6]
    d = 1e-5
    spots = [(lon, lat) for lon in (124.6, 126.0, 127.0, 129.5, 131.8) for lat in (33.2, 36.0, 38.5)]
    rows = [(127.5, lat) for lat in lats] + [(x + i * d, y + j * d) for x, y in spots for i, j in ((1, 0), (-1, 0), (0, 1), (0, -1))]
    got = [(r["x"], r["y"]) for r in to_metric(spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "i int, x double, y double").coalesce(1)).orderBy("i").collect()]
    for (x, y), lat in zip(got, lats):
        assert x == pytest.approx(1_000_000, abs=1e-6) and y == pytest.approx(2_000_000 + k0 * arc(38.0, lat), abs=1e-3)
    for n, (_, lat) in enumerate(spots):
        (ax, ay), (bx, by), (cx, cy), (ex, ey) = got[len(lats) + 4 * n : len(lats) + 4 * n + 4]
        w = 1 - e2 * math.sin(math.radians(lat)) ** 2
        along = a / math.sqrt(w) * math.cos(math.radians(lat)) * 2 * math.radians(d)
        up = a * (1 - e2) / w**1.5 * 2 * math.radians(d)
        east, north = ((ax - bx) / along, (ay - by) / along), ((cx - ex) / up, (cy - ey) / up)
        assert north[0] == pytest.approx(-east[1], abs=2e-7) and north[1] == pytest.approx(east[0], abs=2e-7)


def test_lifetime_rules(spark):
    rows = [
        (1, "2001-05-05", None, 1), (2, "2010-12-31", None, 1), (3, "2011-01-01", None, 1), (4, "2001-01-01", "2009-12-31", 1),
        (5, "2001-01-01", "2010-01-01", 1), (6, "2001-01-01", None, 0),
    ]
    df = spark.createDataFrame(rows, "id int, date string, date_c string, operation int")
    assert {r["id"] for r in df.filter(open_in_year(2010)).collect()} == {1, 2, 5}
    assert {r["id"] for r in df.filter(open_by_year_prefix(2010)).collect()} == {1, 2, 5, 6}


def test_raster_file_names(spark):
    names = {
        "/d/2001_emission/emission.p.co.tif": (2001, "point", "co"),
        "/d/2005_emission/emission.a.2001_nh3.tif": (2005, "area", "nh3"),
        "/d/2010_emission/emission.l.2001_pm10_v2.x.tif": (2010, "line", "pm10"),
        "/d/2010_emission/emission.l.voc.old.tif": (2010, "line", "voc"),
        "/d/2010_emission/emission.x.voc.tif": (2010, "unknown", "unknown"),
        "/d/other/emission.l.voc.tif": (None, "line", "voc"),
    }
    df = with_raster_meta(spark.createDataFrame([(n,) for n in names], "path string"))
    assert {r["path"]: (r["year"], r["emission_type"], r["pollutant_type"]) for r in df.collect()} == names
    stored = df.filter(~F.col("path").contains("2005"))
    more = with_raster_meta(spark.createDataFrame([("/d/2010_emission/readme.txt",), ("/d/2010_emission/emission.p.co.tif",)], "path string"))
    report = load_report(df.union(more), stored.select("path"))
    assert {r["year"]: (r["loaded"], r["failed"]) for r in report.collect()} == {2001: (1, 0), 2005: (0, 1), 2010: (3, 1)}


def test_reloading_a_file_replaces_it(spark, tmp_path):
    path = str(tmp_path / "raster")
    schema = "filename string, col int, row int, val double, year int, emission_type string, pollutant_type string"
    first = [("a", 0, 0, 1.0, 2001, "point", "co"), ("b", 1, 0, 2.0, 2001, "point", "co"), ("c", 0, 0, 3.0, 2005, "area", "nox")]
    with pytest.raises(ValueError, match="does not exist"):
        write_raster(spark, spark.createDataFrame(first, schema), path)
    assert write_raster(spark, spark.createDataFrame(first, schema), path, first=True) == 1
    with pytest.raises(ValueError, match="exists"):
        write_raster(spark, spark.createDataFrame(first, schema), path, first=True)
    held = read_raster(spark, path)
    for _ in range(2):
        write_raster(spark, spark.createDataFrame([("a", 0, 0, 10.0, 2001, "point", "co")], schema), path)
        got = {(r["filename"], r["val"]) for r in read_raster(spark, path).collect()}
        assert got == {("a", 10.0), ("b", 2.0), ("c", 3.0)}
    # Who began before a reload ends as they began; earlier states can be read too.
    before = {("a", 1.0), ("b", 2.0), ("c", 3.0)}
    assert {(r["filename"], r["val"]) for r in held.collect()} == before
    assert {(r["filename"], r["val"]) for r in read_raster(spark, path, 1).collect()} == before
    assert dict(read_raster(spark, path).dtypes)["year"] == "int"
    assert len(drop_states(spark, path, keep=1)) == 1
    assert {(r["filename"], r["val"]) for r in read_raster(spark, path).collect()} == got
    with pytest.raises(ValueError, match="No state 1 in the raster store. Its states are: 3"):
        read_raster(spark, path, 1)


def test_a_load_that_dies_leaves_the_store_as_it_was(spark, tmp_path):
    """One partition is written, the other fails."""
    path = str(tmp_path / "raster")
    schema = "filename string, col int, row int, val double, year int, emission_type string, pollutant_type string"
    first = [("a", 0, 0, 1.0, 2001, "point", "co"), ("c", 0, 0, 3.0, 2005, "area", "nox")]
    write_raster(spark, spark.createDataFrame(first, schema), path, first=True)
    new = spark.createDataFrame([("a", 0, 0, 10.0, 2001, "point", "co"), ("c", 0, 0, 30.0, 2005, "area", "nox")], schema).repartition(2, "year")
    broken = new.withColumn("val", F.when(F.col("year") == 2005, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("val")))
    with pytest.raises(Exception, match="lost"):
        write_raster(spark, broken, path)
    assert {(r["filename"], r["val"]) for r in read_raster(spark, path).collect()} == {("a", 1.0), ("c", 3.0)}
    # A manifest that was not finished does not count either.
    (tmp_path / "raster" / "manifest" / "00000009").mkdir()
    assert read_raster(spark, path).count() == 2 and write_raster(spark, new, path) == 2
    assert {r["val"] for r in read_raster(spark, path).collect()} == {10.0, 30.0}


def test_layers_by_year_and_version(spark, tmp_path):
    df = spark.createDataFrame([(1, 2005), (2, 2010)], "id bigint, year int").withColumns({"x": F.lit(1.0), "y": F.lit(2.0)})
    df.write.partitionBy("year").parquet(str(tmp_path / "bus_stop"))
    layers = Layers.from_folder(spark, str(tmp_path))
    stops = layers.at("bus_stop", 2010)
    assert [r["id"] for r in stops.collect()] == [2]
    assert "PartitionFilters: [isnotnull(year" in stops._jdf.queryExecution().toString()
    versions = spark.createDataFrame([(2020, "v002"), (2020, "v004"), (2015, "v002")], "year int, version string")
    lay = Layers.from_frames({"landuse_edge": versions})
    assert lay.version("landuse_edge", 2020, {2020: "v004"}, "v002").first()["version"] == "v004"
    plain = Layers.from_frames({"landuse_edge": versions.drop("version"), "road_lane": versions.drop("year")})
    with pytest.raises(ValueError, match="'landuse_edge' has no column 'version'"):
        plain.version("landuse_edge", 2020, {}, "v002")
    with pytest.raises(ValueError, match="'road_lane' has no column 'year'"):
        plain.at("road_lane", 2020)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_plain_files_keep_their_stamps(spark, tmp_path, fmt):
    edges = spark.createDataFrame(
        [(f"{y}{v}", y, v, s, 110, 1.0, 2.0, 3.0, 4.0) for y in (2015, 2020) for v in ("v002", "v004") for s in (0, 1)],
        "fid string, year int, version string, seg int, code int, x1 double, y1 double, x2 double, y2 double",
    ).withColumn("fid", F.regexp_replace("fid", "v", "").cast("long"))
    borders = edges.withColumnRenamed("version", "sigungu_cd").drop("fid", "code")
    for name, df in (("landuse_edge", edges), ("border_edge", borders), ("river_edge", edges.drop("year"))):
        df.write.format(fmt).option("header", True).save(str(tmp_path / name))
    lay = Layers.from_folder(spark, str(tmp_path), fmt)
    assert lay.version("landuse_edge", 2020, {2020: "v004"}, "v002").count() == 2
    assert lay.border("sgg", 2015)[0].count() == 4
    with pytest.raises(ValueError, match="river_edge"):
        lay.at("river_edge", 2020)


def test_rows_are_numbered_and_written_in_order(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast((id * 7919) % 1009 as int) AS v", "id % 3 AS g")
    got = number_in_order(df, [F.desc("v")]).collect()
    assert [r["v"] for r in sorted(got, key=lambda r: r["rank"])] == sorted((r["v"] for r in got), reverse=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted(df, str(tmp_path / "o"), ["v"], "csv")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(p for p in (tmp_path / "o").iterdir() if p.name.startswith("part"))
    values = [int(line.split(",")[0]) for p in files for line in p.read_text().splitlines()[1:]]
    assert len(files) > 1 and values == sorted(values) and len(values) == 1000


def test_tables_are_made_and_appended_to(spark, tmp_path):
    name = f"t{tmp_path.name.replace('-', '_')}"
    write_table(spark.range(3), name, path=str(tmp_path / "t"))
    write_table(spark.range(2), name)
    assert spark.table(name).count() == 5 and spark.read.parquet(str(tmp_path / "t")).count() == 5
    with pytest.raises(Exception, match="exists"):
        write_table(spark.range(1), name, append=False)
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize(
    ("corners", "bad"),
    [
        ([(0, 0), (4, 0), (4, 4), (0, 4)], False),
        ([(0, 0), (2, 0), (4, 0), (4, 4), (0, 4)], False),
        ([(0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (2, 2)], True),  # touches itself at a corner
        ([(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)], True),  # a corner on another edge
        ([(0, 0), (4, 0), (4, 4), (6, 4), (4, 4), (0, 4)], True),  # spike and back
        ([(0, 0), (6, 0), (4, 0), (4, 4), (0, 4)], True),  # runs back over its own edge
    ],
)
def test_rings_that_touch_themselves(spark, corners, bad):
    from conftest import ring

    got = invalid_rings(spark.createDataFrame(ring(corners, fid=1)), ["fid"]).collect()
    assert [r["self_crossing"] for r in got] == ([True] if bad else [])
    with pytest.raises(ValueError, match="Unknown format 'xls'"):
        read_layer(spark, "p", "bus_stop", "xls")


def test_sinks(spark, tmp_path):
    df = spark.range(10)
    write_result(df, str(tmp_path / "j"), "json")
    assert spark.read.json(str(tmp_path / "j")).count() == 10
    with pytest.raises(ValueError, match="Unknown format"):
        write_result(df, str(tmp_path / "x"), "xlsx")
    assert preview(df).count() == 5


def test_large_lookup_tables_are_not_broadcast(spark, monkeypatch):
    units = spark.createDataFrame([(i, "k1" if i % 3 else f"k{i % 9}") for i in range(90)], "u int, k string")
    table = spark.createDataFrame([(f"k{i}", i) for i in range(0, 9, 2)] + [("k1", 1)], "k string, v int")
    want_inner, want_left = (sorted(map(tuple, lookup_join(units, table, ["k"], h).select("u", "k", "v").collect()), key=str) for h in ("inner", "left"))
    monkeypatch.setattr(attributes, "BROADCAST_ROWS", 2)
    for how, want in (("inner", want_inner), ("left", want_left)):
        got = lookup_join(units, table, ["k"], how).select("u", "k", "v")
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert len(want_left) == 90 > len(want_inner)


def test_weights_of_a_full_tiling_give_the_whole_total(spark):
    overlaps = spark.createDataFrame([("a", "z1", 30.0, 40.0), ("b", "z1", 10.0, 40.0), ("a", "z2", 5.0, 5.0), ("b", "z9", 1.0, 2.0)],
                                     "unit string, zone string, area double, zone_area double")
    table = spark.createDataFrame([("z1", 100), ("z2", 7)], "zone string, v int")
    got = {r["unit"]: r["total"] for r in areal_weights(overlaps, table, {"v": "total"}, "unit", "zone").collect()}
    assert got == {"a": 82.0, "b": 25.0}


def test_merge(spark):
    frames = [spark.createDataFrame([(i, j) for i in ids], f"id int, c{j} int") for j, ids in enumerate([(1, 2), (2, 3), (4,)])]
    merged = merge_by_id(frames, "id")
    assert merged.columns == ["id", "c0", "c1", "c2"]
    assert {tuple(r) for r in merged.collect()} == {(1, 0, None, None), (2, 0, 1, None), (3, None, 1, None), (4, None, None, 2)}
    with pytest.raises(ValueError, match="No frames"):
        merge_by_id([], "id")


def test_quantiles_are_exact(spark):
    values = [float(v) for v in [1, 1, 1, 1, 2, 3, 5, 8, 13, 21, 34]]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = exact_quantiles(df, "v", [0.2, 0.5, 0.75, 1.0])
    assert got == pytest.approx([1.0, 3.0, 10.5, 34.0])
    levels = df.select("v", quantile_level(df, "v").alias("level")).collect()
    assert {r["level"] for r in levels if r["v"] == 1.0} == {"Very Low"}
    assert {r["level"] for r in levels if r["v"] is None} == {None}


def test_negative_values(spark):
    df = spark.createDataFrame([(1, 5, -2), (2, 0, None)], "id int, a int, b int")
    assert [(r["id"], r["column"], r["value"]) for r in negative_values(df, ["id"], ["a", "b"]).collect()] == [(1, "b", -2.0)]


@pytest.mark.parametrize("accuracy", [50_000, 40])
def test_quantiles_of_many_columns(spark, accuracy, monkeypatch):
    """Also with a sketch so coarse that brackets matter; empty columns, nulls, not-a-numbers and ties."""
    monkeypatch.setattr("terracell.operators.quantiles.ACCURACY", accuracy)
    rng = random.Random(4)
    nan = float("nan")
    rows = [(rng.gauss(0, 1) if i % 7 else None, float(rng.randint(0, 3)), nan if i % 5 else 1.0 * i, None, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, none double, `d x` int").repartition(5)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["column"]: list(r)[1:] for r in column_quantiles(df, ["a", "b", "c", "none", "d x"], shares).collect()}
    assert set(got) == {"a", "b", "c", "d x"}
    for i, c in enumerate(("a", "b", "c", "d x")):
        v = sorted(float(r[i if i < 3 else 4]) for r in rows if r[i if i < 3 else 4] is not None and r[i if i < 3 else 4] == r[i if i < 3 else 4])
        for s, q in zip(shares, got[c]):
            p = (len(v) - 1) * s
            low = v[int(p)]
            assert q == pytest.approx(low + (p - int(p)) * (v[min(int(p) + 1, len(v) - 1)] - low), abs=1e-12)


def test_a_raster_load_is_dealt_over_tasks_by_partition(spark, tmp_path):
    """Cells of one task go to several, so that none sorts the whole load; no cell is lost."""
    from terracell.sources.rasters import read_raster, write_raster

    cells = spark.range(2000).selectExpr(
        "cast(id % 50 AS int) AS col", "cast(id / 50 AS int) AS row", "id * 1.0D AS val", "2019 AS year",
        "concat('t', id % 4) AS emission_type", "concat('p', id % 5) AS pollutant_type", "concat('f', id % 20) AS filename",
    ).coalesce(1)
    path, key = str(tmp_path / "store"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        write_raster(spark, cells, path, first=True)
    finally:
        spark.conf.unset(key)
    tasks = {f.name.split("-")[1] for f in (tmp_path / "store" / "data").rglob("part-*.parquet")}
    assert len(tasks) > 1
    back = read_raster(spark, path).agg({"val": "sum", "col": "count"}).first()
    assert back["sum(val)"] == sum(range(2000)) and back["count(col)"] == 2000
