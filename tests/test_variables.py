from __future__ import annotations

import os
import sys

import duckdb
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from terracell.operators.raster import RasterGrid
from terracell.plans.points import file_calculator
from terracell.plans.registry import VARIABLES, BufferSize, compute, compute_many, find
from terracell.sources.layers import Layers
from terracell.sources.sinks import write_result
from terracell.streaming.scoring import progress_of, score_csv, score_stream

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from check import rows_of  # noqa: E402
from queries.support import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


# One query of every kind; check.py runs all of them.
SAMPLE = [
    "border_river", "border_emission", "border_landuse_area", "border_airport_distance", "border_mdl_distance", "border_road",
    "border_topographic_model", "border_raster_emission", "border_hospital", "dem_value", "bus_stop_count", "rail_station_distance",
    "river_distance", "car_mean", "population", "emission_vector", "mr1_length_lane_width", "ndvi_median", "relative_dem_5000",
    "landuse", "custom_hospital_count", "read_points_csv", "buffer_buffer_overlap", "polygons_within_borders", "score_arriving_files",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SAMPLE)))
def test_every_other_query_runs(spark, name):
    """Each gives the columns of its oracle; check.py compares the rows."""
    df = entry.queries()[name](spark, SF)
    df.limit(1).collect()
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(f"SELECT * FROM ({entry.oracle_sql()[name]}) q LIMIT 0")
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)


def test_many_counts_share_one_pass(spark, tmp_path):
    """Two years and two radii read the layer once and shuffle it once, and give what single calls give."""
    rows = [(i, f"{1990 + i % 30}-01-01", f"{2003 + i % 17}-06-30" if i % 3 else None, 1, 100.0 * (i % 40), 90.0 * (i % 37)) for i in range(800)]
    spark.createDataFrame(rows, "id long, date string, date_c string, operation int, x double, y double").write.parquet(str(tmp_path / "clinics"))
    units = spark.createDataFrame([(f"110100{i:07d}", 300.0 * i, 250.0 * i) for i in range(12)], "tot_reg_cd string, x double, y double")
    lay = Layers.from_frames({"clinics": spark.read.parquet(str(tmp_path / "clinics")), "centers": units})
    calls = [{"name": "clinic_count", "year": y, "radius": r} for y in (2005, 2015) for r in (500, BufferSize.LARGE)]
    both = compute_many(lay, calls)
    plan = both._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("FileScan parquet") == 1
    # The layer's rows are merged by spot and then placed by cell; nothing else moves them.
    assert initial.count("Exchange hashpartitioning(x#") == 1
    single = {tuple(c.items()): compute(lay, **c) for c in calls}
    rows = {r["tot_reg_cd"]: r for r in both.collect()}
    assert both.columns == ["tot_reg_cd", *(df.columns[1] for df in single.values())]
    for df in single.values():
        assert {r[0]: r[1] for r in df.collect()} == {k: r[df.columns[1]] for k, r in rows.items()}
    with pytest.raises(ValueError, match="asked for twice"):
        compute_many(lay, [calls[0]] * 3)
    with pytest.raises(ValueError, match="Invalid buffer size"):
        compute_many(lay, [calls[0], {**calls[1], "radius": 7}])


def test_every_variable_has_a_query_and_every_query_an_oracle():
    find("bus_stop_count")
    assert len(VARIABLES) == 59
    covered = set(QUERIES)
    assert {v for v in VARIABLES if v not in covered} == {"relative_elevation"}  # four queries of its own
    assert set(ORACLES) == covered <= set(entry.queries())


def test_census_variables_take_census_units(spark):
    units = [(f"u{k}", s, 2023, *e) for k in (0, 1) for s, e in enumerate([(k, 0., k + 1., 0.), (k + 1., 0., k + 1., 1.), (k + 1., 1., k, 1.), (k, 1., k, 0.)])]
    units = spark.createDataFrame([(u, s, y, *[100. * v for v in e]) for u, s, y, *e in units], "tot_reg_cd string, seg int, year int, x1 double, y1 double, x2 double, y2 double")
    centers = spark.createDataFrame([("1101000000001", 100.0, 50.0)], "tot_reg_cd string, x double, y double")
    people = spark.createDataFrame([("u0", 2020, 10, 4, 6), ("u1", 2020, 20, 8, 12)], "tot_reg_cd string, year int, pop int, pop_m int, pop_f int")
    frames = {"border_edge_jgg": units, "centers": centers, "sgis_pop": people}
    got = compute(Layers.from_frames(frames), "population", year=2020, radius=500).first()
    assert (got["POP_0500"], got["POP_M_0500"]) == (pytest.approx(30), pytest.approx(12))
    frames["sgis_pop"] = people.withColumn("tot_reg_cd", F.lit("11010"))
    with pytest.raises(ValueError, match="No row of 'sgis_pop'"):
        compute(Layers.from_frames(frames), "population", year=2020, radius=500)


def test_two_georeferences_give_two_joins(spark):
    cells = [("dem", c, r, 1.0 * c) for c in range(4) for r in range(4)] + [("dsm", c, r, 10.0) for c in range(2) for r in range(2)]
    frames = {"raster_cell": spark.createDataFrame(cells, "layer string, col int, row int, val double")}
    ring = [("z", s, *e) for s, e in enumerate([(0., 0., 40., 0.), (40., 0., 40., 40.), (40., 40., 0., 40.), (0., 40., 0., 0.)])]
    frames["border_edge"] = spark.createDataFrame(ring, "sigungu_cd string, seg int, x1 double, y1 double, x2 double, y2 double")
    lay = Layers.from_frames(frames, timeless=["border_edge"])
    grids = {"dem": RasterGrid(0.0, 0.0, 10.0), "dsm": RasterGrid(0.0, 0.0, 20.0)}
    both = compute(lay, "border_topographic_model", year=2010, grid=grids).first()
    assert (both["dem_count"], both["dem_sum"], both["dsm_count"], both["dsm_sum"]) == (16, 24.0, 4, 40.0)
    one = compute(lay, "border_topographic_model", year=2010, grid=grids["dem"]).first()
    assert (one["dem_count"], one["dsm_count"]) == (16, 4)
    away = lay.get("raster_cell").filter("layer = 'dem' OR col > 9")
    lay = Layers.from_frames({**frames, "raster_cell": away}, timeless=["border_edge"])
    assert compute(lay, "border_topographic_model", year=2010, grid=grids["dem"]).first()["dsm_count"] is None
    with pytest.raises(ValueError, match="georeference of raster 'dem'"):
        compute(lay, "border_topographic_model", year=2010)


def test_arguments_are_checked_before_any_work():
    layers = Layers(lambda name: pytest.fail("touched a layer"))
    with pytest.raises(ValueError, match="Invalid option 'precise'"):
        compute(layers, "landuse", year=2020, radius=500, precise=True)
    with pytest.raises(ValueError, match="Invalid year 1999. Valid years are: 2000, 2005, 2010, 2015, 2020"):
        compute(layers, "border_river", year=1999)
    with pytest.raises(ValueError, match="Invalid buffer size '250'"):
        compute(layers, "bus_stop_count", year=2023, radius=250)
    with pytest.raises(ValueError, match="Invalid border type 'state'"):
        compute(layers, "border_river", year=2000, border_type="state")
    with pytest.raises(ValueError, match="Invalid emission type 'car'. Valid types are: area, line, point"):
        compute(layers, "emission_raster_value", year=2020, radius=3000, emission_type="car", pollutant_type="co")
    with pytest.raises(ValueError, match="Unknown calculator type"):
        compute(layers, "weather")
    with pytest.raises(ValueError, match="Unknown calculator type"):
        file_calculator("school")
    with pytest.raises(ValueError, match="Invalid year 2001"):
        compute(layers, "road_length_lane_width", year=2001, radius=500)


def test_year_2000_reads_2005_and_zero_registrations(spark):
    stations = spark.createDataFrame([(1, 2005, 0.0, 0.0), (2, 2000, 0.0, 0.0), (3, 2005, 5.0, 0.0)], "id int, year int, x double, y double")
    centers = spark.createDataFrame([("1101000000001", 0.0, 1.0)], "tot_reg_cd string, x double, y double")
    cars = spark.createDataFrame([("11010", 2010, 0)], "sgg_cd string, year int, value bigint")
    border = [(s, f"n{s}", "11010", *e) for s, e in enumerate([(0., 0., 9., 0.), (9., 0., 9., 9.), (9., 9., 0., 9.), (0., 9., 0., 0.)])]
    edges = spark.createDataFrame(border, "seg int, sigungu_nm string, sigungu_cd string, x1 double, y1 double, x2 double, y2 double")
    lay = Layers.from_frames({"railstation": stations, "centers": centers, "car_registration": cars, "border_edge": edges}, timeless=["border_edge"])
    assert compute(lay, "rail_station_count", year=2000, radius=BufferSize.MEDIUM).first()["C_Railstation_0500"] == 2
    row = compute(lay, "border_car_registration", year=2010).first()
    assert row["area"] == 81 and row["area_per_car"] is None
    both = compute_many(lay, [{"name": "rail_station_count", "year": y, "radius": 500} for y in (2000, 2010)])
    assert both.columns == ["tot_reg_cd", "C_Railstation_0500", "C_Railstation_0500_2010"]
    assert tuple(both.first())[1:] == (2, 0)


def test_grid_borders_ignore_the_year(spark):
    rows = [("c1", 0, 0., 0., 9., 0.), ("c1", 1, 9., 0., 0., 9.), ("c1", 2, 0., 9., 0., 0.)]
    grid = spark.createDataFrame(rows, "tot_reg_cd string, seg int, x1 double, y1 double, x2 double, y2 double")
    town = grid.withColumnRenamed("tot_reg_cd", "adm_dr_cd").withColumn("year", F.lit(2010))
    grid = grid.withColumn("year", F.lit(2023)).union(grid.withColumn("year", F.lit(2020)))
    rail = spark.createDataFrame([(1, 2010, 1., 1., 4., 1.)], "fid int, year int, x1 double, y1 double, x2 double, y2 double")
    lay = Layers.from_frames({"border_edge_jgg": grid, "border_edge_emd": town, "rail_seg": rail})
    assert compute(lay, "border_rail", year=2010, border_type="jgg").first().asDict() == {"tot_reg_cd": "c1", "rail_length": 3.0}
    assert compute(lay, "border_rail", year=2010, border_type="emd").first()["adm_dr_cd"] == "c1"
    assert compute(lay, "border_rail", year=2005, border_type="emd").count() == 0


def test_scoring_files_once_and_as_they_arrive(spark, tmp_path):
    stops = spark.createDataFrame([(i, 2023, 1_000_000.0 + i, 2_000_000.0) for i in range(5)], "id int, year int, x double, y double")
    lay = Layers.from_frames({"bus_stop": stops})
    file = tmp_path / "in" / "a.csv"
    file.parent.mkdir()
    file.write_text("id,lon,lat\n5,127.5,38.0\n6,bad,38.0\n7,128.5,38.0\n")
    totals = Observation()
    scored, rejects = score_csv(spark, lay, str(file), "bus_stop", totals, year=2023, radius=100)
    assert {(r["point_id"], r["C_Bus_0100"]) for r in scored.collect()} == {(1, 5), (3, 0)}
    assert [r["row_no"] for r in rejects.collect()] == [2]
    assert totals.get == {"rows": 3, "rejects": 1}
    out = str(tmp_path / "out")
    args = (spark, lay, str(file.parent), "id string, lon string, lat string", "bus_stop", out, str(tmp_path / "state"))
    score_stream(*args, year=2023, radius=100).awaitTermination()
    (file.parent / "b.csv").write_text("id,lon,lat\n5,127.5,38.0\n5,127.5,38.0\n,127.5,38.0\n")
    told = []
    score_stream(*args, year=2023, radius=100, files_per_batch=1, on_batch=told.append).awaitTermination()
    done = [(r["batch"], r["rows"], r["rejects"], r["scored"]) for r in progress_of(spark, out).orderBy("batch").collect()]
    assert done == [(0, 3, 1, 2), (1, 3, 0, 3)] and [(t["batch"], t["rows"], t["scored"]) for t in told] == [(1, 3, 3)]
    rows = spark.read.parquet(f"{out}/scored").collect()
    # Ids may repeat or lack; every row of every file is a point of its own.
    assert sorted((r["id"] or "", r["C_Bus_0100"]) for r in rows) == [("", 5), ("5", 5), ("5", 5), ("5", 5), ("7", 0)]
    assert len({r["point_id"] for r in rows}) == 5
    assert [r["id"] for r in spark.read.parquet(f"{out}/rejects").collect()] == ["6"]
    scored, _ = score_csv(spark, lay, str(file.parent), "bus_stop", year=2023, radius=100)
    assert {(r["point_id"], r["C_Bus_0100"]) for r in scored.collect()} == {(1, 5), (3, 0), (4, 5), (5, 5), (6, 5)}
    with pytest.raises(Exception, match="exists"):
        write_result(stops, out)
