"""Operators that no variable shows on its own: sources, measures, joins, checks, composites."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.functions import indices
from terracell.functions.projection import to_metric
from terracell.operators import attributes, buffers, measures, overlay, quantiles, raster
from terracell.operators.nearest import distance_to_all
from terracell.plans.centers import intersection_areas
from terracell.plans.registry import Request, compute, compute_many
from terracell.sources import indexes
from terracell.sources import points as point_source
from terracell.sources import rasters as raster_source
from terracell.sources import sinks
from terracell.sources.layers import Layers, read_layer
from terracell.streaming.scoring import progress_of, score_csv, score_stream

from .borders import cells, stats_sql
from .centers import AT_CELL, POINTS, _alive, _emission, _projected, custom_points, gon_area_sql, weights_sql
from .support import (
    BORDER_MEASURES,
    COS,
    GRID,
    ORACLES,
    TIMELESS,
    amounts,
    border_points,
    gon_clip,
    in_border,
    in_disc,
    in_gon,
    near,
    point_seg,
    poly_clip,
    query,
    rounded,
)



def _name(kind: str) -> str:
    """A table name of its own for every run."""
    return f"{kind}_{uuid.uuid4().hex}"


# Sources and sinks

# A coordinate file with other column names, an extra column and rows that are not numbers.
UPLOAD = """SELECT cast(c_custkey AS string) AS id,
  CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE cast(126.935e0 + (c_custkey*7919 % 9973)*0.0000225e0 AS string) END AS Longitude,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE cast(37.46e0 + (c_custkey*6101 % 9967)*0.000018e0 AS string) END AS LAT,
  c_mktsegment AS note FROM customer"""


def _upload(spark: SparkSession) -> str:
    path = sinks.scratch_path(spark, "upload")
    sinks.write_result(spark.sql(UPLOAD), path, "csv")
    return path


@query(
    "read_points_csv",
    """SELECT cast(c_custkey AS string) AS id, round(126.935e0 + (c_custkey*7919 % 9973)*0.0000225e0,7) AS x,
  round(37.46e0 + (c_custkey*6101 % 9967)*0.000018e0,7) AS y, c_mktsegment AS note FROM customer
WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0""",
)
def read_points_csv(spark: SparkSession, lay: Layers) -> DataFrame:
    good, _ = point_source.validate_xy(point_source.read_points_csv(spark, _upload(spark)))
    return rounded(good.select("id", "x", "y", "note"), 7)


@query(
    "reject_points_csv",
    "SELECT cast(c_custkey AS string) AS id, c_mktsegment AS note FROM customer WHERE c_custkey % 11 = 0 OR c_custkey % 13 = 0",
)
def reject_points_csv(spark: SparkSession, lay: Layers) -> DataFrame:
    _, rejects = point_source.validate_xy(point_source.read_points_csv(spark, _upload(spark)))
    return rejects.select("id", "note")


@query(
    "points_from_lists",
    """SELECT tot_reg_cd, 1 AS point_id, round(x,4) AS x, round(y,4) AS y FROM centers
UNION ALL SELECT tot_reg_cd, 2, round(x+10,4), round(y-10,4) FROM centers
UNION ALL SELECT tot_reg_cd, 3, round(y,4), round(x,4) FROM centers""",
)
def points_from_lists(spark: SparkSession, lay: Layers) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    requests = lay.get("centers").select("tot_reg_cd", F.array(F.array(x, y), F.array(x + 10, y - 10), F.array(y, x)).alias("coords"))
    return rounded(point_source.points_from_arrays(requests, "coords", ["tot_reg_cd"]))


@query(
    "read_layer_year",
    """SELECT year, count(*) AS features, round(sum(sqrt(pow(x2-x1,2)+pow(y2-y1,2))),3) AS length FROM road_seg
WHERE year = 2015 GROUP BY year""",
)
def read_layer_year(spark: SparkSession, lay: Layers) -> DataFrame:
    """Store a layer by year, read one year of it back."""
    path = sinks.scratch_path(spark, "layers")
    lay.get("road_seg").write.partitionBy("year").parquet(f"{path}/road_seg")
    roads = Layers.from_folder(spark, path).at("road_seg", 2015)
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return rounded(roads.groupBy("year").agg(F.count(F.lit(1)).alias("features"), F.sum(length).alias("length")), 3)


# File names as the emission archive has them, including ones that break the convention.
FILES = """SELECT '/data/' || CASE WHEN o_orderkey % 9 = 8 THEN 'misc' ELSE cast(2001 + o_orderkey % 4 AS string) || '_emission' END
  || '/emission.' || CASE o_orderkey % 5 WHEN 0 THEN 'p' WHEN 1 THEN 'l' WHEN 2 THEN 'a' WHEN 3 THEN 'p' ELSE 'x' END || '.'
  || CASE o_orderkey % 6 WHEN 0 THEN 'co.tif' WHEN 1 THEN '2001_nh3.tif' WHEN 2 THEN '2005_voc_v2.old.tif' WHEN 3 THEN 'pm10.r' || cast(o_orderkey AS string) || '.tif'
     WHEN 4 THEN 'sox' ELSE 'tsp_' || cast(o_orderkey AS string) || '.tif' END AS path FROM orders"""

# Files whose cells arrived in the store.
STORED = FILES + " WHERE o_orderstatus <> 'P'"

META = f"""files AS ({FILES}), named AS (SELECT path, regexp_extract(path, '[^/]*$') AS filename,
  try_cast(nullif(regexp_extract(path, '(?:^|/)([0-9]{{4}})_emission/[^/]*$', 1), '') AS int) AS year FROM files),
meta AS (SELECT path, filename, year,
  CASE regexp_extract(filename, 'emission\\.([pla])\\.', 1) WHEN 'p' THEN 'point' WHEN 'l' THEN 'line' WHEN 'a' THEN 'area' ELSE 'unknown' END AS emission_type,
  regexp_replace(coalesce(nullif(regexp_extract(filename, 'emission\\.[pla]\\.([a-zA-Z0-9_]+)\\.tif$', 1), ''),
    nullif(regexp_extract(filename, 'emission\\.[pla]\\.[0-9]{{4}}_([a-zA-Z0-9_]+)\\.tif$', 1), ''),
    nullif(regexp_extract(filename, 'emission\\.[pla]\\.[0-9]{{4}}_([a-zA-Z0-9_]+)_', 1), ''),
    nullif(regexp_extract(filename, 'emission\\.[pla]\\.([a-zA-Z0-9_]+)\\.', 1), ''), 'unknown'), '^[0-9]{{4}}_(.+)$', '\\1') AS pollutant_type
  FROM named)"""


@query("raster_file_meta", f"WITH {META} SELECT path, filename, year, emission_type, pollutant_type FROM meta")
def raster_file_meta(spark: SparkSession, lay: Layers) -> DataFrame:
    return raster_source.with_raster_meta(spark.sql(FILES))


@query(
    "raster_load_report",
    f"""WITH {META}, stored AS ({STORED}) SELECT year, count(*) FILTER (WHERE path IN (SELECT path FROM stored)) AS loaded,
  count(*) FILTER (WHERE path NOT IN (SELECT path FROM stored)) AS failed FROM meta WHERE year IS NOT NULL AND path LIKE '%.tif' GROUP BY year""",
)
def raster_load_report(spark: SparkSession, lay: Layers) -> DataFrame:
    """Files of early orders hold no cells."""
    return raster_source.load_report(raster_source.with_raster_meta(spark.sql(FILES)), spark.sql(STORED))


@query(
    "raster_tiles",
    "SELECT layer, cast(floor(col/100) AS int) AS tile_col, cast(floor(row/100) AS int) AS tile_row, count(*) AS cells "
    "FROM raster_cell GROUP BY ALL",
)
def raster_tiles(spark: SparkSession, lay: Layers) -> DataFrame:
    return raster.retile(lay.get("raster_cell")).groupBy("layer", "tile_col", "tile_row").agg(F.count(F.lit(1)).alias("cells"))


@query(
    "raster_reload",
    """SELECT emission_type, pollutant_type, year, count(*) AS n_cells, round(sum(val * CASE WHEN pollutant_type = 'co' THEN 2 ELSE 1 END),3) AS total
FROM emission_cell GROUP BY ALL""",
)
def raster_reload(spark: SparkSession, lay: Layers) -> DataFrame:
    """Load all files, then load the CO files again with doubled values: they replace the first ones."""
    path = sinks.scratch_path(spark, "raster")
    name = F.concat(F.lit("emission."), F.substring("emission_type", 1, 1), F.lit("."), F.col("pollutant_type"), F.lit(".tif"))
    cells_ = lay.get("emission_cell").withColumn("filename", name)
    raster_source.write_raster(spark, cells_, path, first=True)
    again = cells_.filter(F.col("pollutant_type") == "co").withColumn("val", F.col("val") * 2)
    raster_source.write_raster(spark, again, path)
    stored = raster_source.read_raster(spark, path)
    return rounded(
        stored.groupBy("emission_type", "pollutant_type", "year").agg(F.count(F.lit(1)).alias("n_cells"), F.sum("val").alias("total")), 3
    )


@query(
    "write_formats",
    "SELECT f.format, count(*) AS n, cast(sum(cast(c.x AS bigint)) AS bigint) AS sum_x FROM centers c "
    "CROSS JOIN (SELECT 'csv' AS format UNION ALL SELECT 'json' UNION ALL SELECT 'parquet' UNION ALL SELECT 'table') f GROUP BY f.format",
)
def write_formats(spark: SparkSession, lay: Layers) -> DataFrame:
    """One result through every sink and back."""
    centers = lay.get("centers")
    found = None
    for fmt in [*sinks.FORMATS, "table"]:
        path = sinks.scratch_path(spark, fmt)
        if fmt == "table":
            table = f"centers_{path[-32:]}"
            sinks.write_table(centers.filter("x < 960000"), table, path=path)
            sinks.write_table(centers.filter("x >= 960000"), table)
            back = spark.table(table)
        else:
            sinks.write_result(centers, path, fmt)
            reader = spark.read.option("header", True) if fmt == "csv" else spark.read
            back = reader.format(fmt).load(path)
        part = back.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("double").cast("bigint")).alias("sum_x"))
        part = part.withColumn("format", F.lit(fmt))
        found = part if found is None else found.unionByName(part)
    return found


@query(
    "result_records",
    """SELECT '{"tot_reg_cd":"' || tot_reg_cd || '","C_Car_sigungu_mean_registration":' || cast(r.value AS varchar) || '}' AS record
FROM centers c JOIN car_registration r ON substring(c.tot_reg_cd,1,5) = r.sgg_cd WHERE r.year = 2010""",
)
def result_records(spark: SparkSession, lay: Layers) -> DataFrame:
    return sinks.to_records(compute(lay, "car_mean", year=2010))


@query("preview_rows", "SELECT tot_reg_cd, x, y FROM centers ORDER BY tot_reg_cd LIMIT 100")
def preview_rows(spark: SparkSession, lay: Layers) -> DataFrame:
    return sinks.preview(lay.get("centers").orderBy("tot_reg_cd"), 100)


# Predicates


@query("code_prefix", "SELECT tot_reg_cd, substring(tot_reg_cd,1,5) AS sgg_cd FROM centers WHERE tot_reg_cd LIKE '111%'")
def code_prefix(spark: SparkSession, lay: Layers) -> DataFrame:
    c = lay.get("centers").filter(F.col("tot_reg_cd").startswith("111"))
    return c.select("tot_reg_cd", F.substring("tot_reg_cd", 1, 5).alias("sgg_cd"))


@query("county_codes", "SELECT DISTINCT substring(tot_reg_cd,1,5) AS sgg_cd FROM centers")
def county_codes(spark: SparkSession, lay: Layers) -> DataFrame:
    return lay.get("centers").select(F.substring("tot_reg_cd", 1, 5).alias("sgg_cd")).distinct()


@query(
    "negative_values",
    """SELECT c_custkey, 'c_acctbal' AS "column", round(c_acctbal,4) AS value FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'c_nationkey', cast(c_nationkey AS double) FROM customer WHERE c_nationkey < 0""",
)
def negative_values(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(attributes.negative_values(spark.table("customer"), ["c_custkey"], ["c_acctbal", "c_nationkey"]))


# Coordinates and measures


@query("project_points", f"WITH {_projected()} SELECT point_id, round(x,4) AS x, round(y,4) AS y FROM metric")
def project_points(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(to_metric(custom_points(spark)))


@query(
    "border_measures",
    f"""WITH {BORDER_MEASURES}, box AS (SELECT sigungu_cd, min(x1) AS min_x, min(y1) AS min_y, max(x1) AS max_x, max(y1) AS max_y
  FROM border_edge GROUP BY sigungu_cd)
SELECT sigungu_cd, round(area,4) AS area, round(x,4) AS x, round(y,4) AS y, min_x, min_y, max_x, max_y FROM measures JOIN box USING (sigungu_cd)""",
)
def border_measures(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(measures.border_measures(lay.get("border_edge"), "sigungu_cd"))


@query(
    "landuse_polygon_areas",
    """WITH org AS (SELECT fid, min(x1) AS ox, min(y1) AS oy FROM landuse_edge GROUP BY fid)
SELECT fid, round(sum((x1-ox)*(y2-oy)-(x2-ox)*(y1-oy))/2,3) AS area FROM landuse_edge JOIN org USING (fid) GROUP BY fid""",
)
def landuse_polygon_areas(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(overlay.polygon_areas(lay.get("landuse_edge"), ["fid"]), 3)


@query("line_lengths", "SELECT original_id, round(sum(sqrt(pow(x2-x1,2)+pow(y2-y1,2))),4) AS length FROM road_seg GROUP BY original_id")
def line_lengths(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(measures.line_lengths(lay.get("road_seg"), ["original_id"]))


@query(
    "buffer_zones",
    "SELECT tot_reg_cd, x, y, r FROM centers CROSS JOIN (SELECT 100e0 AS r UNION ALL SELECT 300e0 UNION ALL SELECT 500e0 "
    "UNION ALL SELECT 1000e0 UNION ALL SELECT 5000e0) q",
)
def buffer_zones(spark: SparkSession, lay: Layers) -> DataFrame:
    return buffers.buffers(lay.get("centers"), [100, 300, 500, 1000, 5000])


@query(
    "ring_points",
    f"""SELECT c.tot_reg_cd, t.id FROM centers c JOIN hospitals t ON {near('c', 't', 1030)}
AND {in_gon('t.x-c.x', 't.y-c.y', 1030)} AND NOT {in_gon('t.x-c.x', 't.y-c.y', 1000)}""",
)
def ring_points(spark: SparkSession, lay: Layers) -> DataFrame:
    """Hospitals in the 30 m ring around the 1000 m buffer."""
    pairs = buffers.buffer_pairs(lay.get("centers"), lay.get("hospitals").select("id", "x", "y"), 1030, hole=1000, keep=["id"])
    return pairs.select("tot_reg_cd", "id")


# Rings with faults: a missing edge, an edge without length, and a swapped corner.
FAULTY = """SELECT fid, seg, x1, y1, CASE WHEN fid % 10 = 1 AND seg = 2 THEN x1 ELSE x2 END AS x2,
  CASE WHEN fid % 10 = 1 AND seg = 2 THEN y1 ELSE y2 END AS y2 FROM landuse_edge WHERE NOT (fid % 10 = 0 AND seg = 4) AND NOT (fid % 50 = 3 AND seg > 1)
  AND fid % 10 <> 2 UNION ALL
  SELECT a.fid, a.seg, CASE a.seg WHEN 0 THEN a.x1 WHEN 1 THEN c.x1 ELSE a.x1 END, CASE a.seg WHEN 0 THEN a.y1 WHEN 1 THEN c.y1 ELSE a.y1 END,
    CASE a.seg WHEN 0 THEN c.x1 ELSE a.x2 END, CASE a.seg WHEN 0 THEN c.y1 ELSE a.y2 END
  FROM landuse_edge a JOIN landuse_edge c ON c.fid = a.fid AND c.seg = 3 WHERE a.fid % 10 = 2"""


@query(
    "invalid_rings",
    f"""WITH faulty AS ({FAULTY}),
ends AS (SELECT fid, x, y, sum(d) AS d FROM (SELECT fid, x1 AS x, y1 AS y, 1 AS d FROM faulty UNION ALL SELECT fid, x2, y2, -1 FROM faulty) e GROUP BY ALL),
basic AS (SELECT fid, count(*) < 3 AS too_few_edges, bool_or(x1 = x2 AND y1 = y2) AS zero_length_edge FROM faulty GROUP BY fid),
crossing AS (SELECT DISTINCT a.fid FROM faulty a JOIN faulty b ON a.fid = b.fid AND a.seg < b.seg
  WHERE sign((a.x2-a.x1)*(b.y1-a.y1)-(a.y2-a.y1)*(b.x1-a.x1)) * sign((a.x2-a.x1)*(b.y2-a.y1)-(a.y2-a.y1)*(b.x2-a.x1)) < 0
  AND sign((b.x2-b.x1)*(a.y1-b.y1)-(b.y2-b.y1)*(a.x1-b.x1)) * sign((b.x2-b.x1)*(a.y2-b.y1)-(b.y2-b.y1)*(a.x2-b.x1)) < 0
  UNION SELECT p.fid FROM faulty p JOIN faulty e ON p.fid = e.fid
  WHERE ((e.x2-e.x1)*(p.y1-e.y1)-(e.y2-e.y1)*(p.x1-e.x1) = 0 AND (e.x1-p.x1)*(e.x2-p.x1)+(e.y1-p.y1)*(e.y2-p.y1) < 0)
  OR ((e.x2-e.x1)*(p.y2-e.y1)-(e.y2-e.y1)*(p.x2-e.x1) = 0 AND (e.x1-p.x2)*(e.x2-p.x2)+(e.y1-p.y2)*(e.y2-p.y2) < 0)
  UNION SELECT fid FROM (SELECT fid FROM faulty WHERE x1 <> x2 OR y1 <> y2 GROUP BY fid, x1, y1 HAVING count(*) > 1) t)
SELECT b.fid, b.fid IN (SELECT fid FROM ends WHERE d <> 0) AS open_ring, too_few_edges, zero_length_edge,
  b.fid IN (SELECT fid FROM crossing) AS self_crossing FROM basic b
WHERE too_few_edges OR zero_length_edge OR b.fid IN (SELECT fid FROM ends WHERE d <> 0) OR b.fid IN (SELECT fid FROM crossing)""",
)
def invalid_rings(spark: SparkSession, lay: Layers) -> DataFrame:
    return measures.invalid_rings(spark.sql(FAULTY), ["fid"])


@query(
    "orient_rings",
    "SELECT fid, seg, 0 AS ring, round(x1,4) AS x1, round(y1,4) AS y1, round(x2,4) AS x2, round(y2,4) AS y2 FROM landuse_edge",
)
def orient_rings(spark: SparkSession, lay: Layers) -> DataFrame:
    """Every third polygon turned the wrong way round, and set right again."""
    wrong = F.col("fid") % 3 == 0
    swap = {"x1": "x2", "y1": "y2", "x2": "x1", "y2": "y1"}
    turned = lay.get("landuse_edge").select(
        "fid", "seg", F.lit(0).alias("ring"), *[F.when(wrong, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in swap.items()]
    )
    return rounded(measures.orient_rings(turned, ["fid"]))


# Joins

INSIDE_HOSPITALS = border_points("SELECT x, y, id FROM hospitals", "id")


@query("points_in_borders", f"WITH {INSIDE_HOSPITALS} SELECT id, sigungu_cd FROM inside")
def points_in_borders(spark: SparkSession, lay: Layers) -> DataFrame:
    tiles = overlay.tile_polygons(lay.get("border_edge"), ["sigungu_cd"])
    return overlay.match_polygons(lay.get("hospitals").select("id", "x", "y"), tiles).select("id", "sigungu_cd")


@query(
    "points_in_landuse",
    f"""SELECT code, count(*) AS pairs FROM (SELECT s.fid, s.code, t.id FROM bus_stop t JOIN landuse_edge s ON {in_border('t.x', 't.y', 's')}
GROUP BY s.fid, s.code, t.id HAVING count(*) % 2 = 1) h GROUP BY code""",
)
def points_in_landuse(spark: SparkSession, lay: Layers) -> DataFrame:
    """Overlapping polygons: a stop counts once for each polygon it lies in."""
    tiles = overlay.tile_polygons(lay.get("landuse_edge"), ["code"])
    return overlay.sum_in_polygons(lay.get("bus_stop"), tiles, {"pairs": F.lit(1)})


@query(
    "points_within_distance",
    f"SELECT c.tot_reg_cd, t.id FROM centers c JOIN bus_stop t ON {near('c', 't', 500)} AND {in_disc('t.x-c.x', 't.y-c.y', 500)}",
)
def points_within_distance(spark: SparkSession, lay: Layers) -> DataFrame:
    stops = lay.get("bus_stop").select("id", "x", "y")
    return buffers.buffer_pairs(lay.get("centers"), stops, 500, shape="disc", keep=["id"]).select("tot_reg_cd", "id")


@query(
    "points_within_polygon_buffer",
    f"SELECT c.tot_reg_cd, t.id FROM centers c JOIN bus_stop t ON {near('c', 't', 500)} AND {in_gon('t.x-c.x', 't.y-c.y', 500)}",
)
def points_within_polygon_buffer(spark: SparkSession, lay: Layers) -> DataFrame:
    return buffers.buffer_pairs(lay.get("centers"), lay.get("bus_stop").select("id", "x", "y"), 500, keep=["id"]).select("tot_reg_cd", "id")


def _line_in_disc(r: float) -> str:
    a = "((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1))"
    b = "((x1-cx)*(x2-x1)+(y1-cy)*(y2-y1))"
    c = f"((x1-cx)*(x1-cx)+(y1-cy)*(y1-cy)-{r * r!r})"
    root = f"sqrt(greatest(0e0, {b}*{b}-{a}*{c}))"
    return (f"CASE WHEN {a} > 0 AND {b}*{b} > {a}*{c} THEN greatest(0e0, least(1e0, (-{b}+{root})/{a}) - greatest(0e0, (-{b}-{root})/{a})) "
            f"ELSE 0e0 END * sqrt({a})")


@query(
    "line_length_in_disc",
    f"""WITH pairs AS (SELECT c.tot_reg_cd, c.x AS cx, c.y AS cy, s.x1, s.y1, s.x2, s.y2 FROM centers c JOIN rail_seg s
  ON least(s.x1,s.x2) < c.x+1000 AND greatest(s.x1,s.x2) > c.x-1000 AND least(s.y1,s.y2) < c.y+1000 AND greatest(s.y1,s.y2) > c.y-1000),
sums AS (SELECT tot_reg_cd, sum({_line_in_disc(1000.0)}) AS length FROM pairs GROUP BY tot_reg_cd)
SELECT c.tot_reg_cd, round(coalesce(length,0),3) AS length FROM centers c LEFT JOIN sums s ON s.tot_reg_cd = c.tot_reg_cd""",
)
def line_length_in_disc(spark: SparkSession, lay: Layers) -> DataFrame:
    centers = lay.get("centers")
    found = buffers.buffer_lines(centers, lay.get("rail_seg"), 1000, {"length": F.lit(1.0)}, shape="disc")
    return rounded(attributes.fill_units(centers, found, "tot_reg_cd", {"length": 0.0}), 3)


_SIDE = "(b.x2-b.x1)*({y}-b.y1)-(b.y2-b.y1)*({x}-b.x1) >= 0"
_ENDS = " AND ".join(_SIDE.format(x=f"f.x{i}", y=f"f.y{i}") for i in (1, 2))


@query(
    "lines_within_borders",
    f"SELECT f.fid, b.sigungu_cd FROM rail_seg f CROSS JOIN border_edge b GROUP BY f.fid, b.sigungu_cd HAVING bool_and({_ENDS})",
)
def lines_within_borders(spark: SparkSession, lay: Layers) -> DataFrame:
    tiles = overlay.tile_polygons(lay.get("border_edge"), ["sigungu_cd"])
    return overlay.lines_within_polygons(lay.get("rail_seg"), tiles)


@query(
    "polygons_within_borders",
    f"SELECT f.fid, b.sigungu_cd FROM landuse_edge f CROSS JOIN border_edge b GROUP BY f.fid, b.sigungu_cd HAVING bool_and({_ENDS})",
)
def polygons_within_borders(spark: SparkSession, lay: Layers) -> DataFrame:
    return overlay.polygons_within_polygons(lay.get("landuse_edge"), lay.get("border_edge"), "sigungu_cd")


def _held(layer: str, r: int) -> str:
    ends = " AND ".join(in_gon(f"t.x{i}-c.x", f"t.y{i}-c.y", r) for i in (1, 2))
    return f"""WITH held AS (SELECT c.tot_reg_cd, t.fid FROM centers c JOIN (SELECT *, count(*) OVER (PARTITION BY fid) AS n FROM {layer}) t
  ON t.x1 BETWEEN c.x-{r} AND c.x+{r} AND t.y1 BETWEEN c.y-{r} AND c.y+{r} AND {ends}
  GROUP BY c.tot_reg_cd, t.fid, t.n HAVING count(*) = t.n)
SELECT tot_reg_cd, cast(count(*) AS bigint) AS n FROM held GROUP BY tot_reg_cd"""


# Lines at the edge of a border: along it and on inside, along it only, along it and on outside, and from inside to half a
# millionth of a metre beyond it.
RIM_LINES = """SELECT fid, seg, x1, y1, x2, y2 FROM (
  SELECT o_orderkey AS fid, s.seg, o_orderkey % 4 AS kind, e.x1 + t*(e.x2-e.x1) AS px, e.y1 + t*(e.y2-e.y1) AS py, e.x2 AS bx, e.y2 AS by_, m.cx, m.cy,
    CASE WHEN o_orderkey % 4 = 3 THEN m.cx WHEN s.seg = 0 THEN e.x1 + t*(e.x2-e.x1) ELSE e.x2 END AS x1,
    CASE WHEN o_orderkey % 4 = 3 THEN m.cy WHEN s.seg = 0 THEN e.y1 + t*(e.y2-e.y1) ELSE e.y2 END AS y1,
    CASE WHEN o_orderkey % 4 = 3 THEN e.x1 + t*(e.x2-e.x1) + 5e-7*(e.y2-e.y1)/sqrt(pow(e.x2-e.x1,2)+pow(e.y2-e.y1,2))
      WHEN s.seg = 0 THEN e.x2 WHEN o_orderkey % 4 = 2 THEN e.x2*1.1e0 - m.cx*0.1e0 ELSE m.cx END AS x2,
    CASE WHEN o_orderkey % 4 = 3 THEN e.y1 + t*(e.y2-e.y1) - 5e-7*(e.x2-e.x1)/sqrt(pow(e.x2-e.x1,2)+pow(e.y2-e.y1,2))
      WHEN s.seg = 0 THEN e.y2 WHEN o_orderkey % 4 = 2 THEN e.y2*1.1e0 - m.cy*0.1e0 ELSE m.cy END AS y2
  FROM (SELECT o_orderkey, cast(11000 + (o_orderkey % 25)*10 AS string) AS code, (1 + o_custkey % 83)/90e0 AS t FROM orders) o
  JOIN border_edge e ON e.sigungu_cd = o.code AND e.seg = cast(floor(o_orderkey/25) AS bigint) % 4
  JOIN (SELECT sigungu_cd, avg(x1) AS cx, avg(y1) AS cy FROM border_edge GROUP BY sigungu_cd) m ON m.sigungu_cd = o.code
  CROSS JOIN (SELECT 0 AS seg UNION ALL SELECT 1) s) q WHERE seg = 0 OR kind IN (0, 2)"""


@query(
    "lines_along_borders",
    f"""WITH lines AS ({RIM_LINES}),
{poly_clip('rim', 'SELECT fid, seg, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS by_ FROM lines', 'fid, seg', 'SELECT sigungu_cd, x1, y1, x2, y2 FROM border_edge', 'sigungu_cd')},
told AS (SELECT m.sid, m.sigungu_cd, m.t0, min({point_seg('m.mx', 'm.my', 'e')}) <= 1e-8 AS on_edge,
    count(*) FILTER (WHERE (e.y1 > m.my) <> (e.y2 > m.my) AND m.mx < (e.x2-e.x1)*(m.my-e.y1)/nullif(e.y2-e.y1,0)+e.x1) % 2 = 1 AS inside
  FROM rim_mid m JOIN rim_poly e USING (sigungu_cd) GROUP BY m.sid, m.sigungu_cd, m.t0)
SELECT s.fid, t.sigungu_cd FROM told t JOIN rim_seg s USING (sid) JOIN (SELECT fid, count(*) AS n FROM rim_seg GROUP BY fid) c ON c.fid = s.fid
GROUP BY s.fid, t.sigungu_cd, c.n HAVING bool_and(on_edge OR inside) AND bool_or(inside AND NOT on_edge) AND count(DISTINCT s.sid) = c.n""",
)
def lines_along_borders(spark: SparkSession, lay: Layers) -> DataFrame:
    """Lines that run along a border belong to the zone that they go on into."""
    tiles = overlay.tile_polygons(lay.get("border_edge"), ["sigungu_cd"])
    return overlay.lines_within_polygons(spark.sql(RIM_LINES), tiles)


@query("lines_within_buffer", _held("rail_seg", 1000))
def lines_within_buffer(spark: SparkSession, lay: Layers) -> DataFrame:
    return buffers.buffer_holds(lay.get("centers"), lay.get("rail_seg"), 1000, {"n": F.lit(1)})


@query("polygons_within_buffer", _held("landuse_edge", 1000))
def polygons_within_buffer(spark: SparkSession, lay: Layers) -> DataFrame:
    return buffers.buffer_holds(lay.get("centers"), lay.get("landuse_edge"), 1000, {"n": F.lit(1)})


@query(
    "coastline_feature_distances",
    f"SELECT c.tot_reg_cd, s.fid, round(min({point_seg('c.x', 'c.y')}),4) AS distance FROM centers c CROSS JOIN coast_seg s "
    "WHERE s.year = 2010 GROUP BY c.tot_reg_cd, s.fid",
)
def coastline_feature_distances(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(distance_to_all(lay.get("centers"), lay.at("coast_seg", 2010), "tot_reg_cd", "fid"))


@query(
    "buffer_border_overlap",
    f"""WITH {gon_area_sql('SELECT sigungu_cd, x1, y1, x2, y2 FROM border_edge', 'sigungu_cd', 'sigungu_cd', 1000)},
org AS (SELECT sigungu_cd, min(x1) AS ox, min(y1) AS oy FROM border_edge GROUP BY sigungu_cd),
za AS (SELECT sigungu_cd, sum((x1-ox)*(y2-oy)-(x2-ox)*(y1-oy))/2 AS zone_area FROM border_edge JOIN org USING (sigungu_cd) GROUP BY sigungu_cd)
SELECT tot_reg_cd AS center_reg_cd, sigungu_cd AS border_reg_cd, round(area,2) AS area, round(zone_area,2) AS zone_area
FROM covered JOIN za USING (sigungu_cd) WHERE area > 1e-6""",
)
def buffer_border_overlap(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(intersection_areas(Request(lay, None, 2010, 2010, 1000)), 2)


@query(
    "buffer_buffer_overlap",
    f"""WITH sides AS (SELECT k, cos((k+0.5)*{math.pi / 16!r}) AS nx, sin((k+0.5)*{math.pi / 16!r}) AS ny, 300*cos(k*{math.pi / 16!r}) AS c1,
  300*sin(k*{math.pi / 16!r}) AS s1, 300*cos((k+1)*{math.pi / 16!r}) AS c2, 300*sin((k+1)*{math.pi / 16!r}) AS s2 FROM (SELECT unnest(generate_series(0,31)) AS k) g),
pair AS (SELECT a.tot_reg_cd AS u, b.tot_reg_cd AS v, b.x-a.x AS dx, b.y-a.y AS dy FROM centers a JOIN centers b
  ON b.x BETWEEN a.x-600 AND a.x+600 AND b.y BETWEEN a.y-600 AND a.y+600 AND a.tot_reg_cd <> b.tot_reg_cd),
edge AS (SELECT u, v, dx, dy, k, c1, s1, c2, s2, c1-dx AS ax, s1-dy AS ay FROM pair CROSS JOIN sides),
cut AS (SELECT e.u, e.v, e.k, any_value(e.c1*e.s2-e.c2*e.s1 - (e.dx*(e.s2-e.s1)-e.dy*(e.c2-e.c1))/2) AS cr,
  max(CASE WHEN rate < 0 THEN room/rate WHEN rate = 0 AND room <= 0 THEN 2e0 ELSE 0e0 END) AS t_in,
  min(CASE WHEN rate > 0 THEN room/rate ELSE 1e0 END) AS t_out
  FROM (SELECT e.*, h.nx*(e.c2-e.c1)+h.ny*(e.s2-e.s1) AS rate, {300 * COS!r} - (h.nx*e.ax+h.ny*e.ay) AS room FROM edge e CROSS JOIN sides h) e GROUP BY e.u, e.v, e.k),
area AS (SELECT u, v, sum(cr*greatest(0e0, least(1e0,t_out)-greatest(0e0,t_in))) AS a FROM cut GROUP BY u, v)
SELECT u AS center_reg_cd, v AS border_reg_cd, round(a,2) AS area, round({16 * math.sin(math.pi / 16) * 90000!r}e0,2) AS zone_area FROM area WHERE a > 0
UNION ALL SELECT tot_reg_cd, tot_reg_cd, round({16 * math.sin(math.pi / 16) * 90000!r}e0,2), round({16 * math.sin(math.pi / 16) * 90000!r}e0,2) FROM centers""",
)
def buffer_buffer_overlap(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(intersection_areas(Request(lay, None, 2010, 2010, 300), mode="buffer"), 2)


@query(
    "buffer_disc_overlap",
    f"""SELECT u AS center_reg_cd, v AS border_reg_cd,
  round(CASE WHEN d = 0 THEN pi()*90000 ELSE 180000*acos(d/600) - d/2*sqrt(360000 - d*d) END,2) AS area, round({math.pi * 90000!r}e0,2) AS zone_area
FROM (SELECT a.tot_reg_cd AS u, b.tot_reg_cd AS v, sqrt(pow(b.x-a.x,2)+pow(b.y-a.y,2)) AS d FROM centers a JOIN centers b
  ON b.x BETWEEN a.x-600 AND a.x+600 AND b.y BETWEEN a.y-600 AND a.y+600) q WHERE d < 600""",
)
def buffer_disc_overlap(spark: SparkSession, lay: Layers) -> DataFrame:
    """Common areas of true circles: lenses in closed form."""
    return rounded(intersection_areas(Request(lay, None, 2010, 2010, 300), mode="buffer", exact=True), 2)


@query(
    "missing_units",
    "SELECT DISTINCT unit_cd AS tot_reg_cd FROM unit_edge WHERE unit_cd NOT IN (SELECT tot_reg_cd FROM unit_pop WHERE year = 2015)",
)
def missing_units(spark: SparkSession, lay: Layers) -> DataFrame:
    """Census units without inhabitants."""
    units = lay.get("border_edge_jgg").select("tot_reg_cd").distinct()
    return attributes.missing_units(units, lay.at("unit_pop", 2015), "tot_reg_cd")


# Rasters

# Rasters that overlap: every third cell comes again from a second file, half of these as nodata.
OVERLAPPING = """SELECT col, row, val, 1 AS tile FROM raster_cell WHERE layer = 'dem'
UNION ALL SELECT col, row, CASE WHEN (col + row) % 2 = 0 THEN val + 1000 END, 2 FROM raster_cell WHERE layer = 'dem' AND (col + row) % 3 = 0"""


@query(
    "raster_mosaic",
    f"WITH o AS ({OVERLAPPING}) SELECT col, row, round(arg_max(val, tile) FILTER (WHERE val IS NOT NULL),4) AS val FROM o GROUP BY col, row",
)
def raster_mosaic(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(raster.mosaic(spark.sql(OVERLAPPING), "tile"))


@query(
    "raster_algebra",
    """SELECT pollutant_type, col, row, round(CASE WHEN count(val) = 3 THEN sum(val) END,4) AS val FROM emission_cell
GROUP BY pollutant_type, col, row HAVING count(*) = 3""",
)
def raster_algebra(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(raster.add_rasters(lay.get("emission_cell"), "emission_type", ["point", "line", "area"], ["pollutant_type"]))


# Source rasters loaded twice in places, and addresses that one source lacks.
PATCHY = """SELECT emission_type, pollutant_type, col, row, val, 1 AS rid FROM emission_cell WHERE NOT (emission_type = 'area' AND col % 5 = 0)
UNION ALL SELECT emission_type, pollutant_type, col, row, val * 2, 2 FROM emission_cell WHERE emission_type <> 'area' AND (col + row) % 4 = 0"""


@query(
    "raster_algebra_patchy",
    f"""WITH p AS ({PATCHY}), m AS (SELECT emission_type, pollutant_type, col, row, arg_max(val, rid) FILTER (WHERE val IS NOT NULL) AS val FROM p GROUP BY ALL)
SELECT pollutant_type, col, row, round(CASE WHEN count(val) = 3 THEN sum(val) END,4) AS val FROM m GROUP BY pollutant_type, col, row HAVING count(*) = 3""",
)
def raster_algebra_patchy(spark: SparkSession, lay: Layers) -> DataFrame:
    sources = ["point", "line", "area"]
    return rounded(raster.add_rasters(spark.sql(PATCHY), "emission_type", sources, ["pollutant_type"], order="rid"))


# A second elevation file over a part of the first, with nodata of its own.
RELOADED = """SELECT layer, 1 AS rid, col, row, val FROM raster_cell
UNION ALL SELECT layer, 2, col, row, CASE WHEN col % 3 > 0 THEN val + 7 END FROM raster_cell WHERE row % 2 = 0"""


@query(
    "zonal_statistics_reloaded",
    f"""WITH reloaded AS ({RELOADED}),
once AS (SELECT layer, col, row, arg_max(val, rid) FILTER (WHERE val IS NOT NULL) AS val FROM reloaded GROUP BY layer, col, row),
{border_points(cells('true', 'once', 'layer, val'), 'layer, val')}
SELECT sigungu_cd, {', '.join(stats_sql(f"(CASE WHEN layer = '{v}' THEN val END)", v) for v in ('dem', 'dsm'))}
FROM inside GROUP BY sigungu_cd""",
)
def zonal_statistics_reloaded(spark: SparkSession, lay: Layers) -> DataFrame:
    """Repeated cells count once, the last value that is not nodata."""
    again = Layers(lambda name: spark.sql(RELOADED) if name == "raster_cell" else lay.get(name), TIMELESS)
    return rounded(compute(again, "border_topographic_model", year=2010, grid=GRID), dem_mean=10, dsm_mean=10)


@query(
    "buffer_cell_mean",
    f"""WITH cell AS ({cells("year = 2015 AND statistic = 'max' AND val IS NOT NULL", 'ndvi_cell')})
SELECT c.tot_reg_cd, round(avg(t.val),12) AS mean FROM centers c JOIN cell t ON {near('c', 't', 1000)} AND {in_gon('t.x-c.x', 't.y-c.y', 1000)}
GROUP BY c.tot_reg_cd""",
)
def buffer_cell_mean(spark: SparkSession, lay: Layers) -> DataFrame:
    wanted = lay.at("ndvi_cell", 2015).filter(F.col("statistic") == "max").select("col", "row", "val")
    return rounded(raster.buffer_tile_mean(lay.get("centers"), wanted, GRID, 1000, cellwise=True), 12)


# Aggregates and summaries


@query(
    "code_year_summary",
    "SELECT sgg_cd, year, round(avg(value),4) AS avg_value, max(value) AS max_value FROM car_registration GROUP BY sgg_cd, year",
)
def code_year_summary(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(attributes.code_year_summary(lay.get("car_registration"), ["sgg_cd", "year"], "value"))


@query(
    "column_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}),6) AS mean, round(stddev_samp({c}),6) AS std, "
        f"round(min({c}),4) AS min, round(max({c}),4) AS max, "
        + ", ".join(f'round(quantile_cont({c}, {q / 100}),4) AS "{q}%"' for q in (25, 50, 75))
        + " FROM emission_point" for c in ("nh3", "voc", "tsp", "co")
    ),
)
def column_summary(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(attributes.column_summary(spark.table("emission_point"), ["nh3", "voc", "tsp", "co"]), 4, mean=6, std=6)


_LEVELS = quantiles.LEVELS


@query(
    "quantile_levels",
    "WITH q AS (SELECT quantile_cont(x, [0.2,0.4,0.6,0.8]) AS e FROM centers) SELECT tot_reg_cd, CASE "
    + " ".join(f"WHEN x <= e[{i + 1}] THEN '{_LEVELS[i]}'" for i in range(4))
    + f" ELSE '{_LEVELS[4]}' END AS level FROM centers CROSS JOIN q",
)
def quantile_levels(spark: SparkSession, lay: Layers) -> DataFrame:
    centers = lay.get("centers")
    return centers.select("tot_reg_cd", quantiles.quantile_level(centers, "x").alias("level"))


@query(
    "values_sorted",
    "SELECT row_number() OVER (ORDER BY value DESC, sgg_cd) AS rank, sgg_cd, value FROM car_registration WHERE year = 2020",
)
def values_sorted(spark: SparkSession, lay: Layers) -> DataFrame:
    """The highest registrations first."""
    cars = lay.at("car_registration", 2020).select("sgg_cd", "value")
    return attributes.number_in_order(cars, [F.desc("value"), F.col("sgg_cd")]).select("rank", "sgg_cd", "value")


@query("units_sorted", "SELECT row_number() OVER (ORDER BY tot_reg_cd) AS place, tot_reg_cd, round(x,4) AS x, round(y,4) AS y FROM centers")
def units_sorted(spark: SparkSession, lay: Layers) -> DataFrame:
    """Written in order of code and read again: the place is that of the row in its files."""
    path = sinks.scratch_path(spark, "sorted")
    sinks.write_sorted(lay.get("centers"), path, ["tot_reg_cd"], "csv")
    rows = point_source.number_rows(spark.read.option("header", True).csv(path))
    return rounded(rows.select(F.col("row_no").alias("place"), "tot_reg_cd", *[F.col(c).cast("double").alias(c) for c in ("x", "y")]))


# Composites


def _nearest_distance(layer: str, where: str) -> str:
    return f"(SELECT c.tot_reg_cd, min(sqrt(pow(c.x-t.x,2)+pow(c.y-t.y,2))) AS d FROM centers c CROSS JOIN (SELECT * FROM {layer} WHERE {where}) t GROUP BY c.tot_reg_cd)"


@query(
    "accessibility",
    f"""SELECT tot_reg_cd, round(b.d,4) AS "D_Bus_2023", round(s.d,4) AS "D_Sub_2020", round(r.d,4) AS "D_Road_2020",
  round(1/(b.d+1)*0.4 + 1/(s.d+1)*0.4 + 1/(r.d+1)*0.2, 8) AS accessibility_score
FROM {_nearest_distance('bus_stop', 'year = 2023')} b FULL JOIN {_nearest_distance('railstation', 'year = 2020')} s USING (tot_reg_cd)
FULL JOIN (SELECT c.tot_reg_cd, min({point_seg('c.x', 'c.y')}) AS d FROM centers c CROSS JOIN (SELECT * FROM road_seg WHERE year = 2020) s GROUP BY c.tot_reg_cd) r USING (tot_reg_cd)""",
)
def accessibility(spark: SparkSession, lay: Layers) -> DataFrame:
    merged = compute_many(
        lay,
        [
            {"name": "bus_stop_distance", "year": 2023},
            {"name": "rail_station_distance", "year": 2020},
            {"name": "road_distance", "year": 2020},
        ],
    )
    score = indices.accessibility_score("D_Bus_2023", "D_Sub_2020", "D_Road_2020")
    return rounded(merged.withColumn("accessibility_score", score), accessibility_score=8)


def _counted(layer: str, where: str, r: int) -> str:
    return (f"(SELECT c.tot_reg_cd, count(*) AS n FROM centers c JOIN (SELECT * FROM {layer} WHERE {where}) t ON {near('c', 't', r)} "
            f"AND {in_gon('t.x-c.x', 't.y-c.y', r)} GROUP BY c.tot_reg_cd)")


@query(
    "facility_counts_by_year_and_radius",
    "SELECT c.tot_reg_cd, "
    + ", ".join(f'coalesce(q{y}_{r}.n,0) AS "C_Clinic_{y}_{r:04d}"' for y in (2005, 2015) for r in (300, 1000))
    + " FROM centers c "
    + " ".join(
        f"LEFT JOIN {_counted('clinics', _alive(y), r)} q{y}_{r} ON q{y}_{r}.tot_reg_cd = c.tot_reg_cd" for y in (2005, 2015) for r in (300, 1000)
    ),
)
def facility_counts_by_year_and_radius(spark: SparkSession, lay: Layers) -> DataFrame:
    return compute_many(lay, [{"name": "clinic_count", "year": y, "radius": r} for y in (2005, 2015) for r in (300, 1000)])


_GRID = [(y, r) for y in (2000, 2010, 2020) for r in (100, 500, 5000)]


@query(
    "hospital_counts_nested",
    "SELECT c.tot_reg_cd, "
    + ", ".join(f'coalesce(q{y}_{r}.n,0) AS "C_Hospital_{y}_{r:04d}"' for y, r in _GRID)
    + " FROM centers c "
    + " ".join(f"LEFT JOIN {_counted('hospitals', _alive(y), r)} q{y}_{r} ON q{y}_{r}.tot_reg_cd = c.tot_reg_cd" for y, r in _GRID),
)
def hospital_counts_nested(spark: SparkSession, lay: Layers) -> DataFrame:
    """Three years and three radii far apart, from one pass over the layer."""
    return compute_many(lay, [{"name": "hospital_count", "year": y, "radius": r} for y, r in _GRID])


@query("population_stored_overlaps", f"SELECT * FROM ({ORACLES['population']}) p JOIN ({ORACLES['house_type_count']}) h USING (tot_reg_cd)")
def population_stored_overlaps(spark: SparkSession, lay: Layers) -> DataFrame:
    """Two census variables from one overlap table, kept in buckets of the census unit."""
    kept = indexes.store_overlaps(intersection_areas(Request(lay, None, 2010, 2010, 500)), _name("overlaps"), path=sinks.scratch_path(spark, "overlaps"))
    wanted = [{"name": n, "border_type": "sgg", "overlaps": kept} for n in ("population", "house_type_count")]
    return rounded(compute_many(lay, wanted, year=2010, radius=500))


@query(
    "borders_stored_tiles",
    f"""SELECT * FROM ({ORACLES['border_road']}) r JOIN ({ORACLES['border_hospital']}) h USING (sigungu_cd) JOIN ({ORACLES['border_topographic_model']}) t USING (sigungu_cd)""",
)
def borders_stored_tiles(spark: SparkSession, lay: Layers) -> DataFrame:
    """Road length, hospitals and elevation of borders whose tiles were kept in buckets of the grid cell."""
    tiles = overlay.tile_polygons(lay.get("border_edge"), ["sigungu_cd"])
    kept = indexes.store_tiles(tiles, _name("tiles"), path=sinks.scratch_path(spark, "tiles"))
    wanted = [{"name": n, "year": y} for n, y in (("border_road", 2000), ("border_hospital", 2010), ("border_topographic_model", 2010))]
    return rounded(compute_many(lay, wanted, grid=GRID, tiles=kept), 4, road_length=3, dem_mean=10, dsm_mean=10)


RING = ["above_20", "below_20", "above_50", "below_50"]
RING_DIGITS = {f"{c}_1000{again}": 6 for c in RING for again in ("", "_dsm_1000")}


def _relative(layer: str) -> str:
    return f"({ORACLES[f'relative_{layer}_1000']})"


@query(
    "merged_terrain",
    f"""SELECT coalesce(a.tot_reg_cd, d.tot_reg_cd, s.tot_reg_cd) AS tot_reg_cd, coalesce(d.sgg_cd, s.sgg_cd) AS sgg_cd, a."Altitude_k",
  {', '.join(f'd.{c}_1000' for c in RING)}, {', '.join(f's.{c}_1000 AS {c}_1000_dsm_1000' for c in RING)}
FROM ({ORACLES['dem_value']}) a FULL JOIN {_relative('dem')} d ON d.tot_reg_cd = a.tot_reg_cd FULL JOIN {_relative('dsm')} s ON s.tot_reg_cd = coalesce(a.tot_reg_cd, d.tot_reg_cd)""",
)
def merged_terrain(spark: SparkSession, lay: Layers) -> DataFrame:
    wanted = [{"name": "dem_value"}, *({"name": "relative_elevation", "layer": n, "distance": 1000} for n in ("dem", "dsm"))]
    return rounded(compute_many(lay, wanted, grid=GRID), **{c: d for c, d in RING_DIGITS.items()})


@query(
    "mobility_summary",
    """WITH m AS (SELECT c.tot_reg_cd, r.value FROM centers c JOIN car_registration r ON substring(c.tot_reg_cd,1,5) = r.sgg_cd WHERE r.year = 2015),
s AS (SELECT sgg_cd, max(value) FILTER (WHERE year = 2000) AS a, max(value) FILTER (WHERE year = 2020) AS b FROM car_registration GROUP BY sgg_cd)
SELECT m.tot_reg_cd, m.value AS cars, round(s.b / nullif(s.a,0),6) AS growth FROM m JOIN s ON s.sgg_cd = substring(m.tot_reg_cd,1,5)""",
)
def mobility_summary(spark: SparkSession, lay: Layers) -> DataFrame:
    """County registrations of two years as a ratio, carried to every centroid."""
    merged = compute_many(lay, [{"name": "car_mean", "year": y} for y in (2015, 2000, 2020)])
    name = "C_Car_sigungu_mean_registration"
    growth = indices.density(f"{name}_2020", f"{name}_2000")
    return rounded(merged.select("tot_reg_cd", F.col(name).alias("cars"), growth.alias("growth")), 6)


def _weight(table: str, column: str, r: int) -> str:
    return f"""(SELECT ia.center_reg_cd AS tot_reg_cd, coalesce(sum(cast(p.{column} AS double)*ia.area/ia.zone_area),0) AS v FROM ia
LEFT JOIN {table} p ON p.tot_reg_cd = ia.border_reg_cd AND p.year = 2020 GROUP BY ia.center_reg_cd)"""


@query(
    "urban_characteristics",
    f"""WITH {weights_sql(500)}, {gon_clip('SELECT x1, y1, x2, y2 FROM road_seg WHERE year = 2020', 500, '').replace('sides AS', 'sides2 AS', 1).replace('near_segs', 'road_near').replace('cuts', 'road_cuts').replace('gon_parts', 'road_parts').replace('CROSS JOIN sides', 'CROSS JOIN sides2')},
len AS (SELECT tot_reg_cd, sum(share*sqrt(pow(x2-x1,2)+pow(y2-y1,2))) AS v FROM road_parts GROUP BY tot_reg_cd)
SELECT c.tot_reg_cd, round(p.v,4) AS "POP_0500", round(b.v,4) AS "B_bnu_1_0500", round(coalesce(l.v,0),3) AS road_l_0500,
  round(b.v/nullif(p.v,0),6) AS business_density, round(coalesce(l.v,0)/nullif(p.v,0),6) AS road_density
FROM centers c LEFT JOIN {_weight('sgis_pop', 'pop', 500)} p ON p.tot_reg_cd = c.tot_reg_cd
LEFT JOIN {_weight('sgis_wide', 'v_001', 500)} b ON b.tot_reg_cd = c.tot_reg_cd LEFT JOIN len l ON l.tot_reg_cd = c.tot_reg_cd""",
)
def urban_characteristics(spark: SparkSession, lay: Layers) -> DataFrame:
    merged = compute_many(
        lay,
        [{"name": n, "border_type": "sgg"} for n in ("population", "business_registration_count", "road_length")],
        year=2020, radius=500,
    )
    business = indices.density("B_bnu_1_0500", "POP_0500").alias("business_density")
    roads = indices.density("road_l_0500", "POP_0500").alias("road_density")
    chosen = merged.select("tot_reg_cd", "POP_0500", "B_bnu_1_0500", "road_l_0500", business, roads)
    return rounded(chosen, road_l_0500=3, business_density=6, road_density=6)


@query(
    "environmental_score",
    f"""WITH em AS ({_emission(3000)})
SELECT c.tot_reg_cd, round(coalesce(t.val,0)*0.6 - (em."EM_CO_03000" + em."EM_NOx_03000")*0.4,6) AS environmental_score
FROM centers c LEFT JOIN ndvi_cell t ON {AT_CELL} AND t.year = 2010 AND t.statistic = 'mean' JOIN em ON em.tot_reg_cd = c.tot_reg_cd""",
)
def environmental_score(spark: SparkSession, lay: Layers) -> DataFrame:
    merged = compute_many(
        lay, [{"name": "emission_vector", "radius": 3000}, {"name": "ndvi_mean", "radius": 1000}], year=2010, grid=GRID
    )
    score = indices.environmental_score("ndvi_y1_mean_1000", ["EM_CO_03000", "EM_NOx_03000"])
    return rounded(amounts(merged).select("tot_reg_cd", score.alias("environmental_score")), 6)


@query(
    "urbanization_levels",
    f"""WITH {weights_sql(500)}, {gon_area_sql('SELECT fid, code, x1, y1, x2, y2 FROM landuse_edge WHERE year = 2020 AND code IN (110,120)', 'fid', 'code', 500)
    .replace('lay AS', 'lu_lay AS', 1).replace('FROM lay', 'FROM lu_lay').replace('lay_box', 'lu_box').replace('sides', 'lu_sides').replace('near_segs', 'lu_near').replace('cuts', 'lu_cuts').replace('gon_parts', 'lu_parts').replace('rim AS', 'lu_rim AS').replace('FROM rim)', 'FROM lu_rim)').replace('FROM rim ', 'FROM lu_rim ').replace('FROM rim', 'FROM lu_rim').replace('lu_rimin', 'rimin').replace('rimin', 'lu_in').replace('covered', 'lu_covered')},
lu AS (SELECT tot_reg_cd, sum(area)/{math.pi * 250000!r} AS v FROM lu_covered GROUP BY tot_reg_cd),
idx AS (SELECT c.tot_reg_cd, round(p.v*0.6 + coalesce(l.v,0)*0.4,8) AS i FROM centers c JOIN {_weight('sgis_pop', 'pop', 500)} p ON p.tot_reg_cd = c.tot_reg_cd
  LEFT JOIN lu l ON l.tot_reg_cd = c.tot_reg_cd),
q AS (SELECT quantile_cont(i, [0.2,0.4,0.6,0.8]) AS e FROM idx)
SELECT tot_reg_cd, round(i,6) AS urbanization_index, CASE """
    + " ".join(f"WHEN i <= e[{k + 1}] THEN '{_LEVELS[k]}'" for k in range(4))
    + f" ELSE '{_LEVELS[4]}' END AS urbanization_level FROM idx CROSS JOIN q",
)
def urbanization_levels(spark: SparkSession, lay: Layers) -> DataFrame:
    merged = compute_many(lay, [{"name": "population", "border_type": "sgg"}, {"name": "landuse"}], year=2020, radius=500)
    index = indices.urbanization_index("POP_0500", ["LS110_0500", "LS120_0500"])
    # The classes need the index twice, for the bounds and for the rows: keep it once computed.
    scored = merged.select("tot_reg_cd", F.round(index, 8).alias("urbanization_index")).checkpoint()
    level = quantiles.quantile_level(scored, "urbanization_index").alias("urbanization_level")
    return rounded(scored.select("tot_reg_cd", "urbanization_index", level), 6)


# Coordinate files as jobs

# The points in three folders of files, of which each begins its own numbers; rows that are no coordinates among them. The files of a
# folder hold ranges of its numbers in order.
def _files(spark: SparkSession, name: str) -> str:
    path = sinks.scratch_path(spark, name)
    for k, rows in enumerate(("point_id % 3 = 1", "point_id % 3 = 2", "point_id % 3 = 0")):
        part = spark.sql(POINTS).filter(rows).withColumn("x", F.when(F.col("point_id") % 17 > 0, F.col("x")))
        sinks.write_sorted(part.select(F.floor(F.col("point_id") / 3).alias("id"), "x", "y"), f"{path}/file{k}", ["id"], "csv")
    return path


_SCORED = f"""WITH {_projected()}
SELECT m.point_id, round(m.lon,7) AS x, round(m.lat,7) AS y, coalesce(h.n,0) AS "C_Bus_0300" FROM metric m LEFT JOIN (
  SELECT m.point_id, count(*) AS n FROM metric m JOIN (SELECT * FROM bus_stop WHERE year = 2023) t
  ON {near('m', 't', 300)} AND {in_disc('t.x-m.x', 't.y-m.y', 300)} GROUP BY m.point_id) h ON h.point_id = m.point_id"""


_PLACES = """place AS (SELECT point_id, row_number() OVER (ORDER BY (point_id + 2) % 3, point_id) AS place FROM metric)"""


@query(
    "score_coordinate_files",
    f"WITH {_projected()}, {_PLACES} SELECT place AS point_id, x, y, \"C_Bus_0300\" FROM ({_SCORED}) q JOIN place USING (point_id) WHERE point_id % 17 > 0",
)
def score_coordinate_files(spark: SparkSession, lay: Layers) -> DataFrame:
    scored, _ = score_csv(spark, lay, f"{_files(spark, 'coords')}/*", "bus_stop", year=2023, radius=300)
    return rounded(scored.select("point_id", "x", "y", "C_Bus_0300"), 7)


@query(
    "score_totals",
    """SELECT 3 AS batches, count(*) AS rows, count(*) FILTER (WHERE c_custkey % 17 = 0) AS rejects, count(*) FILTER (WHERE c_custkey % 17 > 0) AS scored FROM customer""",
)
def score_totals(spark: SparkSession, lay: Layers) -> DataFrame:
    """Totals that a stream of files leaves beside its results, one folder of files a batch."""
    path, out, state = _files(spark, "counted"), *(sinks.scratch_path(spark, n) for n in ("scored", "state"))
    for k in range(3):
        stream = score_stream(spark, lay, f"{path}/file[0-{k}]", "id string, x string, y string", "bus_stop", out, state, year=2023, radius=300)
        stream.awaitTermination()
    sums = [F.sum(c).alias(c) for c in ("rows", "rejects", "scored")]
    return progress_of(spark, out).agg(F.count(F.lit(1)).cast("int").alias("batches"), *sums)


@query(
    "score_arriving_files",
    f"""SELECT cast(floor(point_id/3) AS bigint) AS id, 'scored' AS kind, x, y, "C_Bus_0300" FROM ({_SCORED}) q WHERE point_id % 17 > 0
UNION ALL SELECT cast(floor(point_id/3) AS bigint), 'rejects', NULL, y, NULL FROM ({_SCORED}) q WHERE point_id % 17 = 0""",
)
def score_arriving_files(spark: SparkSession, lay: Layers) -> DataFrame:
    """The same through a file stream that takes up whatever files are there; ids repeat from file to file."""
    path, out, state = _files(spark, "arriving"), *(sinks.scratch_path(spark, n) for n in ("scored", "state"))
    stream = score_stream(spark, lay, f"{path}/*", "id string, x string, y string", "bus_stop", out, state, year=2023, radius=300)
    stream.awaitTermination()
    found = []
    for kind, count in (("scored", F.col("C_Bus_0300")), ("rejects", F.lit(None).cast("long"))):
        rows = spark.read.parquet(f"{out}/{kind}")
        xy = [F.col(c).cast("double").alias(c) for c in ("x", "y")]
        found.append(rows.select(F.col("id").cast("long"), F.lit(kind).alias("kind"), *xy, count.alias("C_Bus_0300")))
    return rounded(found[0].unionByName(found[1]), 7)
