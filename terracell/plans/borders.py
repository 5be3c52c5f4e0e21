"""Variables per administrative border."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.facilities import open_in_year
from ..operators.attributes import fill_units, merge_by_id, prefix_join
from ..operators.measures import border_measures
from ..operators.nearest import distance_to_all, distance_to_union, nearest
from ..operators.overlay import (
    Tiles,
    line_length_in_polygons,
    lines_within_polygons,
    overlay_areas,
    polygons_within_polygons,
    sum_in_polygons,
    tile_polygons,
)
from ..operators.raster import add_rasters, load_order, mosaic, mosaic_layers, zonal_statistics, zonal_sums
from ..sources.layers import POLLUTANTS
from .registry import EVERY_FIVE, UNIT_BORDER, Request, variable

# Land-use codes and the spelling of pollutants in column names.
LANDUSE_CODES = [110, 120, 130, 140, 150, 160, 200, 310, 320, 330, 400, 500, 600, 710]
POLLUTANT_LABELS = {"co": "CO", "nox": "NOx", "nh3": "NH3", "voc": "VOC", "pm10": "PM10", "sox": "SOx", "tsp": "TSP"}


def _tiles(q: Request, edges: DataFrame, code: str) -> Tiles:
    """The border's tiles: stored ones if the request brings them along."""
    given = q.options.get("tiles")
    if given is None:
        return tile_polygons(edges, [code])
    if given.key != [code]:
        raise ValueError(f"The tiles have key {given.key}, not ['{code}']")
    return given


def _codes(edges: DataFrame, code: str) -> DataFrame:
    return edges.select(code).distinct()


@variable("border_river", UNIT_BORDER, years=EVERY_FIVE)
def river(q: Request) -> DataFrame:
    """Water area; the river layer counts as a whole, whatever its year."""
    edges, code = q.border()
    water = q.layers.get("river_edge").withColumn("_all", F.lit(1))
    found = overlay_areas(edges, code, water, ["_all"]).groupBy(code).agg(F.sum("area").alias("river_area_sum"))
    return fill_units(_codes(edges, code), found, code, {"river_area_sum": 0.0})


def emission_sums(found: list[DataFrame], unit: str) -> DataFrame:
    """One total per pollutant over the sources."""
    total = found[0]
    for part in found[1:]:
        total = total.unionByName(part)
    return total.groupBy(unit).agg(*[F.sum(p).alias(p) for p in POLLUTANTS])


@variable("border_emission", UNIT_BORDER, years=EVERY_FIVE, extras=("tiles",))
def emission(q: Request) -> DataFrame:
    """Emissions of points, lines and areas that lie wholly inside the border."""
    edges, code = q.border()
    tiles = _tiles(q, edges, code)
    points = sum_in_polygons(q.layers.at("emission_point", q.year), tiles, {p: F.col(p) for p in POLLUTANTS})
    lines, areas = (q.layers.at(n, q.year) for n in ("emission_line", "emission_area"))
    amounts = [F.first(p).alias(p) for p in POLLUTANTS]
    held = []
    for layer, pairs in (
        (lines, lines_within_polygons(lines, tiles)),
        (areas, polygons_within_polygons(areas, edges, code)),
    ):
        per_feature = layer.groupBy("fid").agg(*amounts)
        held.append(pairs.join(per_feature, "fid").select(code, *POLLUTANTS))
    sums = emission_sums([points.select(code, *POLLUTANTS), *held], code)
    filled = fill_units(_codes(edges, code), sums, code, {p: 0 for p in POLLUTANTS})
    return filled.withColumnsRenamed({p: f"EM_{POLLUTANT_LABELS[p]}_{q.year}" for p in POLLUTANTS})


@variable("border_car_registration", UNIT_BORDER, years=EVERY_FIVE)
def car_registration(q: Request) -> DataFrame:
    edges, code = q.border()
    areas = border_measures(edges, code).select(code, "area")
    cars = q.layers.at("car_registration", q.year).select("sgg_cd", "year", "value")
    return prefix_join(areas, code, cars, "sgg_cd").select(
        code,
        "year",
        F.col("value").alias("sigungu_car_registration"),
        "area",
        F.try_divide(F.col("area"), F.col("value")).alias("area_per_car"),
    )


@variable("border_landuse_area", UNIT_BORDER, years=EVERY_FIVE)
def landuse_area(q: Request) -> DataFrame:
    """Area and share of each land-use code; all codes in one pass."""
    edges, code = q.border()
    polys = q.layers.version("landuse_edge", q.year, {}, "v002").filter(F.col("code").isin(LANDUSE_CODES))
    found = overlay_areas(edges, code, polys.withColumnRenamed("code", "_lu"), ["_lu"])
    wide = found.groupBy(code).pivot("_lu", LANDUSE_CODES).agg(F.sum("area"))
    zones = border_measures(edges, code).select(code, "area")
    joined = zones.join(wide, code, "left")
    columns: list[Column] = []
    for lu in LANDUSE_CODES:
        area = F.coalesce(F.col(str(lu)), F.lit(0.0))
        columns += [area.alias(f"lu_{lu}_area"), (area / F.col("area")).alias(f"lu_{lu}_ratio")]
    return joined.select(code, *columns)


def _centroids(q: Request) -> tuple[DataFrame, str]:
    edges, code = q.border()
    return border_measures(edges, code).select(code, "x", "y"), code


@variable("border_coastline_distance", UNIT_BORDER, years=EVERY_FIVE)
def coastline_distance(q: Request) -> DataFrame:
    """Distance to every coastline feature: one row per border and feature."""
    centroids, code = _centroids(q)
    found = distance_to_all(centroids, q.layers.at("coast_seg", q.year), code, "fid")
    return found.select(code, F.col("distance").alias("centroid_to_coastline"))


@variable("border_airport_distance", UNIT_BORDER, years=EVERY_FIVE)
def airport_distance(q: Request) -> DataFrame:
    centroids, code = _centroids(q)
    found = nearest(centroids, q.layers.at("airport", q.year), code, ["name"])
    return found.select(code, F.col("name").alias("airport_name"), F.col("distance").alias("distance_to_nearest_airport"))


@variable("border_mdl_distance", UNIT_BORDER, years=EVERY_FIVE)
def mdl_distance(q: Request) -> DataFrame:
    centroids, code = _centroids(q)
    return distance_to_union(centroids, q.layers.at("mdl_seg", q.year), code).withColumnRenamed("distance", "mdl_distance")


@variable("border_port_distance", UNIT_BORDER, years=EVERY_FIVE)
def port_distance(q: Request) -> DataFrame:
    centroids, code = _centroids(q)
    found = nearest(centroids, q.layers.at("ports", q.year), code, ["alias"])
    return found.select(code, F.col("alias").alias("port_alias"), F.col("distance").alias("port_distance"))


def _line_length(q: Request, layer: str, name: str) -> DataFrame:
    edges, code = q.border()
    found = line_length_in_polygons(q.layers.at(layer, q.year), _tiles(q, edges, code), {name: F.lit(1.0)})
    return fill_units(_codes(edges, code), found, code, {name: 0.0})


@variable("border_rail", UNIT_BORDER, years=EVERY_FIVE, extras=("tiles",))
def rail(q: Request) -> DataFrame:
    return _line_length(q, "rail_seg", "rail_length")


@variable("border_road", UNIT_BORDER, years=EVERY_FIVE, remap={2000: 2005}, extras=("tiles",))
def road(q: Request) -> DataFrame:
    return _line_length(q, "road_seg", "road_length")


@variable("border_ndvi", UNIT_BORDER, years=EVERY_FIVE, extras=("statistic", "tiles"))
def ndvi(q: Request) -> DataFrame:
    edges, code = q.border()
    cells = q.layers.at("ndvi_cell", q.year).filter(F.col("statistic") == q.options.get("statistic", "mean"))
    once = mosaic(cells, load_order(cells))
    return zonal_statistics(once, _tiles(q, edges, code), q.raster("ndvi"), {"val": "ndvi"})


@variable("border_topographic_model", UNIT_BORDER, years=EVERY_FIVE, extras=("tiles",))
def topographic_model(q: Request) -> DataFrame:
    """Elevation and surface statistics; borders outside one raster keep the other's."""
    edges, code = q.border()
    tiles = _tiles(q, edges, code)
    raster = q.layers.get("raster_cell")
    order, names = load_order(raster), ["dem", "dsm"]
    if q.raster("dem") == q.raster("dsm"):
        # One geometric join of cell addresses for both.
        return zonal_statistics(mosaic_layers(raster, "layer", names, order), tiles, q.raster("dem"), {n: n for n in names})
    found = [zonal_statistics(mosaic_layers(raster, "layer", [n], order), tiles, q.raster(n), {n: n}) for n in names]
    return merge_by_id(found, code)


# Emission raster years and the border year that goes with each.
RASTER_EMISSION_YEARS = {2001: 2000, 2005: 2005, 2010: 2010, 2015: 2015, 2019: 2020}


@variable("border_raster_emission", UNIT_BORDER, years=tuple(RASTER_EMISSION_YEARS), extras=("tiles",))
def raster_emission(q: Request) -> DataFrame:
    """Sum over the border of point + line + area emission rasters, all pollutants in one pass."""
    edges, code = q.layers.border(q.border_type, RASTER_EMISSION_YEARS[q.year])
    cells = q.layers.at("emission_cell", q.year)
    added = add_rasters(cells, "emission_type", ["point", "line", "area"], ["pollutant_type"], order=load_order(cells))
    wide = added.groupBy("col", "row").pivot("pollutant_type", POLLUTANTS).agg(F.first("val"))
    sums = zonal_sums(wide, _tiles(q, edges, code), q.raster("emission"), POLLUTANTS)
    return sums.withColumnsRenamed({p: f"r_emission_{p}" for p in POLLUTANTS})


def _facility_count(q: Request, layer: str, name: str) -> DataFrame:
    edges, code = q.border()
    alive = q.layers.get(layer).filter(open_in_year(q.year))
    found = sum_in_polygons(alive, _tiles(q, edges, code), {name: F.lit(1)})
    return fill_units(_codes(edges, code), found, code, {name: 0})


@variable("border_clinic", UNIT_BORDER, years=EVERY_FIVE, extras=("tiles",))
def clinic(q: Request) -> DataFrame:
    return _facility_count(q, "clinics", "clinic_count")


@variable("border_hospital", UNIT_BORDER, years=EVERY_FIVE, extras=("tiles",))
def hospital(q: Request) -> DataFrame:
    return _facility_count(q, "hospitals", "hospital_count")
