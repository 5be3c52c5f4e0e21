"""Variables per census-unit centroid."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.facilities import open_by_year_prefix
from ..operators.attributes import areal_weights, fill_units, lookup_join, prefix_join, row_total
from ..operators.buffers import buffer_areas, buffer_holds, buffer_lines, buffer_overlaps, buffer_points, buffer_points_nested
from ..operators.measures import border_measures
from ..operators.nearest import nearest
from ..operators.raster import buffer_tile_mean, load_order, mosaic, ring_shares, sample
from ..sources.layers import POLLUTANTS
from .borders import LANDUSE_CODES, POLLUTANT_LABELS, emission_sums
from .registry import (
    CENTER_CODE,
    EVERY_FIVE,
    FROM_2005,
    TWO_LATEST,
    UNIT_CENTER,
    BufferSize,
    EmissionBufferSize,
    NdviBufferSize,
    Request,
    variable,
)

REMAP_2000 = {2000: 2005}


def _r4(radius: int) -> str:
    return str(radius).zfill(4)


def _filled(q: Request, found: DataFrame, fill: dict[str, float | int]) -> DataFrame:
    return fill_units(q.centers(), found, CENTER_CODE, fill)


# Elevation under the centroid


def _elevation(q: Request, layer: str) -> DataFrame:
    cells = q.layers.get("raster_cell").filter(F.col("layer") == layer)
    return mosaic(cells, load_order(cells))


def _altitude(q: Request, layer: str, name: str) -> DataFrame:
    return sample(q.centers(), _elevation(q, layer), q.raster(layer)).withColumnRenamed("val", name)


@variable("dem_value", UNIT_CENTER)
def dem_value(q: Request) -> DataFrame:
    return _altitude(q, "dem", "Altitude_k")


@variable("dsm_value", UNIT_CENTER)
def dsm_value(q: Request) -> DataFrame:
    return _altitude(q, "dsm", "Altitude_a")


# Counts in buffers


@dataclass(frozen=True)
class Count:
    """A counted layer, the rows of it that count in a year, and the column that holds the count."""

    layer: str
    alive: Callable[[int], Column]
    column: Callable[[int, int], str]


def _of_year(year: int) -> Column:
    return F.col("year") == year


# Columns of the counts.
COUNTS = {
    "bus_stop_count": Count("bus_stop", _of_year, lambda year, r: f"C_Bus_{_r4(r)}"),
    "rail_station_count": Count("railstation", _of_year, lambda year, r: f"C_Railstation_{_r4(r)}"),
    "clinic_count": Count("clinics", open_by_year_prefix, lambda year, r: f"C_Clinic_{year}_{_r4(r)}"),
    "hospital_count": Count("hospitals", open_by_year_prefix, lambda year, r: f"C_Hospital_{year}_{_r4(r)}"),
}


def _count(q: Request, name: str) -> DataFrame:
    spec = COUNTS[name]
    column = spec.column(q.year, q.radius)
    points = q.layers.at(spec.layer, q.year) if spec.alive is _of_year else q.layers.get(spec.layer).filter(spec.alive(q.year))
    return _filled(q, buffer_points(q.centers(), points, q.radius, {column: F.lit(1)}), {column: 0})


def count_many(layer: str, requests: list[tuple[str, Request]]) -> DataFrame:
    """Counts of one layer for several years and radii from one pass over it, one column a request, named by its number.

    Every year is a measure of its own, every radius a zone of one nested cover.
    """
    q = requests[0][1]
    years, radii = sorted({r.year for _, r in requests}), sorted({r.radius for _, r in requests})
    alive = {(n, r.year): COUNTS[n].alive(r.year) for n, r in requests}
    points = q.layers.get(layer)
    if "year" in points.columns and any(COUNTS[n].alive is _of_year for n, _ in requests):
        points = points.filter(F.col("year").isin(years))
    elif any(COUNTS[n].alive is _of_year for n, _ in requests):
        # A layer without years is refused or holds for all, as for a single year.
        points = q.layers.at(layer, years[0])
        alive = {k: F.lit(True) for k in alive}
    measures = {f"_{n}_{year}": F.when(test, 1).otherwise(0) for (n, year), test in alive.items()}
    found = buffer_points_nested(q.centers(), points, radii, measures)
    columns = {f"_{i}": F.col(f"_{n}_{r.year}")[radii.index(r.radius)] for i, (n, r) in enumerate(requests)}
    return _filled(q, found.select(CENTER_CODE, *[c.alias(k) for k, c in columns.items()]), {k: 0 for k in columns})


@variable("bus_stop_count", UNIT_CENTER, years=(2023,), radii=BufferSize)
def bus_stop_count(q: Request) -> DataFrame:
    return _count(q, "bus_stop_count")


@variable("rail_station_count", UNIT_CENTER, years=EVERY_FIVE, radii=BufferSize, remap=REMAP_2000)
def rail_station_count(q: Request) -> DataFrame:
    return _count(q, "rail_station_count")


@variable("clinic_count", UNIT_CENTER, years=EVERY_FIVE, radii=BufferSize)
def clinic_count(q: Request) -> DataFrame:
    return _count(q, "clinic_count")


@variable("hospital_count", UNIT_CENTER, years=EVERY_FIVE, radii=BufferSize)
def hospital_count(q: Request) -> DataFrame:
    return _count(q, "hospital_count")


# Nearest distances

DISTANCES = {
    # variable: (layer, column prefix, valid years, year remap, polygon layer)
    "bus_stop_distance": ("bus_stop", "D_Bus", (2023,), {}, False),
    "airport_distance": ("airport", "D_Airport", EVERY_FIVE, {}, False),
    "rail_distance": ("rail_seg", "D_Rail", EVERY_FIVE, REMAP_2000, False),
    "rail_station_distance": ("railstation", "D_Sub", EVERY_FIVE, REMAP_2000, False),
    "coastline_distance": ("coast_seg", "D_Coast", EVERY_FIVE, {}, False),
    "mdl_distance": ("mdl_seg", "D_North", EVERY_FIVE, {}, False),
    "port_distance": ("ports", "D_Port", EVERY_FIVE, {}, False),
    "mr1_distance": ("mr1_seg", "D_MR1", FROM_2005, {}, False),
    "mr2_distance": ("mr2_seg", "D_MR2", FROM_2005, {}, False),
    "road_distance": ("road_seg", "D_Road", FROM_2005, {}, False),
    "river_distance": ("river_edge", "D_River", EVERY_FIVE, {}, True),
}


def _register_distance(name: str, layer: str, prefix: str, years: tuple, remap: dict, areal: bool) -> None:
    @variable(name, UNIT_CENTER, years=years, remap=remap)
    def distance(q: Request) -> DataFrame:
        found = nearest(q.centers(), q.layers.at(layer, q.year), CENTER_CODE, areal=areal)
        return found.withColumnRenamed("distance", f"{prefix}_{q.year}")


for _name, _spec in DISTANCES.items():
    _register_distance(_name, *_spec)


def _facility_distance(q: Request, layer: str, name: str) -> DataFrame:
    alive = q.layers.get(layer).filter(open_by_year_prefix(q.year))
    return nearest(q.centers(), alive, CENTER_CODE).withColumnRenamed("distance", name)


@variable("clinic_distance", UNIT_CENTER, years=EVERY_FIVE)
def clinic_distance(q: Request) -> DataFrame:
    return _facility_distance(q, "clinics", f"D_Clinic_{q.year}")


@variable("hospital_distance", UNIT_CENTER, years=EVERY_FIVE)
def hospital_distance(q: Request) -> DataFrame:
    return _facility_distance(q, "hospitals", f"D_Hospital_{q.year}")


# Attributes of the county and of overlapped census units


@variable("car_mean", UNIT_CENTER, years=EVERY_FIVE)
def car_mean(q: Request) -> DataFrame:
    cars = q.layers.at("car_registration", q.year).select("sgg_cd", "value")
    return prefix_join(q.centers().select(CENTER_CODE), CENTER_CODE, cars, "sgg_cd").select(
        CENTER_CODE, F.col("value").alias("C_Car_sigungu_mean_registration")
    )


def intersection_areas(q: Request, mode: str = "border", exact: bool = False) -> DataFrame:
    """(center_reg_cd, border_reg_cd, area, zone_area) of every buffer and census unit that overlap.

    ``mode="buffer"`` takes the buffers of the other centroids as units, ``exact`` true circles as buffers.
    """
    shape = "disc" if exact else "poly32"
    centers = q.centers().select(CENTER_CODE, "x", "y")
    if mode == "buffer":
        pairs = buffer_overlaps(centers, q.radius, shape=shape)
        full = F.lit((math.pi if exact else 16 * math.sin(math.pi / 16)) * float(q.radius) ** 2)
        return pairs.select(
            F.col(CENTER_CODE).alias("center_reg_cd"), F.col("other").alias("border_reg_cd"), "area",
            full.alias("zone_area"),
        )
    edges, code = q.border()
    units = edges.withColumnRenamed(code, "border_reg_cd")
    overlap = buffer_areas(centers, units, ["border_reg_cd"], q.radius, shape=shape, blocks=False).filter(F.col("area") > 1e-6)
    sizes = border_measures(units, "border_reg_cd").select("border_reg_cd", F.col("area").alias("zone_area"))
    return overlap.join(sizes, "border_reg_cd").withColumnRenamed(CENTER_CODE, "center_reg_cd").select(
        "center_reg_cd", "border_reg_cd", "area", "zone_area"
    )


def _weighted(q: Request, table: str, columns: dict[str, str], total: str | None = None) -> DataFrame:
    census = q.layers.at(table, q.year).withColumnRenamed(CENTER_CODE, "border_reg_cd")
    if q.options.get("mode", "border") == "border":
        edges, code = q.border()
        known = edges.select(F.col(code).alias("border_reg_cd")).distinct()
        if census.join(known, "border_reg_cd", "left_semi").isEmpty():
            raise ValueError(f"No row of '{table}' belongs to a unit of border type '{q.border_type}'")
    overlap = q.options.get("overlaps")
    overlap = intersection_areas(q, q.options.get("mode", "border")) if overlap is None else overlap
    found = areal_weights(overlap, census, columns, "center_reg_cd", "border_reg_cd")
    found = found.withColumnRenamed("center_reg_cd", CENTER_CODE)
    return found.withColumn(total, row_total(list(columns.values()))) if total else found


# What the variables that read the overlap table take besides: other units, or a table made before.
OVERLAP = ("mode", "overlaps")
# Variables that read the overlap table.
WEIGHTED = ("business_registration_count", "business_employee_count", "house_type_count", "population")


def _fan(prefix: str, count: int, radius: int) -> dict[str, str]:
    return {f"v_{i:03d}": f"{prefix}_{i}_{_r4(radius)}" for i in range(1, count + 1)}


@variable("business_registration_count", UNIT_CENTER, years=EVERY_FIVE, radii=BufferSize, border="jgg", extras=OVERLAP)
def business_registration_count(q: Request) -> DataFrame:
    return _weighted(q, "sgis_bnu", _fan("B_bnu", 19, q.radius), f"B_bnu_{_r4(q.radius)}")


@variable("business_employee_count", UNIT_CENTER, years=EVERY_FIVE, radii=BufferSize, border="jgg", extras=OVERLAP)
def business_employee_count(q: Request) -> DataFrame:
    return _weighted(q, "sgis_bem", _fan("B_bem", 19, q.radius), f"B_bem_{_r4(q.radius)}")


@variable("house_type_count", UNIT_CENTER, years=EVERY_FIVE, radii=BufferSize, border="jgg", extras=OVERLAP)
def house_type_count(q: Request) -> DataFrame:
    return _weighted(q, "sgis_ho_gb", _fan("H_gb", 6, q.radius), f"H_gb_{_r4(q.radius)}")


@variable("population", UNIT_CENTER, years=EVERY_FIVE, radii=BufferSize, border="jgg", extras=OVERLAP)
def population(q: Request) -> DataFrame:
    r = _r4(q.radius)
    return _weighted(q, "sgis_pop", {"pop": f"POP_{r}", "pop_m": f"POP_M_{r}", "pop_f": f"POP_F_{r}"})


# Emissions


@variable("emission_vector", UNIT_CENTER, years=EVERY_FIVE, radii=EmissionBufferSize)
def emission_vector(q: Request) -> DataFrame:
    """Emissions of points, lines and areas that lie wholly inside the buffer."""
    amounts = {p: F.col(p) for p in POLLUTANTS}
    centers = q.centers()
    found = [
        buffer_points(centers, q.layers.at("emission_point", q.year), q.radius, amounts),
        buffer_holds(centers, q.layers.at("emission_line", q.year), q.radius, amounts),
        buffer_holds(centers, q.layers.at("emission_area", q.year), q.radius, amounts),
    ]
    filled = _filled(q, emission_sums(found, CENTER_CODE), {p: 0 for p in POLLUTANTS})
    suffix = str(q.radius).zfill(5)
    return filled.withColumnsRenamed({p: f"EM_{POLLUTANT_LABELS[p]}_{suffix}" for p in POLLUTANTS})


@variable(
    "emission_raster_value", UNIT_CENTER, years=EVERY_FIVE, radii=EmissionBufferSize,
    options={"emission_type": ("area", "line", "point"), "pollutant_type": tuple(POLLUTANTS)},
)
def emission_raster_value(q: Request) -> DataFrame:
    kind, pollutant = q.options["emission_type"], q.options["pollutant_type"]
    cells = q.layers.at("emission_cell", q.year).filter((F.col("emission_type") == kind) & (F.col("pollutant_type") == pollutant))
    return sample(q.centers(), mosaic(cells, load_order(cells)), q.raster("emission")).withColumnRenamed("val", f"EM_{kind}_{pollutant}_{q.year}")


# Line lengths in buffers


def _length(q: Request, layer: str, name: str, weight: str = "", lanes: bool = False) -> DataFrame:
    """Length, or length weighted by lanes or lanes x width, in the buffer."""
    segs = q.layers.at(layer, q.year)
    if lanes:
        lane = q.layers.at("road_lane", q.year).select(F.col("id").alias("original_id"), "lanes", "width")
        segs = lookup_join(segs.select("original_id", "x1", "y1", "x2", "y2"), lane, ["original_id"])
    weights = {"": F.lit(1.0), "lanes": F.col("lanes"), "surface": F.col("lanes") * F.col("width")}
    found = buffer_lines(q.centers(), segs, q.radius, {name: weights[weight].cast("double")})
    return _filled(q, found, {name: 0.0})


LENGTHS = {
    # variable: (layer, column prefix, valid years, weight, weight comes from the lane table)
    "road_length": ("road_seg", "road_l", EVERY_FIVE, "", False),
    "road_length_lane": ("road_seg", "road_ll", FROM_2005, "lanes", False),
    "road_length_lane_width": ("road_seg", "road_llw", TWO_LATEST, "surface", True),
    "mr1_length": ("mr1_seg", "MR1_L", EVERY_FIVE, "", False),
    "mr2_length": ("mr2_seg", "MR2_L", EVERY_FIVE, "", False),
    "mr1_length_lane": ("mr1_seg", "MR1_LL", EVERY_FIVE, "lanes", True),
    "mr2_length_lane": ("mr2_seg", "MR2_LL", EVERY_FIVE, "lanes", True),
    "mr1_length_lane_width": ("mr1_seg", "MR1_LLW", TWO_LATEST, "surface", True),
    "mr2_length_lane_width": ("mr2_seg", "MR2_LLW", TWO_LATEST, "surface", True),
}


def _register_length(name: str, layer: str, prefix: str, years: tuple, weight: str, lanes: bool) -> None:
    @variable(name, UNIT_CENTER, years=years, radii=BufferSize)
    def length(q: Request) -> DataFrame:
        return _length(q, layer, f"{prefix}_{_r4(q.radius)}", weight, lanes)


for _name, _spec in LENGTHS.items():
    _register_length(_name, *_spec)


# Vegetation


def _register_ndvi(statistic: str) -> None:
    prefix = "ndvi_y1_mm_" if statistic == "median" else "ndvi_y1_"

    @variable(f"ndvi_{statistic}", UNIT_CENTER, years=EVERY_FIVE, radii=NdviBufferSize, extras=("cellwise",))
    def ndvi(q: Request) -> DataFrame:
        name = f"{prefix}{statistic}_{_r4(q.radius)}"
        cells = q.layers.at("ndvi_cell", q.year).filter(F.col("statistic") == statistic)
        cells = mosaic(cells, load_order(cells))
        if statistic == "median":
            found = buffer_tile_mean(
                q.centers(), cells, q.raster("ndvi"), q.radius, cellwise=q.options.get("cellwise", False)
            ).withColumnRenamed("mean", name)
            return _filled(q, found, {name: 0.0})
        found = sample(q.centers(), cells, q.raster("ndvi"), outer=True)
        return found.select(CENTER_CODE, F.coalesce("val", F.lit(0.0)).alias(name))


for _name in ("mean", "median", "min", "max", "8mdn"):
    _register_ndvi(_name)


# Terrain around the centroid


@variable("relative_elevation", UNIT_CENTER, options={"layer": ("dem", "dsm"), "distance": (1000, 5000)})
def relative_elevation(q: Request) -> DataFrame:
    """Share of a 30 m wide ring lying 20 m or 50 m above or below the centroid."""
    distance = q.options["distance"]
    layer = q.options["layer"]
    shares = ring_shares(q.centers(), _elevation(q, layer), q.raster(layer), distance)
    names = [c for c in shares.columns if c != CENTER_CODE]
    return shares.select(
        F.substring(CENTER_CODE, 1, 5).alias("sgg_cd"), CENTER_CODE, *[F.col(c).alias(f"{c}_{distance}") for c in names]
    )


# Land use


@variable("landuse", UNIT_CENTER, years=EVERY_FIVE, radii=BufferSize, extras=("exact",))
def landuse(q: Request) -> DataFrame:
    """Area of each land-use code in the buffer over the area of the full circle; ``exact`` takes the circle as buffer too."""
    polys = q.layers.version("landuse_edge", q.year, {2020: "v004"}, "v002").filter(F.col("code").isin(LANDUSE_CODES))
    found = buffer_areas(q.centers(), polys, ["code"], q.radius, shape="disc" if q.options.get("exact") else "poly32")
    wide = found.groupBy(CENTER_CODE).pivot("code", LANDUSE_CODES).agg(F.sum("area"))
    joined = q.centers().select(CENTER_CODE).join(wide, CENTER_CODE, "left")
    circle = F.lit(math.pi * q.radius * q.radius)
    return joined.select(
        CENTER_CODE,
        *[(F.coalesce(F.col(str(c)), F.lit(0.0)) / circle).alias(f"LS{c}_{_r4(q.radius)}") for c in LANDUSE_CODES],
    )
