"""Variables for user-supplied coordinates: true discs around each point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.facilities import open_by_year_prefix
from ..functions.projection import to_metric
from ..operators.buffers import buffer_points
from .registry import EVERY_FIVE, POINT_ID, UNIT_POINT, BufferSize, Request, variable


def _count(q: Request, layer: DataFrame, name: str) -> DataFrame:
    """Points keep their own coordinates in the result; counting happens in metres."""
    given = q.units
    metric = to_metric(given.select(POINT_ID, "x", "y"), q.options.get("srid", 4326))
    found = buffer_points(metric, layer, q.radius, {name: F.lit(1)}, POINT_ID, shape="disc")
    joined = given.join(found, POINT_ID, "left")
    return joined.select(*given.columns, F.coalesce(F.col(name), F.lit(0)).alias(name))


@variable("custom_bus_stop_count", UNIT_POINT, years=(2023,), radii=BufferSize, extras=("srid",))
def custom_bus_stop_count(q: Request) -> DataFrame:
    return _count(q, q.layers.at("bus_stop", q.year), f"C_Bus_{str(q.radius).zfill(4)}")


@variable("custom_hospital_count", UNIT_POINT, years=EVERY_FIVE, radii=BufferSize, extras=("srid",))
def custom_hospital_count(q: Request) -> DataFrame:
    alive = q.layers.get("hospitals").filter(open_by_year_prefix(q.year))
    return _count(q, alive, f"C_Hospital_{q.year}_{str(q.radius).zfill(4)}")


# Calculators that a coordinate file may ask for by name.
FILE_CALCULATORS = {"bus_stop": "custom_bus_stop_count", "hospital": "custom_hospital_count"}


def file_calculator(name: str) -> str:
    if name not in FILE_CALCULATORS:
        raise ValueError(f"Unknown calculator type: {name}")
    return FILE_CALCULATORS[name]
