"""Layers by name and year.

A layer is one table for all years; asking for a year filters on the ``year`` column, which
prunes partitions when the table is stored ``partitionBy("year")``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class BorderType(Enum):
    sgg = "sgg"
    emd = "emd"
    jgg = "jgg"


# Code and name columns of each border layer, the one year of census grid borders, pollutants.
BORDER_COLUMNS = {
    "sgg": ("sigungu_cd", "sigungu_nm"),
    "emd": ("adm_dr_cd", "adm_dr_nm"),
    "jgg": ("tot_reg_cd", "tot_reg_cd"),
}
GRID_YEAR = 2023
POLLUTANTS = ["co", "nox", "nh3", "voc", "pm10", "sox", "tsp"]


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_XY = {"x": _D, "y": _D}
_EDGE = {"x1": _D, "y1": _D, "x2": _D, "y2": _D}
_FEATURE = {"fid": _L, "year": _I}
_EMISSION = {p: _D for p in POLLUTANTS}

SCHEMAS = {
    "centers": _schema(tot_reg_cd=_S, **_XY),
    "bus_stop": _schema(id=_L, year=_I, **_XY),
    "railstation": _schema(id=_L, year=_I, **_XY),
    "hospitals": _schema(id=_L, date=_S, date_c=_S, operation=_I, **_XY),
    "clinics": _schema(id=_L, date=_S, date_c=_S, operation=_I, **_XY),
    "airport": _schema(name=_S, year=_I, **_XY),
    "ports": _schema(alias=_S, year=_I, **_XY),
    "road_seg": _schema(original_id=_L, lanes=_L, width=_D, **_FEATURE, **_EDGE),
    "rail_seg": _schema(original_id=_L, **_FEATURE, **_EDGE),
    "mr1_seg": _schema(original_id=_L, **_FEATURE, **_EDGE),
    "mr2_seg": _schema(original_id=_L, **_FEATURE, **_EDGE),
    "road_lane": _schema(id=_L, lanes=_L, width=_D, year=_I),
    "coast_seg": _schema(seg=_I, **_FEATURE, **_EDGE),
    "mdl_seg": _schema(seg=_I, **_FEATURE, **_EDGE),
    "landuse_edge": _schema(code=_I, version=_S, seg=_I, **_FEATURE, **_EDGE),
    "river_edge": _schema(seg=_I, **_FEATURE, **_EDGE),
    "border_edge": _schema(sigungu_cd=_S, sigungu_nm=_S, seg=_I, year=_I, **_EDGE),
    "border_edge_emd": _schema(adm_dr_cd=_S, adm_dr_nm=_S, seg=_I, year=_I, **_EDGE),
    "border_edge_jgg": _schema(tot_reg_cd=_S, seg=_I, year=_I, **_EDGE),
    "car_registration": _schema(sgg_cd=_S, year=_I, value=_L),
    "emission_point": _schema(id=_L, year=_I, **_XY, **_EMISSION),
    "emission_line": _schema(**_FEATURE, **_EMISSION, **_EDGE),
    "emission_area": _schema(**_FEATURE, **_EMISSION, seg=_I, **_EDGE),
    "raster_cell": _schema(layer=_S, rid=_L, col=_I, row=_I, val=_D),
    "ndvi_cell": _schema(statistic=_S, year=_I, rid=_L, col=_I, row=_I, val=_D),
    "emission_cell": _schema(emission_type=_S, pollutant_type=_S, year=_I, rid=_L, col=_I, row=_I, val=_D),
}

FORMATS = ["parquet", "csv", "orc", "json"]


def read_layer(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One layer with the columns of its fixed schema that the files have; coordinates are EPSG:5179 metres."""
    if fmt not in FORMATS:
        raise ValueError(f"Unknown format '{fmt}'. Valid formats are: {', '.join(FORMATS)}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if name not in SCHEMAS:
        return reader.load(path)
    there = {c.lower() for c in reader.load(path).columns}
    kept = [f for f in SCHEMAS[name].fields if f.name.lower() in there]
    if fmt == "csv":
        # Text columns follow the order of the header; those of the schema get its types.
        loaded = reader.load(path)
        return loaded.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kept])
    return reader.schema(T.StructType(kept)).load(path)


class Layers:
    """Layer tables behind one resolver, which maps a layer name to a DataFrame.

    A layer without a ``year`` (or ``version``) column is refused where one is asked for, unless it is named in
    ``timeless`` (``unversioned``): then it holds for all of them.
    """

    def __init__(self, resolve: Callable[[str], DataFrame], timeless: Iterable[str] = (), unversioned: Iterable[str] = ()):
        self._resolve, self._timeless, self._unversioned = resolve, frozenset(timeless), frozenset(unversioned)

    @classmethod
    def from_folder(cls, spark: SparkSession, root: str, fmt: str = "parquet", **stamps: Iterable[str]) -> Layers:
        return cls(lambda name: read_layer(spark, f"{root.rstrip('/')}/{name}", name, fmt), **stamps)

    @classmethod
    def from_tables(cls, spark: SparkSession, prefix: str = "", **stamps: Iterable[str]) -> Layers:
        return cls(lambda name: spark.table(f"{prefix}{name}"), **stamps)

    @classmethod
    def from_frames(cls, frames: dict[str, DataFrame], **stamps: Iterable[str]) -> Layers:
        return cls(lambda name: frames[name], **stamps)

    def get(self, name: str) -> DataFrame:
        return self._resolve(name)

    def at(self, name: str, year: int) -> DataFrame:
        return self._stamped(name, self.get(name), "year", year, self._timeless)

    def _stamped(self, name: str, df: DataFrame, column: str, value: int | str, exempt: frozenset[str]) -> DataFrame:
        if column in df.columns:
            return df.filter(F.col(column) == value)
        if name not in exempt:
            raise ValueError(f"Layer '{name}' has no column '{column}'")
        return df

    def version(self, name: str, year: int, versions: dict[int, str], default: str) -> DataFrame:
        """Layers kept in several versions: the version in force for a year."""
        return self._stamped(name, self.at(name, year), "version", versions.get(year, default), self._unversioned)

    def border(self, border_type: str, year: int) -> tuple[DataFrame, str]:
        """Edges of a border layer and its code column.  Census grid borders have one fixed year."""
        kind = BorderType(border_type).value
        name = "border_edge" if kind == "sgg" else f"border_edge_{kind}"
        return self.at(name, GRID_YEAR if kind == "jgg" else year), BORDER_COLUMNS[kind][0]
