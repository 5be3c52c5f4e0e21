"""Spatial indexes as tables: made once, joined by later jobs without moving them.

Overlap areas are bucketed by the unit whose figures they weigh, polygon tiles by grid cell. A join on those columns
reads the buckets as they lie and shuffles only the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..grid import CELL
from ..operators.overlay import Tiles

# Buckets of an index unless told otherwise: at least as many as the shuffle partitions of the jobs that use it.
BUCKETS = 64

SIZE, KEY, EDGES = "terracell.size", "terracell.key", "terracell.edges"


def _store(df: DataFrame, name: str, by: list[str], buckets: int, path: str | None) -> None:
    # Dealt by bucket first, so that a bucket is one file, not one from every task.
    writer = df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def store_overlaps(overlaps: DataFrame, name: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Keep an overlap table (center_reg_cd, border_reg_cd, area, zone_area) and read it back.

    Hand it to any census variable of the same units and radius as ``overlaps``.
    """
    _store(overlaps, name, ["border_reg_cd"], buckets, path)
    return overlaps.sparkSession.table(name)


def store_tiles(tiles: Tiles, name: str, buckets: int = BUCKETS, path: str | None = None) -> Tiles:
    """Keep the tiles of a polygon layer and read them back; see :func:`load_tiles`."""
    spark = tiles.rows.sparkSession
    _store(tiles.rows, name, CELL, buckets, path and f"{path}/tiles")
    _store(tiles.shape, f"{name}_edges", tiles.key, buckets, path and f"{path}/edges")
    told = {SIZE: repr(tiles.size), KEY: ",".join(tiles.key), EDGES: tiles.edges}
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f"'{k}' = '{v}'" for k, v in told.items())})")
    return load_tiles(spark, name)


def load_tiles(spark: SparkSession, name: str) -> Tiles:
    """Stored tiles, to be handed to border variables of the same border layer as ``tiles``."""
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if SIZE not in told:
        raise ValueError(f"Table '{name}' holds no tiles")
    return Tiles(spark.table(name), told[KEY].split(","), float(told[SIZE]), spark.table(f"{name}_edges"), int(told[EDGES]))
