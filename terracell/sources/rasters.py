"""Loading emission rasters: metadata from file names, idempotent partitioned writes, reports."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = ["year", "emission_type", "pollutant_type"]

# Naming convention of the emission raster files.
DIRECTORY = r"(?:^|/)([0-9]{4})_emission/[^/]*$"
KIND = r"emission\.([pla])\."
KIND_NAMES = {"p": "point", "l": "line", "a": "area"}
POLLUTANT_PATTERNS = [
    r"emission\.[pla]\.([a-zA-Z0-9_]+)\.tif$",
    r"emission\.[pla]\.[0-9]{4}_([a-zA-Z0-9_]+)\.tif$",
    r"emission\.[pla]\.[0-9]{4}_([a-zA-Z0-9_]+)_",
    r"emission\.[pla]\.([a-zA-Z0-9_]+)\.",
]
YEAR_PREFIX = r"^[0-9]{4}_(.+)$"


def _found(text: Column, pattern: str) -> Column:
    hit = F.regexp_extract(text, pattern, 1)
    return F.when(hit != "", hit)


def with_raster_meta(files: DataFrame, path: str = "path") -> DataFrame:
    """Add filename, year (of the directory), emission_type and pollutant_type from a file path.

    The first pollutant pattern that matches counts; names that match none are "unknown".
    """
    name = F.element_at(F.split(F.col(path), "/"), -1)
    kind = _found(name, KIND)
    kinds = F.create_map(*[F.lit(v) for pair in KIND_NAMES.items() for v in pair])
    pollutant = F.coalesce(*[_found(name, p) for p in POLLUTANT_PATTERNS], F.lit("unknown"))
    return (
        files.withColumn("filename", name)
        .withColumn("year", _found(F.col(path), DIRECTORY).cast("int"))
        .withColumn("emission_type", F.coalesce(F.element_at(kinds, kind), F.lit("unknown")))
        .withColumn("pollutant_type", F.regexp_replace(pollutant, YEAR_PREFIX, "$1"))
    )


# A raster store: data/<load>/year=../emission_type=../pollutant_type=.. holds the cells of each load, manifest/<number> names,
# for one state of the store, the load that each partition is read from.
MANIFEST, DATA = "manifest", "data"


def _states(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed states; one without its success mark was never finished."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(root):
        return []
    found = [f.getPath() for f in files.listStatus(root)]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName()) for p in done)


def _manifest(spark: SparkSession, path: str, state: int | None) -> DataFrame | None:
    states = _states(spark, path)
    if state is not None and state not in states:
        raise ValueError(f"No state {state} in the raster store. Its states are: {', '.join(map(str, states))}")
    if not states:
        return None
    return spark.read.parquet(f"{path}/{MANIFEST}/{states[-1] if state is None else state:08d}")


def read_raster(spark: SparkSession, path: str, state: int | None = None) -> DataFrame:
    """The cells of the store as its latest committed state, or an earlier one, has them.

    The manifest has one row for each partition. A reader that began before a reload goes on with the files it began with.
    """
    manifest = _manifest(spark, path, state)
    if manifest is None:
        raise ValueError(f"No raster store at '{path}'")
    loads: dict[str, list[str]] = {}
    for r in manifest.collect():
        loads.setdefault(r["load"], []).append("/".join(f"{c}={r[c]}" for c in PARTITIONS))
    frames = [
        spark.read.option("basePath", f"{path}/{DATA}/{load}").parquet(*[f"{path}/{DATA}/{load}/{p}" for p in sorted(parts)])
        for load, parts in sorted(loads.items())
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def write_raster(spark: SparkSession, cells: DataFrame, path: str, first: bool = False) -> int:
    """Add cells to the raster store; files loaded before are replaced. Returns the number of the new state.

    The partitions that the new files fall into are written anew beside the old ones, others are left alone. The
    manifest comes last and counts only when complete, so a load that dies half-way leaves the store as it was. Of two
    loads at once the second to finish fails.
    """
    cells = cells.select(*[c for c in cells.columns if c not in PARTITIONS], *PARTITIONS)
    states = _states(spark, path)
    if first == bool(states):
        raise ValueError(f"Raster store '{path}' {'exists' if first else 'does not exist'}")
    old = None
    if not first:
        touched = cells.select(*PARTITIONS).distinct()
        kept = read_raster(spark, path).join(touched, PARTITIONS, "left_semi").join(
            cells.select("filename", *PARTITIONS).distinct(), ["filename", *PARTITIONS], "left_anti"
        )
        cells = kept.select(*cells.columns).unionByName(cells)
        old = _manifest(spark, path, states[-1])
    load = uuid.uuid4().hex
    # A task sorts all that it writes by partition. Dealt by partition first, and evened out by size, none gets more for a larger input.
    cells.hint("rebalance", *PARTITIONS).write.partitionBy(*PARTITIONS).parquet(f"{path}/{DATA}/{load}")
    written = spark.read.parquet(f"{path}/{DATA}/{load}").select(*PARTITIONS).distinct()
    rows = written.withColumn("load", F.lit(load))
    if old is not None:
        rows = rows.unionByName(old.join(written, PARTITIONS, "left_anti"))
    state = states[-1] + 1 if states else 1
    rows.coalesce(1).write.parquet(f"{path}/{MANIFEST}/{state:08d}")
    return state


def drop_states(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Forget all but the last ``keep`` states and delete the loads that none of those reads; returns the loads deleted."""
    states = _states(spark, path)
    rows = [_manifest(spark, path, s).select("load") for s in states[-keep:]]
    used = {r["load"] for r in reduce(lambda a, b: a.union(b), rows).distinct().collect()} if rows else set()
    there = spark._jvm.org.apache.hadoop.fs.Path
    files = there(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for s in states[:-keep]:
        files.delete(there(f"{path}/{MANIFEST}/{s:08d}"), True)
    unused = [f.getPath() for f in files.listStatus(there(f"{path}/{DATA}")) if f.getPath().getName() not in used]
    for p in unused:
        files.delete(p, True)
    return [p.getName() for p in unused]


def load_report(files: DataFrame, stored: DataFrame) -> DataFrame:
    """``.tif`` files loaded and failed per emission directory; directories without a year are skipped.

    A file is loaded if ``stored(path)`` has it; a name that tells no type or pollutant does not fail it.
    """
    tifs = files.filter(F.col("year").isNotNull() & F.col("filename").endswith(".tif"))
    there = stored.select("path").distinct().withColumn("_there", F.lit(True))
    ok = F.col("_there").isNotNull()
    return tifs.join(there, "path", "left").groupBy("year").agg(F.count_if(ok).alias("loaded"), F.count_if(~ok).alias("failed"))
