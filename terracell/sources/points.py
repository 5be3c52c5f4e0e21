"""User coordinates: CSV files and inline lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

# Accepted column names, in any letter case.
X_NAMES = ["x", "lon", "longitude", "long", "lng"]
Y_NAMES = ["y", "lat", "latitude"]


def detect_xy(columns: list[str]) -> tuple[str, str]:
    """The columns that hold x and y."""

    def pick(names: list[str]) -> str:
        for c in columns:
            if c.strip().lower() in names:
                return c
        raise ValueError(f"No coordinate column found among {columns}. Accepted names are: {', '.join(names)}")

    return pick(X_NAMES), pick(Y_NAMES)


def normalize_xy(df: DataFrame) -> DataFrame:
    x, y = detect_xy(df.columns)
    return df.withColumnsRenamed({x: "x", y: "y"})


def read_points_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, coordinates named x and y, rows numbered from 1 on through all files in order of path."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    return normalize_xy(number_rows(raw))


def number_rows(df: DataFrame) -> DataFrame:
    """Add ``row_no``: position of a row in its files, for splittable text files of any size and number.

    Rows of one file block are consecutive in one task; the blocks' row counts, a table with one row per
    block, give each block its offset in its file, and each file its offset after the files before it.
    """
    tagged = df.withColumn("_file", F.col("_metadata.file_path")).withColumn(
        "_block", F.col("_metadata.file_block_start")
    ).withColumn("_id", F.monotonically_increasing_id())
    blocks = tagged.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = Window.unboundedPreceding
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(first, -1)
    files = blocks.groupBy("_file").agg(F.sum("_n").alias("_rows"))
    earlier = Window.orderBy("_file").rowsBetween(first, -1)
    files = files.select("_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    offsets = blocks.withColumn("_in_file", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(files, "_file")
    offsets = offsets.select("_file", "_block", "_first", (F.col("_start") + F.col("_in_file")).alias("_offset"))
    return (
        tagged.join(offsets, ["_file", "_block"])
        .withColumn("row_no", F.col("_id") - F.col("_first") + F.col("_offset") + 1)
        .select("row_no", *df.columns)
    )


def _number(name: str) -> Column:
    return F.expr(f"try_cast(trim(`{name}`) as double)")


def validate_xy(points: DataFrame, totals: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into rows with numeric coordinates (as doubles) and rejects (as read).

    ``totals`` learns the numbers of ``rows`` and ``rejects`` from the first action on either, without a pass of its own.
    """
    x, y = _number("x"), _number("y")
    finite = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y) & (F.abs(x) < F.lit(float("inf"))) & (
        F.abs(y) < F.lit(float("inf"))
    )
    ok = F.coalesce(finite, F.lit(False))
    if totals is not None:
        points = points.observe(totals, F.count(F.lit(1)).alias("rows"), F.count_if(~ok).alias("rejects"))
    good = points.filter(ok).withColumns({"x": x, "y": y})
    return good, points.filter(~ok)


def points_from_list(spark: SparkSession, coords: list[list[float]]) -> DataFrame:
    """Inline request coordinates, numbered from 1 in input order."""
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(coords, 1)]
    return spark.createDataFrame(rows, "point_id bigint, x double, y double")


def points_from_arrays(df: DataFrame, coords: str, keep: list[str]) -> DataFrame:
    """The same for a column holding coordinate lists, one request per row."""
    return df.select(*keep, F.posexplode(coords).alias("_pos", "_xy")).select(
        *keep,
        (F.col("_pos") + 1).cast("long").alias("point_id"),
        F.element_at("_xy", 1).alias("x"),
        F.element_at("_xy", 2).alias("y"),
    )
