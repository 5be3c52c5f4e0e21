"""Coordinate files scored as one job, or as they arrive."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.points import file_calculator
from ..plans.registry import compute
from ..sources.layers import Layers
from ..sources.points import normalize_xy, read_points_csv, validate_xy


def score_points(layers: Layers, points: DataFrame, calculator: str, **args: Any) -> DataFrame:
    """Counts around every point of any number of points, as one plan.

    ``points`` has ``point_id, x, y`` and any further columns.
    """
    return compute(layers, file_calculator(calculator), units=points, **args)


def score_csv(
    spark: SparkSession, layers: Layers, path: str, calculator: str, totals: Observation | None = None, **args: Any
) -> tuple[DataFrame, DataFrame]:
    """Counts for coordinate files and their rejected rows.  ``point_id`` is the row's number in the file, and goes on
    through further files in order of path.  ``totals`` learns the numbers of rows and rejects on the way."""
    good, rejects = validate_xy(read_points_csv(spark, path), totals)
    points = good.withColumnRenamed("row_no", "point_id")
    return score_points(layers, points.select("point_id", "x", "y"), calculator, **args), rejects


# One row for each batch of a stream.
PROGRESS = "batch long, rows long, rejects long, scored long, seconds double"


def progress_of(spark: SparkSession, output: str) -> DataFrame:
    """What each finished batch of :func:`score_stream` came to; a batch repeated after a failure has one row."""
    return spark.read.schema(PROGRESS).parquet(f"{output}/progress").select("batch", "rows", "rejects", "scored", "seconds")


def score_stream(
    spark: SparkSession,
    layers: Layers,
    folder: str,
    schema: str,
    calculator: str,
    output: str,
    checkpoint: str,
    available_now: bool = True,
    files_per_batch: int | None = None,
    on_batch: Callable[[dict[str, Any]], None] | None = None,
    **args: Any,
) -> StreamingQuery:
    """Score new CSV files in a folder as they arrive.

    A count depends on its own point only, so batches share no state.  A point is told apart by its place in
    the batch's files; the columns of the file, repeated ids among them, go through to ``output/scored``, and rows that are
    no coordinates to ``output/rejects``.  Each batch replaces its own partitions, so a batch repeated
    after a failure leaves no duplicates.

    The numbers of rows, rejects and scored points are observed while a batch is written. They go to
    ``output/progress`` last, so a batch that stands there is complete, and to ``on_batch``; ``files_per_batch`` makes
    batches of a long job small enough to follow it.
    """
    reader = spark.readStream.schema(schema).option("header", True)
    raw = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).csv(folder)
    source = normalize_xy(raw.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start")))

    def write(rows: DataFrame, kind: str, batch_id: int) -> None:
        kept = rows.withColumn("batch", F.lit(batch_id))
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{output}/{kind}")

    def score(batch: DataFrame, batch_id: int) -> None:
        begun, seen, made = time.monotonic(), Observation(), Observation()
        good, rejects = validate_xy(batch, seen)
        # The same files are split the same way whenever the batch is read again.
        points = good.withColumn("point_id", F.xxhash64("_path", "_start", F.monotonically_increasing_id())).drop("_path", "_start")
        scored = score_points(layers, points, calculator, **args)
        write(scored.observe(made, F.count(F.lit(1)).alias("scored")), "scored", batch_id)
        write(rejects.drop("_path", "_start"), "rejects", batch_id)
        totals = {"batch": batch_id, **seen.get, **made.get, "seconds": time.monotonic() - begun}
        row = spark.createDataFrame([tuple(totals[c] for c in ("batch", "rows", "rejects", "scored", "seconds"))], PROGRESS)
        row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{output}/progress")
        if on_batch:
            on_batch(totals)

    writer = source.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
