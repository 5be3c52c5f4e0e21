"""Writing results: JSON records, CSV, Parquet, tables; and previews."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.session import scratch_root

FORMATS = ["json", "csv", "parquet"]


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    if fmt not in FORMATS:
        raise ValueError(f"Unknown format '{fmt}'. Valid formats are: {', '.join(FORMATS)}")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_table(df: DataFrame, table: str, append: bool = True, path: str | None = None) -> None:
    """Append to a table, or make it; a new table's files lie under ``path`` if given."""
    writer = df.write.mode("append" if append else "errorifexists")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_sorted(df: DataFrame, path: str, order: list[Column | str], fmt: str = "parquet") -> None:
    """Files whose rows, read in order of file name, are in order; no task sorts more than its range."""
    write_result(df.repartitionByRange(*order).sortWithinPartitions(*order), path, fmt)


def to_records(df: DataFrame) -> DataFrame:
    """One JSON record per row."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("record"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the session names for checkpoints."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
