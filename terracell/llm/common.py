"""What the corpus operators share: scratch tables, words, and blocks of texts inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.session import scratch_root

# Words of the contracts: runs of characters other than the six ASCII white spaces. bytes.split() makes the same.
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text that one step inside a task handles at once.
BLOCK = 2 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared one."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """The rows written as a table in the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstash(df: DataFrame) -> None:
    """Delete a stashed table that no later plan reads."""
    spark = df.sparkSession
    root = scratch_root(spark).rstrip("/").removeprefix("file://").removeprefix("file:")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.removeprefix("file://").removeprefix("file:").startswith(root + "/"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_blocks(batches: Iterator[pa.RecordBatch], text: int = 1, limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches cut into pieces of few bytes, each with its texts as UTF-8 (null: empty). A longer text comes alone."""
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        begin, size = 0, 0
        for i in range(batch.num_rows):
            if size >= limit:
                yield batch.slice(begin, i - begin), [x or b"" for x in column.slice(begin, i - begin).to_pylist()]
                begin, size = i, 0
            item = column[i]
            size += len(item.as_buffer()) if item.is_valid else 0
        if begin < batch.num_rows:
            yield batch.slice(begin), [x or b"" for x in column.slice(begin).to_pylist()]
