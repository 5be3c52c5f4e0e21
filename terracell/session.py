"""Session settings that suit geometry jobs: few bytes, much arithmetic per row."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that may change while a session runs.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Candidate pairs are made after the shuffle, so partitions small in bytes are not small in
    # work: let them be merged only down to one per core, not up to the default of 1 MB.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    # The JVM never compiles methods above 8000 bytes; split generated code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings fixed when a session starts.
STATIC = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", checkpoint_dir: str | None = None, **conf: str) -> SparkSession:
    """A session on this machine for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("terracell")
    for key, value in {**STATIC, **RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a session whose executors run on this machine may do without: it gets a folder of its own here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="terracell-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    context = spark.sparkContext
    if getattr(context, "_terracell_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="terracell-")) / "terracell.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._terracell_shipped = True
