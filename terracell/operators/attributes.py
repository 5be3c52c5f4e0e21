"""Joins and aggregates on attribute tables: code prefixes, areal weighting, merges, checks."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..grid import cell_join
from .quantiles import column_quantiles

# A lookup table is broadcast only when it has no more rows than this.
BROADCAST_ROWS = 200_000


def lookup_join(df: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join each row of ``df`` with its row in a lookup table, whatever the skew of the key.

    A table counted to be small is broadcast.  A larger one is joined by shuffle, with the rows
    of crowded keys split over several tasks.
    """
    if _is_small(table):
        return df.join(F.broadcast(table), on, how)
    if how != "inner":
        matched = table.select(*on).distinct().withColumn("_known", F.lit(True))
        missing = [f.name for f in table.schema.fields if f.name not in on]
        lone = df.join(matched, on, "left_anti")
        for name in missing:
            lone = lone.withColumn(name, F.lit(None).cast(table.schema[name].dataType))
        return lookup_join(df, table, on).unionByName(lone)
    peak = df.groupBy(*on).count().agg(F.max("count")).first()[0] or 0
    return cell_join(df, table, on, left_peak=peak)


def _is_small(table: DataFrame) -> bool:
    return table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def prefix_join(units: DataFrame, code: str, table: DataFrame, prefix: str, length: int = 5) -> DataFrame:
    """Attributes of the county whose code starts the unit's code (units without are dropped)."""
    keyed = units.withColumn(prefix, F.substring(F.col(code).cast("string"), 1, length))
    return lookup_join(keyed, table.withColumn(prefix, F.col(prefix).cast("string")), [prefix])


def areal_weights(overlaps: DataFrame, table: DataFrame, columns: dict[str, str], unit: str, zone: str) -> DataFrame:
    """Attribute totals per unit, each zone counted by the share of its area inside the unit's buffer.

    ``overlaps`` has (unit, zone, area, zone_area); ``columns`` maps attribute to output name.
    All columns are weighted in one aggregation.
    """
    weight = F.col("area") / F.col("zone_area")
    joined = lookup_join(overlaps, table.select(zone, *columns), [zone], "left")
    return joined.groupBy(unit).agg(
        *[F.coalesce(F.sum(F.col(c).cast("double") * weight), F.lit(0.0)).alias(n) for c, n in columns.items()]
    )


def row_total(columns: list[str]) -> Column:
    return reduce(add, [F.col(c) for c in columns])


def fill_units(units: DataFrame, result: DataFrame, unit: str, fill: dict[str, float | int]) -> DataFrame:
    """All units with their result columns, empty ones filled (LEFT JOIN + COALESCE)."""
    joined = units.select(unit).join(result, unit, "left")
    return joined.select(unit, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in fill.items()])


def merge_by_id(frames: list[DataFrame], id_column: str) -> DataFrame:
    """Full outer merge of result frames on the unit code, id first.

    Frames are joined in pairs, then pairs of pairs, so no wide intermediate is shuffled over
    and over.
    """
    if not frames:
        raise ValueError("No frames to merge")
    level = list(frames)
    while len(level) > 1:
        level = [
            level[i].join(level[i + 1], id_column, "full") if i + 1 < len(level) else level[i]
            for i in range(0, len(level), 2)
        ]
    merged = level[0]
    return merged.select(id_column, *[c for c in merged.columns if c != id_column])


def number_in_order(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Rows numbered from 1 in a total order, without gathering them: ranges are sorted in their own tasks, and
    one row for each range tells how many come before it."""
    part, place = F.spark_partition_id(), F.monotonically_increasing_id()
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": part, "_at": place})
    ranges = ranges.withColumn("_at", F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33)).checkpoint()
    counts = sorted((r["_part"], r["count"]) for r in ranges.groupBy("_part").count().collect())
    parts, sizes = [p for p, _ in counts], [n for _, n in counts]
    before = zip(parts, accumulate([0, *sizes]))
    offsets = df.sparkSession.createDataFrame(list(before), "_part int, _before long")
    return ranges.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def negative_values(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Rows breaking the rule that counts are not negative, one per offending column."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(*key, F.explode(entries).alias("_e")).select(*key, "_e.column", "_e.value")
    return long.filter(F.col("value") < 0)


def missing_units(units: DataFrame, table: DataFrame, unit: str) -> DataFrame:
    """Units without any row in an attribute table."""
    return units.select(unit).join(table.select(unit), unit, "left_anti")


def code_year_summary(table: DataFrame, key: list[str], value: str) -> DataFrame:
    return table.groupBy(*key).agg(F.avg(value).alias(f"avg_{value}"), F.max(value).alias(f"max_{value}"))


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, least value, quartiles and greatest value, one row per column."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns])
    long = df.select(F.explode(entries).alias("_e")).select("_e.column", "_e.v")
    simple = long.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    parts = [0.25, 0.5, 0.75]
    quarters = column_quantiles(df, columns, parts).withColumnsRenamed({f"q{i}": f"{p:.0%}" for i, p in enumerate(parts)})
    return simple.join(quarters, "column", "left").select("column", "count", "mean", "std", "min", *[f"{p:.0%}" for p in parts], "max")
