"""Measures of zones and features: area, centroid, length, extent, ring orientation, validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import segment_length
from ..grid import cell_join, measure_density
from .overlay import zone_origins
from .segments import split_at_grid


def border_measures(edges: DataFrame, key: str) -> DataFrame:
    """Area, centroid (x, y) and bounding box per zone, in one grouped pass."""
    c = F.col
    local = edges.join(zone_origins(edges, [key]), key).select(
        key, "ox", "oy",
        (c("x1") - c("ox")).alias("ax"), (c("y1") - c("oy")).alias("ay"),
        (c("x2") - c("ox")).alias("bx"), (c("y2") - c("oy")).alias("by"),
    ).withColumn("cross", c("ax") * c("by") - c("bx") * c("ay"))
    sums = local.groupBy(key).agg(
        F.sum("cross").alias("s"),
        F.sum((c("ax") + c("bx")) * c("cross")).alias("sx"),
        F.sum((c("ay") + c("by")) * c("cross")).alias("sy"),
        F.min("ox").alias("min_x"), F.min("oy").alias("min_y"),
        F.max(c("ax") + c("ox")).alias("max_x"), F.max(c("ay") + c("oy")).alias("max_y"),
    )
    return sums.select(
        key,
        (c("s") / 2).alias("area"),
        (c("min_x") + c("sx") / (c("s") * 3)).alias("x"),
        (c("min_y") + c("sy") / (c("s") * 3)).alias("y"),
        "min_x", "min_y", "max_x", "max_y",
    )


def line_lengths(segs: DataFrame, key: list[str]) -> DataFrame:
    return segs.groupBy(*key).agg(
        F.sum(segment_length(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))).alias("length")
    )


def orient_rings(edges: DataFrame, key: list[str], ring: str = "ring") -> DataFrame:
    """Turn rings so that the interior is on the left: ring 0 counter-clockwise, holes clockwise.

    Shapefile extracts store them the other way round.
    """
    ids = [*key, ring]
    origins = edges.groupBy(*ids).agg(F.min("x1").alias("ox"), F.min("y1").alias("oy"))
    c = F.col
    cross = (c("x1") - c("ox")) * (c("y2") - c("oy")) - (c("x2") - c("ox")) * (c("y1") - c("oy"))
    turn = edges.join(origins, ids).groupBy(*ids).agg(F.sum(cross).alias("_turn"))
    wrong = F.when(c(ring) == 0, c("_turn") < 0).otherwise(c("_turn") > 0)
    swap = {"x1": "x2", "y1": "y2", "x2": "x1", "y2": "y1"}
    fixed = edges.join(turn, ids)
    return fixed.select(
        *[
            (F.when(wrong, c(swap[n])).otherwise(c(n)).alias(n) if n in swap else c(n))
            for n in edges.columns
        ]
    )


def invalid_rings(edges: DataFrame, key: list[str], size: float = 250.0) -> DataFrame:
    """Bad rings with reasons: open, fewer than three edges, zero-length edge, self-crossing (or touching itself).

    Edges carry their position ``seg``.  Crossings are looked for cell by cell among pieces of
    the same ring only.
    """
    c = F.col
    counts = edges.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(((c("x1") == c("x2")) & (c("y1") == c("y2"))).cast("int")).alias("_zero"),
    )
    # A closed ring leaves every corner as often as it arrives there.
    start, end = (F.struct(c(a).alias("x"), c(b).alias("y"), F.lit(n).alias("d")) for a, b, n in
                  (("x1", "y1", 1), ("x2", "y2", -1)))
    unbalanced = (
        edges.select(*key, F.explode(F.array(start, end)).alias("_v"))
        .groupBy(*key, "_v.x", "_v.y")
        .agg(F.sum("_v.d").alias("_d"))
        .filter(c("_d") != 0)
        .groupBy(*key)
        .agg(F.lit(1).alias("_open"))
    )
    ids = [*key, "seg"]
    named = edges.select(*ids, "x1", "y1", "x2", "y2")
    pieces = split_at_grid(named.withColumns({"ax": c("x1"), "ay": c("y1"), "bx": c("x2"), "by": c("y2")}), size,
                           ("ax", "ay", "bx", "by")).drop("ax", "ay", "bx", "by")
    other = pieces.withColumnsRenamed({"seg": "seg2", "x1": "u1", "y1": "v1", "x2": "u2", "y2": "v2"})
    peak = measure_density(size, edges=edges.select(c("x1").alias("x"), c("y1").alias("y")))["edges"].peak

    def side(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> Column:
        return F.signum((c(bx) - c(ax)) * (c(py) - c(ay)) - (c(by) - c(ay)) * (c(px) - c(ax)))

    def inside(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> Column:
        """A corner strictly between the ends of an edge: the ring touches or runs back on itself there."""
        between = (c(ax) - c(px)) * (c(bx) - c(px)) + (c(ay) - c(py)) * (c(by) - c(py)) < 0
        return (side(px, py, ax, ay, bx, by) == 0) & between

    one, two = ("x1", "y1", "x2", "y2"), ("u1", "v1", "u2", "v2")
    touches = inside("u1", "v1", *one) | inside("u2", "v2", *one) | inside("x1", "y1", *two) | inside("x2", "y2", *two)
    twice = edges.filter((c("x1") != c("x2")) | (c("y1") != c("y2"))).groupBy(*key, "x1", "y1").count().filter("count > 1").select(*key).distinct().withColumn("_twice", F.lit(1))
    crossed = (
        cell_join(pieces, other, [*key, "cx", "cy"], left_peak=peak, right_peak=peak)
        .filter(c("seg") < c("seg2"))
        .filter(
            (side("u1", "v1", "x1", "y1", "x2", "y2") * side("u2", "v2", "x1", "y1", "x2", "y2") < 0)
            & (side("x1", "y1", "u1", "v1", "u2", "v2") * side("x2", "y2", "u1", "v1", "u2", "v2") < 0)
            | touches
        )
        .groupBy(*key)
        .agg(F.lit(1).alias("_cross"))
    )
    flags = counts.join(unbalanced, key, "left").join(crossed, key, "left").join(twice, key, "left").select(
        *key,
        c("_open").isNotNull().alias("open_ring"),
        (c("_n") < 3).alias("too_few_edges"),
        (c("_zero") == 1).alias("zero_length_edge"),
        (c("_cross").isNotNull() | c("_twice").isNotNull()).alias("self_crossing"),
    )
    return flags.filter(c("open_ring") | c("too_few_edges") | c("zero_length_edge") | c("self_crossing"))
