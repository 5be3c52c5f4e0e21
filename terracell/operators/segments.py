"""Cutting segments at grid lines, so that every piece belongs to exactly one cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..grid import GRID_X0, GRID_Y0, cell_index, cell_x, cell_y


def _cuts(a: str, b: str, size: float, origin: float) -> Column:
    """Positions along the segment (0..1) where one coordinate crosses a grid line."""
    lo = cell_index(F.least(a, b), size, origin)
    hi = cell_index(F.greatest(a, b), size, origin)
    span = F.col(b) - F.col(a)
    lines = F.transform(
        F.sequence(lo + 1, hi),
        lambda i: (F.lit(origin) + i * F.lit(float(size)) - F.col(a)) / span,
    )
    return F.when(hi > lo, lines).otherwise(F.expr("cast(array() as array<double>)"))


def split_at_grid(segs: DataFrame, size: float, ends: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2")) -> DataFrame:
    """One row per (segment, cell): the end columns become the piece's ends, plus ``cx, cy``.

    The number of pieces follows the length of the segment over the cell size.  Segments
    within one cell, the usual case, pass through unchanged.
    """
    x1, y1, x2, y2 = ends
    one_cell = (cell_x(F.col(x1), size) == cell_x(F.col(x2), size)) & (
        cell_y(F.col(y1), size) == cell_y(F.col(y2), size)
    )
    stops = F.array_sort(
        F.concat(F.array(F.lit(0.0), F.lit(1.0)), _cuts(x1, x2, size, GRID_X0), _cuts(y1, y2, size, GRID_Y0))
    )
    stops = F.when(one_cell, F.array(F.lit(0.0), F.lit(1.0))).otherwise(stops)
    rest = [c for c in segs.columns if c not in ends]
    cut = (
        segs.withColumn("_stops", stops)
        .withColumn("_k", F.explode(F.sequence(F.lit(1), F.size("_stops") - 1)))
        .withColumn("_t0", F.element_at("_stops", F.col("_k")))
        .withColumn("_t1", F.element_at("_stops", F.col("_k") + 1))
        .filter((F.col("_t1") > F.col("_t0")) | (F.size("_stops") == 2))
    )

    def at(a: str, b: str, t: str) -> Column:
        return (
            F.when(F.col(t) == 0, F.col(a))
            .when(F.col(t) == 1, F.col(b))
            .otherwise(F.col(a) + F.col(t) * (F.col(b) - F.col(a)))
        )

    pieces = cut.select(
        *rest,
        at(x1, x2, "_t0").alias(x1),
        at(y1, y2, "_t0").alias(y1),
        at(x1, x2, "_t1").alias(x2),
        at(y1, y2, "_t1").alias(y2),
    )
    return pieces.withColumn("cx", cell_x((F.col(x1) + F.col(x2)) / 2, size)).withColumn(
        "cy", cell_y((F.col(y1) + F.col(y2)) / 2, size)
    )
