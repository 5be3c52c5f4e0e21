"""Rasters as one row per cell: sampling, zonal statistics, map algebra.

A cell's centre follows from its address by arithmetic, so sampling is an equi-join on
``(col, row)`` and a clip is a point-in-zone join of cell centres.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..grid import cell_join, measure_density
from .buffers import buffer_pairs, buffer_points
from .overlay import Tiles, match_polygons

ADDRESS = ["col", "row"]
STATISTICS = ["count", "sum", "mean", "std", "min", "max"]
TILE_CELLS = 100


@dataclass(frozen=True)
class RasterGrid:
    """Georeference of a raster: corner of cell (0, 0) and cell size in metres."""

    x0: float
    y0: float
    size: float

    def center_x(self) -> Column:
        return F.lit(self.x0) + F.col("col") * F.lit(self.size) + F.lit(self.size / 2)

    def center_y(self) -> Column:
        return F.lit(self.y0) + F.col("row") * F.lit(self.size) + F.lit(self.size / 2)

    def address(self, points: DataFrame) -> DataFrame:
        return points.withColumn("col", F.floor((F.col("x") - F.lit(self.x0)) / F.lit(self.size)).cast("int")).withColumn(
            "row", F.floor((F.col("y") - F.lit(self.y0)) / F.lit(self.size)).cast("int")
        )

    def centers(self, cells: DataFrame) -> DataFrame:
        return cells.withColumn("x", self.center_x()).withColumn("y", self.center_y())


def retile(cells: DataFrame, size: int = TILE_CELLS) -> DataFrame:
    """Tile address of every cell: rasters are cut into size x size blocks."""
    return cells.withColumn("tile_col", F.floor(F.col("col") / size).cast("int")).withColumn(
        "tile_row", F.floor(F.col("row") / size).cast("int")
    )


def _last(value: Column, order: str | None) -> Column:
    """The last value by ``order``, nodata (NULL) never; without an order the greatest."""
    return F.max_by(value, F.when(value.isNotNull(), F.col(order))) if order else F.max(value)


def mosaic(cells: DataFrame, order: str | None, key: list[str] | None = None, values: list[str] | None = None) -> DataFrame:
    """One value per cell address where rasters overlap: the last one by ``order`` that is not nodata."""
    ids = [*(key or []), *ADDRESS]
    return cells.groupBy(*ids).agg(*[_last(F.col(v), order).alias(v) for v in values or ["val"]])


def mosaic_layers(cells: DataFrame, layer: str, names: list[str], order: str | None = None) -> DataFrame:
    """Mosaics of several layers side by side: a value column per layer, and ``has_<layer>`` where its raster reaches."""
    wanted = cells.filter(F.col(layer).isin(names))
    columns = []
    for n in names:
        own = F.col(layer) == n
        columns += [_last(F.when(own, F.col("val")), order).alias(n), F.max(own).alias(f"has_{n}")]
    return wanted.groupBy(*ADDRESS).agg(*columns)


def load_order(cells: DataFrame) -> str | None:
    """The column that says which of two overlapping rasters was loaded last, if there is one."""
    return "rid" if "rid" in cells.columns else None


def sample(units: DataFrame, cells: DataFrame, grid: RasterGrid, unit: str = "tot_reg_cd", outer: bool = False) -> DataFrame:
    """Value of the cell under each unit.  Units off the raster are dropped unless ``outer``."""
    placed = grid.address(units.select(unit, "x", "y"))
    peak = measure_density(2 * grid.size, units=placed.select("x", "y"))["units"].peak
    found = cell_join(placed.drop("x", "y"), cells, ADDRESS, left_peak=peak).drop(*ADDRESS)
    return units.select(unit).join(found, unit, "left") if outer else found


def cells_in_polygons(cells: DataFrame, tiles: Tiles, grid: RasterGrid) -> DataFrame:
    """(zone key, col, row) of raster cells whose centre lies in a zone.

    Takes cell addresses only, each once, so many layers on one grid share one geometric join.
    """
    return match_polygons(grid.centers(cells.select(*ADDRESS)), tiles).select(*tiles.key, *ADDRESS)


# Blocks of a raster row hold 1, 16, 256 and 4096 cells.
RADIX, BLOCK_LEVELS = 16, 4


def row_intervals(tiles: Tiles, grid: RasterGrid) -> DataFrame:
    """(zone key, row, lo, hi): the columns whose cell centres lie in a zone, as intervals of each raster row it meets.

    Every edge crosses the rows between its ends once each; sorted by column, the crossings of a zone and row
    open and close its intervals. Work follows the rows crossed, not the cells inside.
    """
    c, key = F.col, tiles.key
    up = c("y2") > c("y1")
    ends = {"lx": ("x1", "x2"), "ly": ("y1", "y2"), "hx": ("x2", "x1"), "hy": ("y2", "y1")}
    rising = tiles.shape.filter("y1 <> y2").select(
        *key, *[F.when(up, c(a)).otherwise(c(b)).alias(n) for n, (a, b) in ends.items()], F.when(up, 1).otherwise(-1).alias("s")
    )
    near = [F.floor((c(y) - F.lit(grid.y0)) / F.lit(grid.size)).cast("int") for y in ("ly", "hy")]
    met = rising.withColumn("row", F.explode(F.sequence(near[0], near[1])))
    met = met.withColumn("_y", grid.center_y()).filter((c("ly") <= c("_y")) & (c("_y") < c("hy")))
    met = met.withColumn("_x", c("lx") + (c("_y") - c("ly")) * (c("hx") - c("lx")) / (c("hy") - c("ly")))
    # The last column whose centre lies west of the crossing, told by the centres themselves.
    guess = F.floor((c("_x") - F.lit(grid.x0)) / F.lit(grid.size) - 0.5).cast("int")
    met = met.withColumn("col", guess)
    center = grid.center_x()
    last = F.when(center + F.lit(grid.size) < c("_x"), c("col") + 1).when(center < c("_x"), c("col")).otherwise(c("col") - 1)
    steps = met.groupBy(*key, "row", last.alias("hi")).agg(F.sum("s").alias("s")).filter("s <> 0")
    eastwards = Window.partitionBy(*key, "row").orderBy(F.desc("hi"))
    return (
        steps.withColumn("inside", F.sum("s").over(eastwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("lo", F.lead("hi").over(eastwards) + 1)
        .filter("inside > 0 AND lo <= hi")
        .select(*key, "row", "lo", "hi")
    )


def _blocks_of(intervals: DataFrame) -> DataFrame:
    """The intervals as whole blocks, adding ``lvl, idx``: at most 30 a level, those of the largest size in the middle."""
    lo, hi, found = F.col("lo").cast("long"), F.col("hi").cast("long"), []

    def run(level: int, first: Column, last: Column) -> Column:
        spots = F.when(first <= last, F.sequence(first, last)).otherwise(F.expr("cast(array() as array<bigint>)"))
        return F.transform(spots, lambda i: F.struct(F.lit(level).alias("lvl"), i.alias("idx")))

    table = intervals
    for level in range(BLOCK_LEVELS - 1):
        table = table.withColumns({f"_a{level}": lo, f"_b{level}": hi})
        lo, hi = F.col(f"_a{level}"), F.col(f"_b{level}")
        first, last = F.ceil(lo / RADIX), F.floor((hi + 1) / RADIX) - 1
        table = table.withColumns({f"_f{level}": first.cast("long"), f"_l{level}": last.cast("long")})
        first, last = F.col(f"_f{level}"), F.col(f"_l{level}")
        # Without a whole block of the next size all goes on this level.
        whole = first <= last
        found.append(run(level, lo, F.when(whole, first * RADIX - 1).otherwise(hi)))
        found.append(run(level, F.when(whole, (last + 1) * RADIX).otherwise(hi + 1), hi))
        lo, hi = F.when(whole, first).otherwise(F.lit(1)), F.when(whole, last).otherwise(F.lit(0))
    found.append(run(BLOCK_LEVELS - 1, lo.cast("long"), hi.cast("long")))
    return table.select(*[c for c in intervals.columns if c not in ("lo", "hi")], F.inline(F.concat(*found)))


def _zonal(cells: DataFrame, tiles: Tiles, grid: RasterGrid, made: list[Column], merged: list[Column]) -> DataFrame:
    """``merged`` per zone from the ``made`` aggregates of the blocks that its intervals are made of."""
    levels = cells.withColumn("lvl", F.explode(F.sequence(F.lit(0), F.lit(BLOCK_LEVELS - 1))))
    idx = F.floor(F.col("col") / F.pow(F.lit(float(RADIX)), F.col("lvl"))).cast("long")
    blocks = levels.groupBy("row", "lvl", idx.alias("idx")).agg(*made)
    return _blocks_of(row_intervals(tiles, grid)).join(blocks, ["row", "lvl", "idx"]).groupBy(*tiles.key).agg(*merged)


def zonal_statistics(cells: DataFrame, tiles: Tiles, grid: RasterGrid, layers: dict[str, str]) -> DataFrame:
    """Six statistics per zone for each value column in ``layers`` (column to name prefix).

    ``cells`` is a mosaic: every address once. Zones without any raster cell are dropped; with a column
    ``has_<layer>``, a zone that the layer does not reach has NULL for it. Zones meet blocks of cells, not cells:
    counts, sums, squares and extremes of a block are made once for all zones.
    """
    made, merged = [], []
    for column, prefix in layers.items():
        v = F.col(column).cast("double")
        made += [
            F.count(v).alias(f"n_{column}"), F.sum(v).alias(f"s_{column}"), (F.var_pop(v) * F.count(v)).alias(f"q_{column}"),
            F.min(column).alias(f"lo_{column}"), F.max(column).alias(f"hi_{column}"),
        ]
        n, total = F.sum(f"n_{column}"), F.sum(f"s_{column}")
        # Squares about a block's own mean, and of the means about that of the zone.
        means = F.sum(F.try_divide(F.col(f"s_{column}") * F.col(f"s_{column}"), F.col(f"n_{column}")))
        spread_ = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.sum(f"q_{column}") + means, n) - F.pow(F.try_divide(total, n), 2)))
        found = [n, total, F.try_divide(total, n), F.when(n > 0, spread_), F.min(f"lo_{column}"), F.max(f"hi_{column}")]
        if f"has_{column}" in cells.columns:
            made.append(F.max(f"has_{column}").alias(f"has_{column}"))
            found = [F.when(F.max(f"has_{column}"), m) for m in found]
        merged += [m.alias(f"{prefix}_{name}") for m, name in zip(found, STATISTICS)]
    return _zonal(cells, tiles, grid, made, merged)


def zonal_sums(cells: DataFrame, tiles: Tiles, grid: RasterGrid, columns: list[str]) -> DataFrame:
    """Sums of the columns over the cells whose centres lie in each zone; zones without any cell are dropped."""
    return _zonal(cells, tiles, grid, [F.sum(c).alias(c) for c in columns], [F.sum(c).alias(c) for c in columns])


def buffer_tile_mean(
    units: DataFrame, cells: DataFrame, grid: RasterGrid, radius: float, unit: str = "tot_reg_cd", cellwise: bool = False
) -> DataFrame:
    """Mean over the buffer: mean of the means per raster tile, or over cells with ``cellwise``."""
    placed = retile(grid.centers(cells)).withColumn("val", F.col("val").cast("double"))
    tile = [] if cellwise else ["tile_col", "tile_row"]
    held = buffer_points(
        units, placed.filter(F.col("val").isNotNull()), radius,
        {"total": F.col("val"), "n": F.lit(1)}, unit, by=tile,
    )
    return held.groupBy(unit).agg(F.avg(F.col("total") / F.col("n")).alias("mean"))


def ring_shares(
    units: DataFrame, cells: DataFrame, grid: RasterGrid, radius: float, width: float = 30.0,
    steps: tuple[int, ...] = (20, 50), unit: str = "tot_reg_cd",
) -> DataFrame:
    """Share of cells in a ring around each unit that lie above or below the unit's own value.

    Adds ``above_20, below_20, ...`` in metres difference; NULL cells of the ring do not count.
    """
    # Units bring their own value along, so the shares are combined where the pairs are made.
    own = sample(units, cells, grid, unit).withColumnRenamed("val", "stnd")
    valued = grid.centers(cells.filter(F.col("val").isNotNull())).select("x", "y", "val")
    ring = buffer_pairs(units.select(unit, "x", "y").join(own, unit), valued, radius + width, unit, hole=radius, keep=["val"], spots=units)
    diff = F.col("val") - F.col("stnd")
    n = F.count(F.lit(1))
    shares = []
    for s in steps:
        shares.append((F.count_if(diff > s) / n).alias(f"above_{s}"))
        shares.append((F.count_if(diff < -s) / n).alias(f"below_{s}"))
    return ring.groupBy(unit).agg(*shares)


def add_rasters(
    cells: DataFrame, source: str, sources: list[str], key: list[str], value: str = "val", order: str | None = None
) -> DataFrame:
    """Cell-wise sum of several source rasters on their common extent, nodata where any has nodata.

    One grouped pass: each source is a mosaic first, and an address counts only when every source has it.
    """
    picked = cells.filter(F.col(source).isin(sources))
    parts = [_last(F.when(F.col(source) == s, F.col(value)), order) for s in sources]
    reached = reduce(lambda a, b: a & b, [F.max(F.col(source) == s) for s in sources])
    total = reduce(lambda a, b: a + b, parts)
    return picked.groupBy(*key, *ADDRESS).agg(reached.alias("_all"), total.alias(value)).filter("_all").drop("_all")
