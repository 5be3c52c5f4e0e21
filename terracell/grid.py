"""Square grid keys: the equi-join key that every spatial join in the package uses.

Spark has no spatial index, so a theta join such as "point within 500 m" would plan as a
nested loop.  Both sides get a grid cell ``(cx, cy)`` instead, Spark hash-partitions on it,
and the exact predicate runs as a residual filter.  Cells may be very unevenly filled, so
joins on a cell go through :func:`cell_join`, which splits hot cells over several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The grid starts at an odd fraction of a metre so that survey coordinates (whole or decimal
# metres) do not fall on grid lines.
GRID_X0 = 0.1278637
GRID_Y0 = 0.3915473

# Rows of one cell that a single task should handle; fuller cells are split.
HOT_ROWS = 100_000

CELL = ["cx", "cy"]


def cell_index(value: Column, size: float, origin: float) -> Column:
    return F.floor((value - F.lit(origin)) / F.lit(float(size)))


def cell_x(x: Column, size: float) -> Column:
    return cell_index(x, size, GRID_X0)


def cell_y(y: Column, size: float) -> Column:
    return cell_index(y, size, GRID_Y0)


def line_x(cx: Column, size: float) -> Column:
    """x of the left edge of column ``cx``."""
    return F.lit(GRID_X0) + cx * F.lit(float(size))


def line_y(cy: Column, size: float) -> Column:
    """y of the bottom edge of row ``cy``."""
    return F.lit(GRID_Y0) + cy * F.lit(float(size))


def with_cell(df: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    return df.withColumn("cx", cell_x(F.col(x), size)).withColumn("cy", cell_y(F.col(y), size))


@dataclass(frozen=True)
class Density:
    """How a layer fills a grid: total rows, occupied cells, rows of the fullest cell."""

    rows: int = 0
    cells: int = 0
    peak: int = 0


def measure_density(size: float, **sides: DataFrame) -> dict[str, Density]:
    """Fill statistics of point tables (columns x, y) on one grid, in one job.

    Only one row per table reaches the driver.  Results steer plans and never change an answer,
    so they are remembered per plan: the next variable on the same layer need not measure again.
    """
    hashes = {name: (df.semanticHash(), float(size)) for name, df in sides.items()}
    known = {name: _measured[h] for name, h in hashes.items() if h in _measured}
    if len(known) == len(sides):
        return known
    tagged = None
    for name, df in sides.items():
        if name in known:
            continue
        part = df.select(
            F.lit(name).alias("side"), cell_x(F.col("x"), size).alias("cx"), cell_y(F.col("y"), size).alias("cy")
        )
        tagged = part if tagged is None else tagged.unionByName(part)
    stats = (
        tagged.groupBy("side", *CELL)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("side")
        .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("cells"), F.max("n").alias("peak"))
        .collect()
    )
    found = {r["side"]: Density(r["rows"], r["cells"], r["peak"]) for r in stats}
    fresh = {name: found.get(name, Density()) for name in sides if name not in known}
    if len(_measured) > 10_000:
        _measured.clear()
    _measured.update({hashes[name]: density for name, density in fresh.items()})
    return known | fresh


_measured: dict[tuple[int, float], Density] = {}


def _hot_cells(df: DataFrame, keys: list[str], hot_rows: int, column: str) -> DataFrame:
    """Cells with more than ``hot_rows`` rows and the number of splits each needs.

    At most rows/hot_rows cells can qualify, so this table stays small on any layer.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select(*keys, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias(column))
    )


def cell_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str] | None = None,
    left_peak: int = 0,
    right_peak: int = 0,
    hot_rows: int | None = None,
) -> DataFrame:
    """Inner equi-join on grid keys with hot keys split over several tasks.

    ``left_peak``/``right_peak`` are the measured rows of the fullest key.  A side whose peak
    exceeds ``hot_rows`` gets a salt (hash of the row, so a recomputed task assigns the same
    one) on its hot keys only, and the other side is repeated for exactly those keys.
    """
    keys = keys or CELL
    on = list(keys)
    hot_rows = hot_rows or HOT_ROWS
    hot_left = _hot_cells(left, keys, hot_rows, "_nl") if left_peak > hot_rows else None
    hot_right = _hot_cells(right, keys, hot_rows, "_nr") if right_peak > hot_rows else None
    left_base, right_base = list(left.columns), list(right.columns)
    if hot_left is not None:
        left = _pick_salt(left.join(hot_left, keys, "left"), "_nl", "_sl", left_base)
        right = _spread_salt(right.join(hot_left, keys, "left"), "_nl", "_sl")
        on.append("_sl")
    if hot_right is not None:
        right = _pick_salt(right.join(hot_right, keys, "left"), "_nr", "_sr", right_base)
        left = _spread_salt(left.join(hot_right, keys, "left"), "_nr", "_sr")
        on.append("_sr")
    # Spark takes a table blown up by explode for as small as the one it is made of, and would broadcast it.
    return left.join(right.hint("merge"), on, "inner").drop("_sl", "_sr")


def _pick_salt(df: DataFrame, count: str, salt: str, source: list[str]) -> DataFrame:
    n = F.coalesce(F.col(count), F.lit(1))
    return df.withColumn(salt, F.pmod(F.xxhash64(*source), n.cast("long")).cast("int")).drop(count)


def _spread_salt(df: DataFrame, count: str, salt: str) -> DataFrame:
    n = F.coalesce(F.col(count), F.lit(1))
    return df.withColumn(salt, F.explode(F.sequence(F.lit(0), n - F.lit(1)))).drop(count)


# Tables up to this many rows are redistributed before a join multiplies their rows.
SPREAD_ROWS = 5_000_000


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Even out a table over the cores by its cells.

    A layer of a few megabytes may come from one file, and thus in one task, while the pairs made
    of it keep all cores busy.  Larger layers have many files, and moving them costs more.
    """
    return df.repartition(*CELL) if rows <= SPREAD_ROWS else df


# Blocks that units are dealt to, parts that the units of all blocks make at most, and units that are never parted.
BLOCKS, PARTS, PART_UNITS = 64, 128, 2000
# Rows of features that one block may hold in memory while the cells of its units are looked up.
HELD_ROWS = 6_000_000
BLOCK = ["_bx", "_by", "_part"]


def block_size(radius: float, units: Density, layer: Density, pieces: float = 1.0) -> float | None:
    """Side of the blocks by which zones of a radius meet a layer, or None if even small ones would hold too much of it.

    Both densities are those of a grid of the radius; ``pieces`` is how many rows a feature is cut into.
    """
    size, slices = block_slices(radius, units, layer, pieces)
    return size if slices == 1 else None


def block_slices(radius: float, units: Density, layer: Density, pieces: float = 1.0) -> tuple[float, int]:
    """Side of the blocks as :func:`block_size` has it, and into how many slices the features of small ones are dealt to fit."""
    first = round(math.log2(math.sqrt(max(units.cells, 1) / BLOCKS)))
    for step in range(max(-2, min(6, first)), -3, -1):
        size = radius * 2.0**step
        # Cells of the radius that a block with its surroundings may touch.
        touched = math.ceil((size + 2 * radius) / radius) + 1
        held = min(layer.rows, layer.peak * touched * touched) * pieces
        if held <= HELD_ROWS:
            return size, 1
    return size, math.ceil(held / HELD_ROWS)


# Groups of tasks that tiles are parted into, if units are many, and numbers that a unit with its result takes when it moves.
TASKS, UNIT_LOAD = 64, 16
TILE = [*BLOCK, "_slice"]
Box = tuple[float | None, float | None, float | None, float | None]


def tile_size(radius: float, units: Density, layer: Density, load: float, pieces: float = 1.0) -> tuple[float, int]:
    """Side of the tiles by which features meet zones of a radius at the least movement, and into how many slices those of a full one are dealt.

    Both densities are those of a grid of the radius; ``load`` is how many numbers a feature takes when it moves, ``pieces`` how many rows
    it makes in memory.
    """
    span = radius * math.sqrt(max(layer.cells, 1))
    choices = []
    for step in range(-3, 5):
        size = radius * 2.0**step
        tiles = max(1.0, span / size) ** 2
        reached = min((math.ceil(span / size) + 1) ** 2, (1 + 2 * radius / size) ** 2)
        slices = max(1, math.ceil(min(layer.rows, layer.peak * max(1, 4**step)) * pieces / HELD_ROWS))
        cost = units.rows * reached * slices * UNIT_LOAD + layer.rows * max(1.0, TASKS / tiles) * load
        choices.append((cost, -size, slices))
    _, size, slices = min(choices)
    return -size, slices


def _zero() -> Column:
    """Nought as a key: Spark would put a literal into a partitioning, not know it again by its column, and move everything once more."""
    return F.pmod(F.col("_bx"), F.lit(1)).cast("int")


class Tiles:
    """Features dealt to tasks by square tiles, each to one, and units to every tile that their zones may reach: for sums, which add up over tiles.

    A wide zone reaches most of a layer, so features dealt to units would move many times over; a unit is but its place. Tiles that units
    crowd are parted by units, and their features repeated; where a tile has too many features, slices of them meet its units one by one.
    """

    def __init__(self, units: DataFrame, size: float, reach: float, density: Density, box: Box, slices: int = 1):
        """``box`` are the least x and y and the greatest ones of the features."""
        self.size, self.slices, self.parts = size, slices, None
        self.tasks = 2 * TASKS if density.rows > 8 * PART_UNITS else None
        if None in box:
            units, box = units.filter(F.lit(False)), (0.0, 0.0, 0.0, 0.0)
        far, (west, south, east, north) = F.lit(reach + 1e-3), (float(v) for v in box)
        x, y = F.col("x"), F.col("y")
        ends = [(math.floor((a - o) / size), math.floor((b - o) / size)) for a, b, o in ((west, east, GRID_X0), (south, north, GRID_Y0))]
        placed = units.filter((x >= west - far) & (x <= east + far) & (y >= south - far) & (y <= north + far))
        for c, v, place, (low, high) in (("_bx", x, cell_x, ends[0]), ("_by", y, cell_y, ends[1])):
            first, last = F.greatest(place(v - far, size), F.lit(low)), F.least(place(v + far, size), F.lit(high))
            placed = placed.withColumn(c, F.explode(F.sequence(F.least(first, last), last)))
        gap_x, gap_y = (
            F.greatest(F.lit(0.0), line(F.col(c), size) - v, v - line(F.col(c), size) - size) for c, v, line in (("_bx", x, line_x), ("_by", y, line_y))
        )
        placed = placed.filter(gap_x * gap_x + gap_y * gap_y <= far * far)
        dealt = density.rows * min(math.prod(b - a + 1 for a, b in ends), (1 + 2 * reach / size) ** 2)
        most = int(max(PART_UNITS, dealt // TASKS))
        if density.rows > PART_UNITS:
            # Taken at once, so that both sides see the same parts; at most some TASKS rows.
            full = _hot_cells(placed, BLOCK[:2], most, "_n").collect()
            if full:
                self.parts = units.sparkSession.createDataFrame([tuple(r) for r in full], "_bx long, _by long, _n int")
        if self.parts is None:
            placed = placed.withColumn("_part", _zero())
        else:
            placed = _pick_salt(placed.join(F.broadcast(self.parts), BLOCK[:2], "left"), "_n", "_part", list(units.columns))
        every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))) if slices > 1 else _zero()
        self.units = self._grouped(placed.withColumn("_slice", every))

    def _grouped(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.tasks, *TILE) if self.tasks else df.repartition(*TILE)

    def meet(self, features: DataFrame, run: Callable, schema: str) -> DataFrame:
        """Rows that ``run`` makes of the units and the features (in tiles ``cx, cy`` of this size) of every tile, or part or slice of one."""
        own = [c for c in features.columns if c not in CELL]
        part = F.pmod(F.xxhash64(*own), F.lit(self.slices)).cast("int") if self.slices > 1 else _zero()
        dealt = features.withColumnsRenamed({"cx": "_bx", "cy": "_by"}).withColumn("_slice", part)
        if self.parts is None:
            dealt = dealt.withColumn("_part", _zero())
        else:
            dealt = _spread_salt(dealt.join(F.broadcast(self.parts), BLOCK[:2], "left"), "_n", "_part")
        return self.units.groupBy(*TILE).cogroup(self._grouped(dealt).groupBy(*TILE)).applyInArrow(run, schema)


class Blocks:
    """Units dealt to tasks by square blocks, so that the cells of their zones are made and looked up in one task.

    A zone has many cells, and moving them would cost far more than the units and the layer. Here units move once, and
    features to every block whose units may reach them. Blocks full of units are parted, and their features repeated.
    """

    def __init__(self, units: DataFrame, size: float, reach: float, density: Density, spots: DataFrame | None = None):
        """``spots`` may give the places of the units, and of others, where ``units`` cost more to make."""
        self.size, self.reach, self.parts = size, reach, None
        ends = [f(c) for f in (F.min, F.max) for c in ("x", "y")]
        self.box = tuple((units if spots is None else spots).agg(*ends).first())
        placed = units.withColumn("_bx", cell_x(F.col("x"), size)).withColumn("_by", cell_y(F.col("y"), size))
        most = max(PART_UNITS, density.rows // PARTS)
        if density.rows > most:
            # At most PARTS rows; taken at once, so that both sides of the join see the same parts.
            full = _hot_cells(placed, BLOCK[:2], most, "_n").collect()
            if full:
                self.parts = units.sparkSession.createDataFrame([tuple(r) for r in full], "_bx long, _by long, _n int")
        if self.parts is None:
            placed = placed.withColumn("_part", F.lit(0))
        else:
            placed = _pick_salt(placed.join(F.broadcast(self.parts), BLOCK[:2], "left"), "_n", "_part", list(units.columns))
        self.placed, self.units = placed, placed.repartition(*BLOCK)

    def meet(self, dealt: DataFrame, run: Callable, schema: StructType, slices: int = 1) -> DataFrame:
        """Rows that ``run`` makes of partitions in which the features dealt to a block (``_f``) stand before its units (``_u``).

        Features and units move once, and only features need be held. Where a block has too many of them, slices of
        them meet its units one by one.
        """
        own = [c for c in dealt.columns if c not in BLOCK]
        part = F.pmod(F.xxhash64(*own), F.lit(slices)).cast("int") if slices > 1 else F.lit(0)
        features = dealt.select(*BLOCK, part.alias("_slice"), F.lit(0).alias("_kind"), F.struct(*own).alias("_f"))
        own = [c for c in self.placed.columns if c not in BLOCK]
        every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))) if slices > 1 else F.lit(0)
        units = self.placed.select(*BLOCK, every.alias("_slice"), F.lit(1).alias("_kind"), F.struct(*own).alias("_u"))
        both = features.unionByName(units, allowMissingColumns=True).repartition(*BLOCK, "_slice")
        return both.sortWithinPartitions(*BLOCK, "_slice", "_kind").mapInArrow(run, schema)

    def join(self, cells: DataFrame, placed: DataFrame, keys: list[str], side: Column) -> DataFrame:
        """Inner join of ``cells``, made of ``units`` without a shuffle, with rows in cells ``cx, cy`` of the given side."""
        left, bottom = (F.lit(o) + F.col(c) * side for o, c in ((GRID_X0, "cx"), (GRID_Y0, "cy")))
        dealt = self.deal(placed, left, bottom, side).repartition(*BLOCK)
        # Partitions by block serve the join by block and cell; the layer is held, the cells stream by.
        return cells.join(dealt.hint("shuffle_hash"), [*BLOCK, *keys], "inner").drop(*BLOCK)

    def deal(self, placed: DataFrame, left: Column, bottom: Column, side: Column, height: Column | None = None) -> DataFrame:
        """Rows for every block, or part of one, with units within reach of the box at (left, bottom), a square without a height."""
        height = side if height is None else height
        reach, size = F.lit(self.reach + 1e-3), F.lit(float(self.size))
        # What lies far from all units would be dealt to blocks without any.
        if None not in self.box:
            west, south, east, north = (F.lit(float(v)) for v in self.box)
            placed = placed.filter((left <= east + reach) & (left + side >= west - reach) & (bottom <= north + reach) & (bottom + height >= south - reach))
        dealt = placed.withColumn("_bx", F.explode(F.sequence(cell_x(left - reach, self.size), cell_x(left + side + reach, self.size))))
        dealt = dealt.withColumn("_by", F.explode(F.sequence(cell_y(bottom - reach, self.size), cell_y(bottom + height + reach, self.size))))
        west, south = line_x(F.col("_bx"), self.size), line_y(F.col("_by"), self.size)
        gap_x = F.greatest(F.lit(0.0), west - left - side, left - west - size)
        gap_y = F.greatest(F.lit(0.0), south - bottom - height, bottom - south - size)
        dealt = dealt.filter(gap_x * gap_x + gap_y * gap_y <= reach * reach)
        if self.parts is None:
            return dealt.withColumn("_part", F.lit(0))
        return _spread_salt(dealt.join(F.broadcast(self.parts), BLOCK[:2], "left"), "_n", "_part")


def _cell_reach(x: Column, y: Column, size: float, grow: float = 0.0) -> tuple[Column, Column]:
    """Squared least and greatest distance from (x, y) to cell (cx, cy); ``grow`` widens the cell for the latter."""
    g, m = F.lit(float(size)), F.lit(float(grow))
    left, bottom = line_x(F.col("cx"), size), line_y(F.col("cy"), size)
    near_x = F.greatest(F.lit(0.0), left - x, x - left - g)
    near_y = F.greatest(F.lit(0.0), bottom - y, y - bottom - g)
    far_x = F.greatest(x - left + m, left + g + m - x)
    far_y = F.greatest(y - bottom + m, bottom + g + m - y)
    return near_x * near_x + near_y * near_y, far_x * far_x + far_y * far_y


def ring_cells(units: DataFrame, size: float, outer: float, inner: float = 0.0, shrink: float = 1.0) -> DataFrame:
    """Repeat each unit (columns x, y) for every cell that its circle or ring may touch.

    Adds ``cx, cy``.  Cells swallowed by the hole of a ring are left out.  ``shrink`` is the
    ratio of the inscribed circle to the radius (cos(pi/32) for a 32-gon, 1 for a disc).
    """
    x, y, r = F.col("x"), F.col("y"), F.lit(float(outer))
    left = line_x(F.col("cx"), size)
    near_x = F.greatest(F.lit(0.0), left - x, x - left - F.lit(float(size)))
    reach = F.sqrt(F.greatest(F.lit(0.0), r * r - near_x * near_x)) + F.lit(1e-6)
    rows = (
        units.withColumn("cx", F.explode(F.sequence(cell_x(x - r, size), cell_x(x + r, size))))
        .withColumn("_reach", reach)
        .withColumn("cy", F.explode(F.sequence(cell_y(y - F.col("_reach"), size), cell_y(y + F.col("_reach"), size))))
        .drop("_reach")
    )
    if inner > 0:
        hole = inner * shrink * (1 - 1e-12)
        rows = rows.filter(_cell_reach(x, y, size)[1] >= F.lit(hole * hole))
    return rows


def disc_cover(units: DataFrame, radius: float, steps: int, shrink: float = 1.0, grow: float = 0.0) -> DataFrame:
    """Tile each unit's circle with cells of radius/2, halving the ones on the rim ``steps`` times.

    Adds ``lvl, cx, cy, covered``: level 0 cells have size radius/2, level k cells radius/2^(k+1).
    ``covered`` cells lie wholly inside the zone (widened by ``grow`` when features stick out of
    their cell); all others are rim cells of the last level.  About 8 x 2^steps rows per unit.
    """
    x, y = F.col("x"), F.col("y")
    safe = radius * shrink * (1 - 1e-12)
    size = radius / 2
    far2 = _cell_reach(x, y, size, grow)[1]
    rows = ring_cells(units, size, radius).withColumn("lvl", F.lit(0))
    rows = rows.withColumn("covered", far2 < F.lit(safe * safe))
    for step in range(1, steps + 1):
        size /= 2
        cx, cy = F.col("cx"), F.col("cy")
        same = F.array(F.struct(F.col("lvl").alias("lvl"), cx.alias("cx"), cy.alias("cy")))
        halves = F.array(
            *[
                F.struct(F.lit(step).alias("lvl"), (cx * 2 + i).alias("cx"), (cy * 2 + j).alias("cy"))
                for i in (0, 1)
                for j in (0, 1)
            ]
        )
        rows = rows.withColumn("_cell", F.explode(F.when(F.col("covered"), same).otherwise(halves)))
        rows = rows.select(*units.columns, "covered", "_cell.lvl", "_cell.cx", "_cell.cy")
        near2, far2 = _cell_reach(x, y, size, grow)
        reach2 = (radius + 1e-6) ** 2
        rows = rows.filter(F.col("covered") | (near2 <= F.lit(reach2))).withColumn(
            "covered", F.col("covered") | (far2 < F.lit(safe * safe))
        )
    return rows


def nested_cover(units: DataFrame, radii: list[float], steps: int, shrink: float = 1.0) -> DataFrame:
    """Tile each unit's largest circle with cells of half its radius, halving those on the rim of any of its circles.

    ``radii`` ascend. Adds ``lvl, cx, cy, band``: a cell between two neighbouring circles has the number of the outer
    one as its band; a cell that a rim crosses even on the last level has none.
    """
    x, y = F.col("x"), F.col("y")
    size = radii[-1] / 2

    def banded(rows: DataFrame, size: float, known: Column | None = None) -> DataFrame:
        known = F.lit(None).cast("int") if known is None else known
        near2, far2 = _cell_reach(x, y, size)
        band, settled = F.lit(None).cast("int"), F.lit(True)
        for i, r in reversed(list(enumerate(radii))):
            within = far2 < F.lit((r * shrink * (1 - 1e-12)) ** 2)
            band = F.when(within, F.lit(i)).otherwise(band)
            settled = settled & (within | (near2 > F.lit((r + 1e-6) ** 2)))
        outside = near2 > F.lit((radii[-1] + 1e-6) ** 2)
        return rows.filter(known.isNotNull() | ~outside).withColumn("band", F.coalesce(known, F.when(settled, band)))

    rows = banded(ring_cells(units, size, radii[-1]).withColumn("lvl", F.lit(0)), size)
    for step in range(1, steps + 1):
        size /= 2
        cx, cy = F.col("cx"), F.col("cy")
        halves = F.array(
            *[F.struct(F.lit(step).alias("lvl"), (cx * 2 + i).alias("cx"), (cy * 2 + j).alias("cy")) for i in (0, 1) for j in (0, 1)]
        )
        same = F.array(F.struct(F.col("lvl").alias("lvl"), cx.alias("cx"), cy.alias("cy")))
        rows = rows.withColumn("_cell", F.explode(F.when(F.col("band").isNotNull(), same).otherwise(halves)))
        rows = rows.select(*units.columns, F.col("band").alias("_band"), "_cell.lvl", "_cell.cx", "_cell.cy")
        # Cells settled before keep their band: their address is on a coarser grid.
        rows = banded(rows, size, F.col("_band")).drop("_band")
    return rows


def cover_steps(density: Density) -> int:
    """How often to halve rim cells: 0 means testing every candidate, without per-cell totals.

    With d features per radius-sized cell a direct test costs about 5d per unit; with k cells
    per radius the cover has 16k rows and 8d/k tests remain in rim cells.  A row that moves
    through a shuffle costs some ten tests, so k = sqrt(d/20) is near the least.  The fullest
    cell decides, so that one dense city cannot make the work quadratic.
    """
    if density.peak <= 512:
        return 0
    return max(1, min(6, round(math.log2(math.sqrt(density.peak / 20) / 2))))


def pyramid(cells: DataFrame, steps: int, sums: list[str], by: list[str]) -> DataFrame:
    """Totals per (lvl, cx, cy) for all levels of :func:`disc_cover` from rows keyed by last-level cells."""
    levels = F.sequence(F.lit(0), F.lit(steps))
    # Combine per finest cell first, so that only one row per cell is repeated over the levels.
    base = cells.groupBy(*CELL, *by).agg(*[F.sum(c).alias(c) for c in sums])
    spread = base.withColumn("lvl", F.explode(levels))
    halvings = F.lit(steps) - F.col("lvl")
    return (
        spread.withColumn("cx", F.floor(F.col("cx") / F.pow(F.lit(2.0), halvings)))
        .withColumn("cy", F.floor(F.col("cy") / F.pow(F.lit(2.0), halvings)))
        .groupBy("lvl", *CELL, *by)
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def level_sizes(finest: float, extent: float) -> list[float]:
    """Grid sizes from the finest upwards by factors of 4 until about 4 cells span the extent."""
    steps = max(0, math.ceil(math.log(max(extent / finest / 4, 1.0), 4)))
    return [finest * 4**k for k in range(steps + 1)]
