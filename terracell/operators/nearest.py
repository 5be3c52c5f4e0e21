"""Distance from units to the nearest feature of a layer, of any size.

Comparing every unit with every feature does not scale, and a fixed search radius either
misses features or drowns in them.  Here occupied grid cells are narrowed down instead, from a
coarse grid to a fine one: at each level a cell stays a candidate only if its least possible
distance does not exceed the greatest possible distance to the best cell.  Units share this
search per grid cell, and only the features of the few surviving cells are measured.  The
result is exact.

On larger layers, where only the distance is asked for, units and features are dealt to square blocks instead: the ends of
features in a unit's own cell bound its distance, so a block gets the features that can be nearest to any of its units, and
finds them in one numpy task under a grid of its own (:mod:`terracell.operators.counting`).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import point_segment_distance2
from ..grid import GRID_X0, GRID_Y0, CELL, cell_join, cell_x, cell_y, level_sizes, line_x, line_y, measure_density, spread, with_cell
from ..session import ship
from .counting import finder
from .overlay import EDGE, match_polygons, tile_polygons
from .segments import split_at_grid

# Features per cell that the finest grid aims at.
CELL_FEATURES = 64


def as_edges(layer: DataFrame) -> DataFrame:
    """Points as zero-length edges, so that points and lines go one way."""
    if "x1" in layer.columns:
        return layer
    rest = [c for c in layer.columns if c not in ("x", "y")]
    return layer.select(
        *rest, F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2")
    )


def _finest(segs: DataFrame) -> tuple[float, float, tuple[float, float, float, float], int, int] | None:
    """Finest cell size, extent, bounds, rows and crowding of a layer; None for an empty one."""
    row = segs.agg(
        F.min(F.least("x1", "x2")).alias("lx"), F.max(F.greatest("x1", "x2")).alias("hx"),
        F.min(F.least("y1", "y2")).alias("ly"), F.max(F.greatest("y1", "y2")).alias("hy"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    if row["lx"] is None:
        return None
    extent = max(row["hx"] - row["lx"], row["hy"] - row["ly"], 1.0)
    even = max(extent * math.sqrt(16 / row["n"]), extent / 2**20, 0.5)
    starts = segs.select(F.col("x1").alias("x"), F.col("y1").alias("y")).distinct()
    peak = measure_density(even, layer=starts)["layer"].peak if row["n"] > CELL_FEATURES else row["n"]
    # Crowded places get a finer grid, measured anew; empty cells cost nothing.
    while peak > CELL_FEATURES and even > max(extent / 2**26, 0.001):
        even /= 4
        peak = measure_density(even, layer=starts)["layer"].peak
    return even, extent, (row["lx"], row["hx"], row["ly"], row["hy"]), row["n"], peak


def _gap(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column) -> tuple[Column, Column]:
    """Least and greatest distance between two intervals."""
    least = F.greatest(F.lit(0.0), b_lo - a_hi, a_lo - b_hi)
    return least, F.greatest(b_hi - a_lo, a_hi - b_lo)


def _candidate_cells(units: DataFrame, cells: DataFrame, size: float, extent: float, bounds: tuple, key: list[str] | None = None) -> DataFrame:
    """(ux, uy, cx, cy): for each occupied unit cell the layer cells that may hold the nearest feature; with a ``key`` of
    the layer's cells, those that may hold the nearest piece of each."""
    key = key or []
    sizes = level_sizes(size, extent)
    frontier = units.select("ux", "uy").distinct()
    lx, hx, ly, hy = bounds
    top = sizes[-1]
    span_x = [int(math.floor((v - GRID_X0) / top)) for v in (lx, hx)]
    span_y = [int(math.floor((v - GRID_Y0) / top)) for v in (ly, hy)]
    # The top grid has a handful of cells, known from the bounds.
    frontier = frontier.withColumn("cx", F.explode(F.sequence(*[F.lit(v).cast("long") for v in span_x]))).withColumn(
        "cy", F.explode(F.sequence(*[F.lit(v).cast("long") for v in span_y]))
    )
    half = F.lit(float(size))
    for level in range(len(sizes) - 1, -1, -1):
        ratio = 4**level
        here = cells if level == 0 else cells.select(
            *key, F.floor(F.col("cx") / ratio).alias("cx"), F.floor(F.col("cy") / ratio).alias("cy")
        ).distinct()
        frontier = frontier.join(here, CELL if level == len(sizes) - 1 else [*key, *CELL])
        g = F.lit(float(sizes[level]))
        near_x, far_x = _gap(F.col("ux") * half, (F.col("ux") + 1) * half, F.col("cx") * g, (F.col("cx") + 1) * g)
        near_y, far_y = _gap(F.col("uy") * half, (F.col("uy") + 1) * half, F.col("cy") * g, (F.col("cy") + 1) * g)
        bound = F.min(far_x * far_x + far_y * far_y).over(Window.partitionBy("ux", "uy", *key))
        frontier = (
            frontier.withColumn("_far", bound)
            .filter(near_x * near_x + near_y * near_y <= F.col("_far") * (1 + 1e-9))
            .drop("_far")
        )
        if level:
            children = F.sequence(F.lit(0), F.lit(3))
            frontier = (
                frontier.withColumn("_i", F.explode(children))
                .withColumn("_j", F.explode(children))
                .select("ux", "uy", *key, (F.col("cx") * 4 + F.col("_i")).alias("cx"), (F.col("cy") * 4 + F.col("_j")).alias("cy"))
            )
    return frontier


# Layers up to this size are not worth blocks; features and units that one block aims at and that one task holds at most.
BLOCK_EDGES, BLOCK_AIM, HELD_EDGES, HELD_UNITS = 100_000, 50_000, 1_000_000, 200_000
# Rows of the table that says which block reaches which.
REACHED = 200_000


def _occupied(layer: DataFrame, size: float) -> DataFrame:
    """(cx, cy, n): cells of a grid that hold places, and how many."""
    return with_cell(layer, size).filter("cx IS NOT NULL AND cy IS NOT NULL").groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))


def _by_blocks(centers: DataFrame, edges: DataFrame, unit: str) -> tuple[DataFrame, DataFrame | None] | None:
    """Distance of the units from the nearest edge, block by block, and the units that are too far away for that, if any; None for layers that are small.

    Some end of an edge in a unit's own cell, of whatever level, bounds the unit's distance by the cell's diagonal. A block reaches as far as
    the largest bound of its units, and gets every edge within that reach.
    """
    ends = (F.least("x1", "x2"), F.greatest("x1", "x2"), F.least("y1", "y2"), F.greatest("y1", "y2"))
    whole = edges.select(*EDGE).filter(" AND ".join(f"{c} IS NOT NULL" for c in EDGE))
    row = whole.agg(F.min(ends[0]), F.max(ends[1]), F.min(ends[2]), F.max(ends[3]), F.count(F.lit(1))).first()
    count = row[4]
    if count < BLOCK_EDGES:
        return None
    area = max(row[1] - row[0], 1.0) * max(row[3] - row[2], 1.0)
    fine = math.sqrt(16 * area / count)
    deep = max(0, round(math.log2(math.sqrt(area / max(64, count / BLOCK_AIM)) / fine)))
    side = fine * 2.0**deep
    block = [F.shiftright(c, deep).alias(b) for c, b in zip(CELL, ("bx", "by"))]
    both = F.explode(F.array(*[F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in (EDGE[:2], EDGE[2:])]))
    places = _occupied(whole.select(both.alias("p")).select("p.x", "p.y"), fine)
    levels = F.explode(F.sequence(F.lit(0), F.lit(deep + 2))).alias("lvl")

    def raised(cells: DataFrame) -> DataFrame:
        up = [F.expr(f"shiftright({c}, lvl)").alias(f"_{c}") for c in CELL]
        return cells.select("*", levels).select("*", *up)

    homes = _occupied(centers, fine)
    there = raised(places).select("lvl", "_cx", "_cy").distinct()
    bounds = raised(homes).join(there, ["lvl", "_cx", "_cy"], "left_semi").groupBy(*CELL).agg(F.min("lvl").alias("lvl"))
    # Two small tables, with a row for each block; taken at once, so that both sides of the join see the same blocks.
    found = homes.join(bounds, CELL, "left").groupBy(*block).agg(
        F.max("lvl").alias("lvl"), F.sum("n").alias("n"), F.max(F.col("lvl").isNull()).alias("far")
    ).collect()
    held = {(r["bx"], r["by"]): r["n"] / 2 for r in places.groupBy(*block).agg(F.sum("n").alias("n")).collect()}
    near, reached = [], []
    for r in (r for r in found if not r["far"]):
        reach = math.sqrt(2) * fine * 2.0 ** r["lvl"] + 1e-3
        rings = math.ceil(reach / side)
        around = [(r["bx"] + i, r["by"] + j) for i in range(-rings, rings + 1) for j in range(-rings, rings + 1)]
        parts, slices = math.ceil(r["n"] / HELD_UNITS), math.ceil(max(1.0, sum(held.get(b, 0.0) for b in around)) / HELD_EDGES)
        near.append((r["bx"], r["by"], parts, slices))
        reached += [(*b, r["bx"], r["by"], p, slices, reach) for b in around for p in range(parts)]
    if not near or len(reached) > REACHED:
        return None
    spark = centers.sparkSession
    ship(spark)
    blocks = spark.createDataFrame(near, "bx long, by long, parts int, slices int")
    lookup = spark.createDataFrame(reached, "cx long, cy long, bx long, by long, part int, slices int, reach double")
    placed = with_cell(centers, fine).select(unit, "x", "y", *block)
    dealt_units = placed.join(F.broadcast(blocks), ["bx", "by"]).select(
        unit, "x", "y", "bx", "by", F.pmod(F.xxhash64(unit, "x", "y"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
    )
    # Cut at the sides of blocks, a piece lies in one of them, which says what blocks may reach it. Distances are those of the whole edge.
    pieces = split_at_grid(whole.withColumns({f"_{c}": F.col(c) for c in EDGE}), side).join(F.broadcast(lookup), CELL)
    west, south = line_x(F.col("bx"), side), line_y(F.col("by"), side)
    gap_x = F.greatest(F.lit(0.0), west - ends[1], ends[0] - west - side)
    gap_y = F.greatest(F.lit(0.0), south - ends[3], ends[2] - south - side)
    pieces = pieces.filter(gap_x * gap_x + gap_y * gap_y <= F.col("reach") * F.col("reach"))
    key = ["bx", "by", "part", "slice"]
    given = pieces.select(*[F.col(f"_{c}").alias(c) for c in EDGE], "bx", "by", "part", "slices")
    dealt = given.withColumn("slice", F.pmod(F.xxhash64(*EDGE), F.col("slices")).cast("int")).drop("slices")
    kind = centers.schema[unit].dataType.simpleString()
    least = dealt_units.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(finder(unit), f"`{unit}` {kind}, distance double")
    away = [(r["bx"], r["by"]) for r in found if r["far"]]
    rest = placed.join(F.broadcast(spark.createDataFrame(away, "bx long, by long")), ["bx", "by"], "left_semi") if away else None
    return least.filter("distance IS NOT NULL").groupBy(unit).agg(F.min("distance").alias("distance")), rest


def nearest(
    units: DataFrame, layer: DataFrame, unit: str = "tot_reg_cd", carry: list[str] | None = None, areal: bool = False
) -> DataFrame:
    """Nearest feature per unit: ``distance`` and the ``carry`` columns of that feature.

    ``layer`` holds points (x, y) or edges (x1..y2); with ``areal`` the edges bound polygons and
    units inside get 0.  Equal distances are settled by the carry columns in ascending order.
    Units are absent when the layer is empty.
    """
    carry = carry or []
    centers = units.select(unit, "x", "y").repartition(unit)
    edges = as_edges(layer).select(*EDGE, *carry)
    blocks = None if carry else _by_blocks(centers, edges, unit)
    if blocks is None:
        found = _by_cells(centers, edges, unit, carry)
    else:
        found, rest = blocks
        if rest is not None:
            found = found.unionByName(_by_cells(rest.select(unit, "x", "y"), edges, unit, carry)).groupBy(unit).agg(F.min("distance").alias("distance"))
    if areal:
        # Carry columns double as the polygon's identity; without any, one tile set serves all.
        tiles = tile_polygons(edges, carry) if carry else tile_polygons(edges.withColumn("_all", F.lit(1)), ["_all"])
        inside = match_polygons(centers, tiles).groupBy(unit).agg(
            F.lit(0.0).alias("_zero"), *[F.min(c).alias(f"_{c}") for c in carry]
        )
        found = found.join(inside, unit, "left").select(
            unit,
            F.coalesce("_zero", "distance").alias("distance"),
            *[F.coalesce(f"_{c}", c).alias(c) for c in carry],
        )
    return found


def _by_cells(centers: DataFrame, edges: DataFrame, unit: str, carry: list[str]) -> DataFrame:
    """Nearest edge per unit by cells that are narrowed down."""
    grid = _finest(edges)
    if grid is None:
        fields = [F.lit(None).cast(edges.schema[c].dataType).alias(c) for c in carry]
        return centers.select(unit, F.lit(None).cast("double").alias("distance"), *fields).filter(F.lit(False))
    size, extent, bounds, rows, peak = grid
    pieces = split_at_grid(edges.dropDuplicates(), size)
    placed = centers.withColumn("ux", cell_x(F.col("x"), size)).withColumn("uy", cell_y(F.col("y"), size))
    unit_peak = measure_density(size, units=centers.select("x", "y"))["units"].peak
    cells = _candidate_cells(placed, pieces.select(*CELL).distinct(), size, extent, bounds)
    tried = cell_join(placed, cells, ["ux", "uy"], left_peak=unit_peak)
    tried = cell_join(
        tried.drop("ux", "uy"), spread(pieces, rows), left_peak=16 * unit_peak, right_peak=4 * peak
    )
    d2 = point_segment_distance2(*[F.col(c) for c in ("x", "y", *EDGE)])
    if carry:
        best = tried.groupBy(unit).agg(F.min(F.struct(d2.alias("d2"), *carry)).alias("best"))
        found = best.select(unit, F.sqrt("best.d2").alias("distance"), *[F.col(f"best.{c}").alias(c) for c in carry])
    else:
        # A plain minimum is hashed; one over structs would sort all candidates.
        found = tried.groupBy(unit).agg(F.sqrt(F.min(d2)).alias("distance"))
    return found


def _pairs_to_all(units: DataFrame, layer: DataFrame, unit: str, feature: str) -> DataFrame | None:
    """(unit, x, y, feature, edge piece) rows among which is the nearest piece of every feature for every unit."""
    edges = as_edges(layer).select(feature, *EDGE).dropDuplicates()
    grid = _finest(edges)
    if grid is None:
        return None
    size, extent, bounds, rows, peak = grid
    pieces = split_at_grid(edges, size)
    placed = units.select(unit, "x", "y").repartition(unit)
    placed = placed.withColumn("ux", cell_x(F.col("x"), size)).withColumn("uy", cell_y(F.col("y"), size))
    unit_peak = measure_density(size, units=placed.select("x", "y"))["units"].peak
    cells = _candidate_cells(placed, pieces.select(feature, *CELL).distinct(), size, extent, bounds, [feature])
    tried = cell_join(placed, cells, ["ux", "uy"], left_peak=unit_peak)
    return cell_join(tried.drop("ux", "uy"), spread(pieces, rows), [feature, *CELL], left_peak=16 * unit_peak, right_peak=4 * peak)


def distance_to_all(units: DataFrame, layer: DataFrame, unit: str, feature: str) -> DataFrame:
    """One row per unit and feature with their distance - the result itself is the full product.

    Only the product of units and features is formed: each feature's own cells are narrowed down as for the nearest
    one, so a unit measures the few pieces of a feature that may be nearest, however long the feature is.
    """
    tried = _pairs_to_all(units, layer, unit, feature)
    if tried is None:
        kind = layer.schema[feature].dataType
        return units.select(unit, F.lit(None).cast(kind).alias(feature), F.lit(None).cast("double").alias("distance")).filter(F.lit(False))
    d2 = point_segment_distance2(*[F.col(c) for c in ("x", "y", *EDGE)])
    return tried.groupBy(unit, feature).agg(F.sqrt(F.min(d2)).alias("distance"))


def distance_to_union(units: DataFrame, layer: DataFrame, unit: str) -> DataFrame:
    """Distance to a layer taken as one geometry: every unit stays, NULL when the layer is empty."""
    found = nearest(units, layer, unit)
    return units.select(unit).join(found, unit, "left")
