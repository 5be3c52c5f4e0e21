"""Circular zones around units: points, lines, polygons and raster cells inside them.

All aggregates share one plan.  A unit's circle is tiled with grid cells, coarse inside and
fine at the rim.  Cells wholly inside take a per-cell total, computed once for all units, and
only features in rim cells are tested exactly.  On thin layers the totals are skipped and
every candidate is tested.  Either way the work of a unit does not grow with the number of
features it covers.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.geometry import OUTSET, SIDES, STEP, arc_turns, in_zone, segment_length, shrink_of, with_zone_share
from ..grid import (
    BLOCK,
    CELL,
    Blocks,
    Density,
    Tiles,
    block_size,
    block_slices,
    cell_join,
    cover_steps,
    disc_cover,
    line_x,
    line_y,
    measure_density,
    nested_cover,
    pyramid,
    ring_cells,
    spread,
    tile_size,
    with_cell,
)
from ..session import ship
from .counting import area_measurer, counter, gon_overlaps, holder, matcher, measurer, zone_area, zone_start
from .overlay import clip_by_polygons, inside_signs, tile_polygons
from .segments import split_at_grid


def buffers(units: DataFrame, radii: list[float]) -> DataFrame:
    """One zone row per unit and radius; zones stay (centre, radius) and are never drawn."""
    return units.withColumn("r", F.explode(F.array(*[F.lit(float(r)) for r in radii])))


def _sums(columns: list[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def _spread(units: DataFrame, unit: str) -> DataFrame:
    """Unit coordinates in even partitions: a small table in one file would be blown up in one task."""
    return units.select(unit, "x", "y").repartition(unit)


def _mean_width(segs: DataFrame) -> float:
    """How far the segments reach along both axes, on average: they are cut that often over the cell size."""
    return segs.agg(F.avg(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1")))).first()[0] or 0.0


def _extent(x: tuple[str, ...], y: tuple[str, ...]) -> list[Column]:
    """Least x and y, greatest x and y of any of the columns."""
    least, greatest = (lambda cs: F.least(*cs) if len(cs) > 1 else F.col(cs[0])), (lambda cs: F.greatest(*cs) if len(cs) > 1 else F.col(cs[0]))
    return [F.min(least(x)), F.min(least(y)), F.max(greatest(x)), F.max(greatest(y))]


def _width_and_extent(segs: DataFrame) -> tuple[float, tuple]:
    """:func:`_mean_width` and the box of the segments, in one job."""
    width = F.avg(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1")))
    found = segs.agg(width, *_extent(("x1", "x2"), ("y1", "y2"))).first()
    return found[0] or 0.0, tuple(found[1:])


def _middles(segs: DataFrame) -> DataFrame:
    return segs.select(((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))


class _Cover:
    """Cells of all unit zones on the grid chosen for a layer."""

    def __init__(
        self, centers: DataFrame, radius: float, layer: Density, units: Density, shape: str,
        grow: float = 0.0, steps: int | None = None, width: float = 0.0,
    ):
        self.steps = cover_steps(layer) if steps is None else steps
        self.size = radius / 2 ** (self.steps + 1)
        self.layer_rows, self.layer_peak, self.unit_peak = layer.rows, layer.peak, 4 * units.peak
        block = block_size(radius, units, layer, 1 + width / self.size)
        self.blocks = Blocks(centers, block, radius, units) if block else None
        self.centers = centers = self.blocks.units if block else centers
        cells = disc_cover(centers, radius, self.steps, shrink_of(shape), grow)
        # Without halving there is nothing to gain from totals: test every touched cell.
        self.rim = (cells.filter(~F.col("covered")) if self.steps else cells).drop("covered", "lvl")
        self.whole = cells.filter(F.col("covered")).drop("covered") if self.steps else None

    def candidates(self, placed: DataFrame, cells: DataFrame | None = None) -> DataFrame:
        cells = self.rim if cells is None else cells
        if self.blocks:
            return self.blocks.join(cells, placed, CELL, F.lit(self.size))
        even = spread(placed, self.layer_rows)
        return cell_join(cells, even, left_peak=self.unit_peak, right_peak=self.layer_peak)

    def totals(self, placed: DataFrame, sums: list[str], by: list[str]) -> DataFrame | None:
        if self.whole is None:
            return None
        per_cell = pyramid(placed, self.steps, sums, by)
        if self.blocks:
            return self.blocks.join(self.whole, per_cell, ["lvl", *CELL], _side(self.size, self.steps))
        return cell_join(self.whole, per_cell, ["lvl", *CELL], left_peak=self.unit_peak)


def _side(finest: float, steps: int) -> Column:
    """Side of a cell of level ``lvl``."""
    return F.lit(finest * 2.0**steps) / F.pow(F.lit(2.0), F.col("lvl"))


def _gather(hits: DataFrame, whole: DataFrame | None, key: list[str], names: list[str]) -> DataFrame:
    if whole is not None:
        hits = hits.unionByName(whole.select(*key, *names))
    return hits.groupBy(*key).agg(*_sums(names))


def _whole_sums(
    units: DataFrame, points: DataFrame, radii: list[float], measures: dict[str, Column], unit: str, shape: str
) -> DataFrame | None:
    """Sums of whole numbers over the points in each unit's zones, an array by radius (ascending) a measure, counted tile by tile.

    None where a measure is no whole number, whose running totals would not be exact.
    """
    chosen = points.select("x", "y", *[m.alias(n) for n, m in measures.items()])
    fields = [chosen.schema[n] for n in measures]
    if any(f.dataType.typeName() not in ("byte", "short", "integer", "long") for f in fields):
        return None
    # Without any value that is not null, a sum is null.
    sums = {n: F.sum(F.coalesce(F.col(n).cast("long"), F.lit(0))) for n in measures}
    sums |= {f"_any{i}": F.count(f.name) for i, f in enumerate(fields) if f.nullable} | {"_rows": F.count(F.lit(1))}
    spots = chosen.groupBy(F.col("x").alias("px"), F.col("y").alias("py")).agg(*[s.alias(n) for n, s in sums.items()])
    centers = units.select(unit, "x", "y")
    stats = measure_density(radii[-1], points=chosen.select("x", "y").distinct(), units=centers)
    ship(units.sparkSession)
    known = spots.filter("px IS NOT NULL AND py IS NOT NULL")
    size, slices = tile_size(radii[-1], stats["units"], stats["points"], 4 + len(sums), max(1.0, len(sums) / 4))
    box = tuple(chosen.filter("x IS NOT NULL AND y IS NOT NULL").agg(*_extent(("x",), ("y",))).first())
    tiles = Tiles(centers.filter("x IS NOT NULL AND y IS NOT NULL"), size, radii[-1], stats["units"], box, slices)
    kind = centers.schema[unit].dataType.simpleString()
    columns = [f"_{i}_{n}" for i in range(len(radii)) for n in range(len(sums))]
    schema = ", ".join([f"`{unit}` {kind}", *[f"{c} long" for c in columns]])
    found = tiles.meet(with_cell(known, size, "px", "py"), counter(unit, list(sums), radii, shape), schema)
    found = found.groupBy(unit).agg(*_sums(columns))
    at = {n: k for k, n in enumerate(sums)}

    def value(i: int, k: int) -> Column:
        sum_, any_ = F.col(f"_{i}_{k}"), f"_any{k}"
        return F.when(F.col(f"_{i}_{at[any_]}") > 0, sum_) if any_ in at else F.when(F.col(f"_{i}_{at['_rows']}") > 0, sum_)

    arrays = [F.array(*[value(i, k) for i in range(len(radii))]).alias(n) for k, n in enumerate(measures)]
    return found.filter(F.col(f"_{len(radii) - 1}_{at['_rows']}") > 0).select(unit, *arrays)


def buffer_points(
    units: DataFrame,
    points: DataFrame,
    radius: float,
    measures: dict[str, Column],
    unit: str = "tot_reg_cd",
    by: list[str] | None = None,
    shape: str = "poly32",
    steps: int | None = None,
) -> DataFrame:
    """Sums of ``measures`` over the points inside each unit's zone (units without any are absent).

    ``by`` adds group columns of the points (a code, a tile) to the result key.  ``steps``
    overrides the measured choice of grid.
    """
    by, names = by or [], list(measures)
    counted = None if by or steps is not None else _whole_sums(units, points, [float(radius)], measures, unit, shape)
    if counted is not None:
        return counted.select(unit, *[F.col(n)[0].alias(n) for n in names])
    # Points at one spot act as one, however many there are.
    spots = points.select("x", "y", *by, *[m.alias(n) for n, m in measures.items()]).groupBy("x", "y", *by).agg(
        *_sums(names)
    )
    centers = _spread(units, unit)
    stats = measure_density(radius, points=spots, units=centers)
    cover = _Cover(centers, radius, stats["points"], stats["units"], shape, steps=steps)
    placed = with_cell(spots.withColumnsRenamed({"x": "px", "y": "py"}), cover.size, "px", "py")
    hits = (
        cover.candidates(placed)
        .filter(in_zone(F.col("px") - F.col("x"), F.col("py") - F.col("y"), radius, shape))
        .select(unit, *by, *names)
    )
    return _gather(hits, cover.totals(placed, names, by), [unit, *by], names)


def buffer_points_nested(
    units: DataFrame,
    points: DataFrame,
    radii: list[float],
    measures: dict[str, Column],
    unit: str = "tot_reg_cd",
    shape: str = "poly32",
    steps: int | None = None,
) -> DataFrame:
    """Sums of ``measures`` over the points in each of a unit's concentric zones, as arrays in the order of ``radii``.

    The layer is read, placed on the grid and shuffled once for all radii and measures: a point or a covered cell
    counts for the smallest zone that holds it, and larger zones add up what smaller ones found. Units without any
    point in their largest zone are absent.
    """
    names, rising = list(measures), sorted(set(float(r) for r in radii))
    counted = None if steps is not None else _whole_sums(units, points, rising, measures, unit, shape)
    if counted is not None:
        at = [rising.index(float(r)) for r in radii]
        return counted.select(unit, *[F.array(*[F.col(n)[i] for i in at]).alias(n) for n in names])
    spots = points.select("x", "y", *[m.alias(n) for n, m in measures.items()]).groupBy("x", "y").agg(*_sums(names))
    centers = _spread(units, unit)
    stats = measure_density(rising[-1], points=spots, units=centers)
    steps = cover_steps(stats["points"]) if steps is None else steps
    size = rising[-1] / 2 ** (steps + 1)
    block = block_size(rising[-1], stats["units"], stats["points"])
    blocks = Blocks(centers, block, rising[-1], stats["units"]) if block else None
    cells = nested_cover(blocks.units if blocks else centers, rising, steps, shrink_of(shape))
    placed = with_cell(spots.withColumnsRenamed({"x": "px", "y": "py"}), size, "px", "py")
    peaks = {"left_peak": 4 * stats["units"].peak}
    # Without halving there is nothing to gain from totals: test every touched cell.
    rim = (cells.filter("band IS NULL") if steps else cells).drop("band", "lvl")
    if blocks:
        near = blocks.join(rim, placed, CELL, F.lit(size))
    else:
        near = cell_join(rim, spread(placed, stats["points"].rows), right_peak=stats["points"].peak, **peaks)
    band = F.lit(None).cast("int")
    for i, r in reversed(list(enumerate(rising))):
        band = F.when(in_zone(F.col("px") - F.col("x"), F.col("py") - F.col("y"), r, shape), F.lit(i)).otherwise(band)
    hits = near.filter(in_zone(F.col("px") - F.col("x"), F.col("py") - F.col("y"), rising[-1], shape)).select(unit, band.alias("band"), *names)
    if steps:
        settled, per_cell = cells.filter("band IS NOT NULL"), pyramid(placed, steps, names, [])
        if blocks:
            whole = blocks.join(settled, per_cell, ["lvl", *CELL], _side(size, steps))
        else:
            whole = cell_join(settled, per_cell, ["lvl", *CELL], **peaks)
        hits = hits.unionByName(whole.select(unit, "band", *names))
    upto = [rising.index(float(r)) for r in radii]
    sums = [F.array(*[F.sum(F.when(F.col("band") <= i, F.col(n))) for i in upto]).alias(n) for n in names]
    return hits.groupBy(unit).agg(*sums)


def _line_sums(centers: DataFrame, lines: DataFrame, names: list[str], radius: float, unit: str, shape: str) -> DataFrame:
    """Sums of weight x length of lines inside each unit's zone, tile by tile."""
    # A line without a weight counts nowhere.
    known = lines.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in lines.columns))
    stats = measure_density(radius, lines=_middles(lines), units=centers)
    width, box = _width_and_extent(known)
    size, slices = tile_size(radius, stats["units"], stats["lines"], 4 + len(names), 1 + 8 * width / radius)
    ship(centers.sparkSession)
    tiles = Tiles(centers.filter("x IS NOT NULL AND y IS NOT NULL"), size, radius, stats["units"], box, slices)
    kind = centers.schema[unit].dataType.simpleString()
    schema = ", ".join([f"`{unit}` {kind}", *[f"_{i} double" for i in range(len(names))], "_rows long"])
    found = tiles.meet(split_at_grid(known, size), measurer(unit, names, radius, shape), schema)
    return found.filter("_rows > 0").groupBy(unit).agg(*[F.sum(f"_{i}").alias(n) for i, n in enumerate(names)])


def buffer_lines(
    units: DataFrame,
    segs: DataFrame,
    radius: float,
    weights: dict[str, Column],
    unit: str = "tot_reg_cd",
    shape: str = "poly32",
    steps: int | None = None,
) -> DataFrame:
    """Sums of weight x length of the line parts inside each unit's zone."""
    names = list(weights)
    centers = _spread(units, unit)
    lines = segs.select("x1", "y1", "x2", "y2", *[w.alias(n) for n, w in weights.items()])
    if steps is None and len(names) == 1:
        doubled = lines.withColumn(names[0], F.col(names[0]).cast("double"))
        return _line_sums(units.select(unit, "x", "y"), doubled, names, float(radius), unit, shape)
    stats = measure_density(radius, lines=_middles(lines), units=centers)
    cover = _Cover(centers, radius, stats["lines"], stats["units"], shape, steps=steps, width=_mean_width(lines))
    length = segment_length(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    pieces = split_at_grid(lines, cover.size)
    pieces = pieces.withColumns({n: F.col(n) * length for n in names})
    held = with_zone_share(cover.candidates(pieces), _from_center(), radius, shape)
    hits = held.select(unit, *[(F.col(n) * F.col("_share")).alias(n) for n in names])
    return _gather(hits, cover.totals(pieces, names, []), [unit], names)


def _from_center() -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(a) - F.col(b) for a, b in (("x1", "x"), ("y1", "y"), ("x2", "x"), ("y2", "y")))


def buffer_edges(units: DataFrame, radius: float) -> DataFrame:
    """The 32 sides (ax, ay, bx, by) of each unit's polygon buffer, counter-clockwise."""
    sides = F.array(
        *[
            F.struct(
                F.lit(radius * math.cos(k * STEP)).alias("c1"),
                F.lit(radius * math.sin(k * STEP)).alias("s1"),
                F.lit(radius * math.cos((k + 1) * STEP)).alias("c2"),
                F.lit(radius * math.sin((k + 1) * STEP)).alias("s2"),
            )
            for k in range(SIDES)
        ]
    )
    return units.withColumn("_side", F.explode(sides)).select(
        *units.columns,
        (F.col("x") + F.col("_side.c1")).alias("ax"),
        (F.col("y") + F.col("_side.s1")).alias("ay"),
        (F.col("x") + F.col("_side.c2")).alias("bx"),
        (F.col("y") + F.col("_side.s2")).alias("by"),
    )


# Groups of polygons that a tile measures one by one.
AREA_GROUPS = 100


def _area_sums(centers: DataFrame, ring: DataFrame, by: list[str], radius: float, unit: str, shape: str) -> DataFrame | None:
    """Area of each unit's zone covered by polygons, boundary by tiles; None for more groups than a tile should measure one by one.

    Only one place of a unit's outline is looked up among the polygons; where boundary crosses the outline tells the rest.
    """
    if not by or ring.select(*by).distinct().limit(AREA_GROUPS + 1).count() > AREA_GROUPS:
        return None
    stats = measure_density(radius, lines=_middles(ring), units=centers)
    ship(centers.sparkSession)
    known = centers.filter("x IS NOT NULL AND y IS NOT NULL")
    whole = ring.filter("x1 IS NOT NULL AND y1 IS NOT NULL AND x2 IS NOT NULL AND y2 IS NOT NULL")
    width, box = _width_and_extent(whole)
    size, slices = tile_size(radius, stats["units"], stats["lines"], 8 + len(by), 1 + 8 * width / radius)
    tiles = Tiles(known, size, radius, stats["units"], box, slices)
    pieces = split_at_grid(whole.withColumns({f"_{c}": F.col(c) for c in ("x1", "y1", "x2", "y2")}), size)
    fields = [f"`{c}` {d.schema[c].dataType.simpleString()}" for d, cs in ((centers, [unit]), (ring, by)) for c in cs]
    outline = tiles.meet(pieces, area_measurer(unit, by, radius, shape), ", ".join([*fields, "area double"]))
    dx, dy = zone_start(radius, shape)
    start = _spread(known, unit).select(unit, (F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    full = F.lit(zone_area(radius, shape))
    inside = inside_signs(start, tile_polygons(ring, by)).select(unit, *by, (F.col("_s") * full).alias("area"))
    return _gather(outline, inside, [unit, *by], ["area"])


def buffer_areas(
    units: DataFrame,
    edges: DataFrame,
    by: list[str],
    radius: float,
    unit: str = "tot_reg_cd",
    steps: int | None = None,
    shape: str = "poly32",
    blocks: bool = True,
) -> DataFrame:
    """Area of each unit's 32-gon, or disc, covered by polygons, summed per unit and ``by``.

    By Green's theorem the overlap area is half the sum of the cross products along polygon
    boundary inside the buffer plus buffer boundary inside the polygons.  Both parts are plain
    sums over (unit, edge) pairs, so polygons are never assembled; polygons of one ``by`` group
    that overlap each other count each on its own. Without ``blocks`` the boundary is not measured tile by tile, which
    few wide polygons do not need. The outline of a disc is measured by the angles at which polygon
    boundary crosses it, so it is as exact as that of a 32-gon and cheaper.
    """
    ring = edges.select(*by, "x1", "y1", "x2", "y2")
    if blocks and steps is None:
        measured = _area_sums(units.select(unit, "x", "y"), ring, by, float(radius), unit, shape)
        if measured is not None:
            return measured
    centers = _spread(units, unit)
    stats = measure_density(radius, lines=_middles(ring), units=centers)
    cover = _Cover(centers, radius, stats["lines"], stats["units"], shape, steps=steps, width=_mean_width(ring))
    pieces = split_at_grid(ring, cover.size)
    x1, y1, x2, y2 = _from_center()
    held = with_zone_share(cover.candidates(pieces), (x1, y1, x2, y2), radius, shape)
    part = F.col("_share") * (x1 * y2 - x2 * y1)
    if shape == "disc":
        part = part + F.lit(float(radius) ** 2) * arc_turns((x1, y1, x2, y2), radius)
    outline = held.select(unit, *by, (part / 2).alias("area"))
    if cover.steps:
        outline = outline.unionByName(_whole_cell_outline(cover, pieces, by, unit))
    tiles = tile_polygons(ring, by)
    if shape == "disc":
        start = centers.select(
            unit, (F.col("x") + radius * math.cos(OUTSET)).alias("x"), (F.col("y") + radius * math.sin(OUTSET)).alias("y")
        )
        inside = inside_signs(start, tiles).select(unit, *by, (F.col("_s") * F.lit(math.pi * radius * radius)).alias("area"))
        return _gather(outline, inside, [unit, *by], ["area"])
    sides = clip_by_polygons(buffer_edges(centers, radius), tiles)
    ax, ay, bx, by_ = (F.col(a) - F.col(b) for a, b in (("ax", "x"), ("ay", "y"), ("bx", "x"), ("by", "y")))
    inside = sides.select(unit, *by, (F.col("share") * (ax * by_ - bx * ay) / 2).alias("area"))
    return _gather(outline, inside, [unit, *by], ["area"])


def _whole_cell_outline(cover: _Cover, pieces: DataFrame, by: list[str], unit: str) -> DataFrame:
    """Cross products of boundary in covered cells, moved from a fixed corner to each centre.

    cross(a-c, b-c) = cross(a-o, b-o) + cross(o-c, b-a), so a cell needs only three sums.  The
    corner o is that of the level-0 cell, which all finer cells in it share.
    """
    span = 2.0**cover.steps
    ox = line_x(F.floor(F.col("cx") / span) * span, cover.size)
    oy = line_y(F.floor(F.col("cy") / span) * span, cover.size)
    local = (F.col("x1") - ox) * (F.col("y2") - oy) - (F.col("x2") - ox) * (F.col("y1") - oy)
    sums = pieces.select(
        *CELL, *by, local.alias("_c"), (F.col("x2") - F.col("x1")).alias("_dx"), (F.col("y2") - F.col("y1")).alias("_dy")
    )
    rows = cover.totals(sums, ["_c", "_dx", "_dy"], by)
    coarse = cover.size * span
    scale = F.pow(F.lit(2.0), F.col("lvl"))
    rx = line_x(F.floor(F.col("cx") / scale), coarse) - F.col("x")
    ry = line_y(F.floor(F.col("cy") / scale), coarse) - F.col("y")
    return rows.select(unit, *by, ((F.col("_c") + rx * F.col("_dy") - ry * F.col("_dx")) / 2).alias("area"))


def _held_sums(
    centers: DataFrame, segs: DataFrame, names: list[str], radius: float, unit: str, feature: str
) -> DataFrame | None:
    """Sums of whole numbers over the features that each unit's 32-gon holds, tile by tile; None where a measure is no whole number.
    """
    if any(segs.schema[n].dataType.typeName() not in ("byte", "short", "integer", "long") for n in names):
        return None
    corners = F.collect_list(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))))
    # A feature without all its corners is never held.
    known = F.col("x1").isNotNull() & F.col("y1").isNotNull() & F.col("x2").isNotNull() & F.col("y2").isNotNull()
    shapes = segs.groupBy(feature).agg(
        F.min(known).alias("_known"), F.array_distinct(F.flatten(corners)).alias("_at"),
        *[((F.min(F.least(a, b)) + F.max(F.greatest(a, b))) / 2).alias(m) for m, a, b in (("mx", "x1", "x2"), ("my", "y1", "y2"))],
        *[F.first(n).cast("long").alias(f"_v{i}") for i, n in enumerate(names)],
    )
    shapes = shapes.filter("_known").select(
        "mx", "my", F.col("_at.x").alias("xs"), F.col("_at.y").alias("ys"), *[f"_v{i}" for i in range(len(names))]
    )
    spans = [F.min(F.least(a, b)).alias(m) for m, a, b in (("x", "x1", "x2"), ("y", "y1", "y2"))]
    spans += [F.max(F.greatest(a, b)).alias(m) for m, a, b in (("qx", "x1", "x2"), ("qy", "y1", "y2"))]
    places = segs.filter(known).groupBy(feature).agg(*spans, F.count(F.lit(1)).alias("_n"))
    stats = measure_density(radius, features=places.select("x", "y"), units=centers)
    edges, *box = places.agg(F.avg("_n"), F.min("x"), F.min("y"), F.max("qx"), F.max("qy")).first()
    load = 4 + 2 * (edges or 1.0) + len(names)
    size, slices = tile_size(radius, stats["units"], stats["features"], load + 4, load / 4)
    ship(centers.sparkSession)
    tiles = Tiles(centers.filter("x IS NOT NULL AND y IS NOT NULL"), size, radius, stats["units"], tuple(box), slices)
    kind = centers.schema[unit].dataType.simpleString()
    schema = ", ".join([f"`{unit}` {kind}", *[f"_{i} long" for i in range(len(names))], "_rows long"])
    run = holder(unit, [f"_v{i}" for i in range(len(names))], radius, "poly32")
    found = tiles.meet(with_cell(shapes, size, "mx", "my").drop("mx", "my"), run, schema)
    return found.filter("_rows > 0").groupBy(unit).agg(*[F.sum(f"_{i}").alias(n) for i, n in enumerate(names)])


def buffer_holds(
    units: DataFrame,
    segs: DataFrame,
    radius: float,
    measures: dict[str, Column],
    unit: str = "tot_reg_cd",
    feature: str = "fid",
    steps: int | None = None,
) -> DataFrame:
    """Sums of ``measures`` over line or polygon features lying wholly inside each unit's 32-gon.

    A convex zone holds a feature when it holds all its corners.  The feature is filed under the
    cell of its westernmost corner; a cell that is covered with the feature's width to spare
    takes the total.  Near the rim the bounding box settles most features, and only the rest
    is looked at corner by corner.
    """
    names = list(measures)
    if steps is None:
        valued = segs.select(feature, "x1", "y1", "x2", "y2", *[m.alias(n) for n, m in measures.items()])
        counted = _held_sums(units.select(unit, "x", "y"), valued, names, float(radius), unit, feature)
        if counted is not None:
            return counted
    centers = _spread(units, unit)
    first, second = (F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in (("x1", "y1"), ("x2", "y2")))
    boxes = (
        segs.groupBy(feature)
        .agg(
            F.min(F.least(first, second)).alias("_west"),
            F.max(F.greatest("x1", "x2")).alias("qx"),
            F.min(F.least("y1", "y2")).alias("py"),
            F.max(F.greatest("y1", "y2")).alias("qy"),
            F.max(F.greatest(first, second)).alias("_east"),
            F.count(F.lit(1)).alias("_edges"),
            *[F.first(m).alias(n) for n, m in measures.items()],
        )
        .withColumns({"px": F.col("_west.x"), "wy": F.col("_west.y"), "ey": F.col("_east.y")})
        .drop("_west", "_east")
    )
    widths = F.greatest(F.col("qx") - F.col("px"), F.col("qy") - F.col("py"))
    stats = measure_density(radius, boxes=boxes.select(F.col("px").alias("x"), F.col("wy").alias("y")), units=centers)
    shape = boxes.agg(F.avg(widths).alias("width"), F.max("_edges").alias("edges")).first()
    if steps is None:
        # Cells much smaller than the features could never be covered with room to spare.
        steps = cover_steps(stats["boxes"])
        while steps and radius / 2 ** (steps + 1) < 2 * (shape["width"] or 0.0):
            steps -= 1
    size = radius / 2 ** (steps + 1)
    cover = _Cover(centers, radius, stats["boxes"], stats["units"], "poly32", grow=size, steps=steps)
    filed = with_cell(boxes, size, "px", "wy").withColumn("_wide", widths > F.lit(size))
    near = cover.candidates(filed)
    if steps:
        # Features wider than a cell get no totals: look them up in covered cells of the last level too.
        every = ring_cells(cover.centers, size, radius)
        near = cover.candidates(filed.filter(~F.col("_wide"))).unionByName(cover.candidates(filed.filter(F.col("_wide")), every))

    def inside(a: str, b: str) -> Column:
        return in_zone(F.col(a) - F.col("x"), F.col(b) - F.col("y"), radius, "poly32")

    # The westernmost and the easternmost corner are the two ends of a single edge; otherwise a
    # box wholly inside settles the matter, and one that sticks out does not.
    near = near.filter(inside("px", "wy") & inside("qx", "ey"))
    boxed = inside("px", "py") & inside("qx", "qy") & inside("px", "qy") & inside("qx", "py")
    settled = (F.col("_edges") == 1) | boxed
    sure = near.filter(settled).select(unit, *names)
    if (shape["edges"] or 0) > 1:
        unsure = near.filter(~settled).select(unit, "x", "y", feature, "_edges", *names)
        corners = segs.select(feature, "x1", "y1", "x2", "y2")
        checked = (
            unsure.join(corners, feature)
            .filter(inside("x1", "y1") & inside("x2", "y2"))
            .groupBy(unit, feature)
            .agg(
                F.count(F.lit(1)).alias("_in"), F.first("_edges").alias("_edges"),
                *[F.first(n).alias(n) for n in names],
            )
            .filter(F.col("_in") == F.col("_edges"))
            .select(unit, *names)
        )
        sure = sure.unionByName(checked)
    small = filed.filter(~F.col("_wide"))
    return _gather(sure, cover.totals(small, names, []), [unit], names)


def _near(
    units: DataFrame, points: DataFrame, radius: float, shape: str, hole: float, kept: list[str], spots: DataFrame | None = None
) -> DataFrame:
    """Every unit's own columns with the ``kept`` ones of each point (px, py) in its zone or ring, found block by block."""

    def placed(df: DataFrame, *at: str) -> DataFrame:
        return df.filter(" AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(`{c}`)" for c in at))

    units, points = placed(units, "x", "y"), placed(points, "px", "py")
    spots = placed((units if spots is None else spots).select("x", "y"), "x", "y")
    stats = measure_density(radius, points=points.select(F.col("px").alias("x"), F.col("py").alias("y")), units=spots)
    size, slices = block_slices(radius, stats["units"], stats["points"], (4 + len(kept)) / 4)
    ship(units.sparkSession)
    blocks = Blocks(units, size, radius, stats["units"], spots)
    dealt = blocks.deal(points.select("px", "py", *[c for c in kept if c not in ("px", "py")]), F.col("px"), F.col("py"), F.lit(0.0))
    found = StructType([points.schema[c] for c in kept])
    schema = StructType([*units.schema.fields, StructField("_near", ArrayType(found))])
    run = matcher([*BLOCK, "_slice"], kept, float(radius), shape, float(hole))
    return blocks.meet(dealt, run, schema, slices).select(*units.columns, F.inline("_near"))


def buffer_pairs(
    units: DataFrame,
    points: DataFrame,
    radius: float,
    unit: str = "tot_reg_cd",
    shape: str = "poly32",
    hole: float = 0.0,
    keep: list[str] | None = None,
    spots: DataFrame | None = None,
) -> DataFrame:
    """(unit, point) rows of the points inside each zone, or in the ring between hole and radius.

    Keeps the unit's and the point's own columns (point coordinates as px, py), of the latter only those in ``keep`` if given.
    ``spots`` may give the places of the units, and of others, where ``units`` cost more to make. The result has one row per pair; :func:`buffer_points` gives sums without forming pairs.
    """
    points = points.withColumnsRenamed({"x": "px", "y": "py"})
    return _near(units, points, radius, shape, hole, points.columns if keep is None else keep, spots)


def buffer_overlaps(units: DataFrame, radius: float, unit: str = "tot_reg_cd", shape: str = "poly32") -> DataFrame:
    """Overlap area of every two 32-gon, or disc, buffers of one radius that meet (a buffer meets itself).

    Equal 32-gons map onto each other through the midpoint of their centres, so their common area follows from
    where their outlines cross, pair by pair in arrays: a pair stays one row. Two equal discs share a lens, whose area
    follows from the distance of their centres.
    """
    centers = units.select(unit, "x", "y")
    other = centers.select(F.col(unit).alias("other"), F.col("x").alias("px"), F.col("y").alias("py"))
    pairs = _near(centers, other, 2 * radius, "disc", 0.0, ["other", "px", "py"])
    dx, dy = F.col("px") - F.col("x"), F.col("py") - F.col("y")
    pairs = pairs.filter(dx * dx + dy * dy < F.lit(4.0 * radius * radius))
    if shape == "disc":
        apart = F.sqrt(dx * dx + dy * dy)
        lens = 2 * radius * radius * F.acos(apart / (2 * radius)) - apart / 2 * F.sqrt(4 * radius * radius - apart * apart)
        return pairs.select(unit, "other", lens.alias("area"))
    ship(units.sparkSession)

    @F.pandas_udf("double")
    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(gon_overlaps(x.to_numpy(), y.to_numpy(), radius))

    # Spark would measure every pair twice, once for the filter and once for the result, unless told that it must not.
    return pairs.select(unit, "other", common.asNondeterministic()(dx, dy).alias("area")).filter(F.col("area") > 0)
