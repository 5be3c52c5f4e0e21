"""Plane geometry as Spark columns: no UDF, everything stays in generated JVM code."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = 32
STEP = 2 * math.pi / SIDES
APOTHEM = math.cos(STEP / 2)

# Distance (m) under which a boundary piece counts as lying on another boundary.
TOUCH = 1e-6


def in_disc(dx: Column, dy: Column, r: float) -> Column:
    """Within distance r, rim included."""
    return dx * dx + dy * dy <= F.lit(float(r) * float(r))


def in_poly32(dx: Column, dy: Column, r: float) -> Column:
    """Strictly inside the 32-gon with corners at distance r (first corner due east)."""
    apothem = r * APOTHEM
    d2 = dx * dx + dy * dy
    turn = F.pmod(F.atan2(dy, dx), F.lit(STEP)) - F.lit(STEP / 2)
    return (
        F.when(d2 < F.lit(apothem * apothem * (1 - 1e-9)), F.lit(True))
        .when(d2 >= F.lit(float(r) * float(r)), F.lit(False))
        .otherwise(F.sqrt(d2) * F.cos(turn) < F.lit(apothem))
    )


def in_zone(dx: Column, dy: Column, r: float, shape: str) -> Column:
    if shape == "disc":
        return in_disc(dx, dy, r)
    if shape == "poly32":
        return in_poly32(dx, dy, r)
    raise ValueError(f"Unknown zone shape '{shape}'. Valid shapes are: poly32, disc")


def shrink_of(shape: str) -> float:
    return APOTHEM if shape == "poly32" else 1.0


def with_zone_share(
    df: DataFrame, ends: tuple[Column, Column, Column, Column], r: float, shape: str, out: str = "_share"
) -> DataFrame:
    """Share of each segment inside a circular zone around the origin, in column ``out``.

    ``ends`` are the segment's ends relative to the centre.  Most rows whose segment misses the
    zone are dropped.  The line's two crossings with the circumscribed circle come from a quadratic.
    A 32-gon's boundary is crossed within half a side of there, so the two sides that reach so
    far decide where the polygon is entered and left.
    """
    c = F.col
    df = df.withColumns(dict(zip(("_ax", "_ay", "_bx", "_by"), ends)))
    df = df.withColumns({"_dx": c("_bx") - c("_ax"), "_dy": c("_by") - c("_ay")})
    # Only cheap tests filter rows here: Spark moves filters into the join below and would
    # repeat whatever they are computed from.  What slips through gets share 0.
    cross = c("_ax") * c("_dy") - c("_ay") * c("_dx")
    len2 = c("_dx") * c("_dx") + c("_dy") * c("_dy")
    reach = F.lit(float(r))
    df = df.filter(
        (cross * cross < len2 * reach * reach)
        & (F.least("_ax", "_bx") < reach)
        & (F.greatest("_ax", "_bx") > -reach)
        & (F.least("_ay", "_by") < reach)
        & (F.greatest("_ay", "_by") > -reach)
    )
    df = df.withColumns(
        {
            "_qa": len2,
            "_qb": c("_ax") * c("_dx") + c("_ay") * c("_dy"),
            "_qc": c("_ax") * c("_ax") + c("_ay") * c("_ay") - reach * reach,
        }
    ).withColumn("_root", F.sqrt(F.greatest(F.lit(0.0), c("_qb") * c("_qb") - c("_qa") * c("_qc"))))
    df = df.withColumns({"_lo": (-c("_qb") - c("_root")) / c("_qa"), "_hi": (-c("_qb") + c("_root")) / c("_qa")})
    work = ["_ax", "_ay", "_bx", "_by", "_dx", "_dy", "_qa", "_qb", "_qc", "_root", "_lo", "_hi"]
    enter, leave = [F.lit(0.0)], [F.lit(1.0)]
    if shape == "disc":
        enter.append(c("_lo"))
        leave.append(c("_hi"))
    elif shape == "poly32":
        sides = {
            f"_m{end}{k}": (
                F.floor((F.atan2(c("_ay") + c(t) * c("_dy"), c("_ax") + c(t) * c("_dx")) + F.lit(turn)) / F.lit(STEP))
                + F.lit(0.5)
            ) * F.lit(STEP)
            for end, t in (("i", "_lo"), ("o", "_hi"))
            for k, turn in enumerate((-STEP / 2, STEP / 2))
        }
        df = df.withColumns(sides)
        df = df.withColumns({f"{n}c": F.cos(n) for n in sides} | {f"{n}s": F.sin(n) for n in sides})
        rates = {f"{n}r": c(f"{n}c") * c("_dx") + c(f"{n}s") * c("_dy") for n in sides}
        rooms = {f"{n}g": F.lit(r * APOTHEM) - (c(f"{n}c") * c("_ax") + c(f"{n}s") * c("_ay")) for n in sides}
        df = df.withColumns(rates | rooms)
        for n in sides:
            rate, room = c(f"{n}r"), c(f"{n}g")
            enter.append(F.when(rate < 0, room / rate).when((rate == 0) & (room <= 0), F.lit(2.0)))
            leave.append(F.when(rate > 0, room / rate))
        work += [f"{n}{x}" for n in sides for x in ("", "c", "s", "r", "g")]
    else:
        raise ValueError(f"Unknown zone shape '{shape}'. Valid shapes are: poly32, disc")
    return df.withColumn(out, F.greatest(F.lit(0.0), F.least(*leave) - F.greatest(*enter))).drop(*work)


# Angle (rad) at which a circle's outline begins: no survey coordinate lies there.
OUTSET = 0.7390851332151607


def arc_turns(ends: tuple[Column, Column, Column, Column], r: float) -> Column:
    """What a polygon edge adds to the angle of a circle's outline that lies inside the polygon.

    The polygon lies left of its edges. Going round from ``OUTSET``, the outline leaves it where an edge comes into the
    circle and is inside again where one goes out, each until the round is over: the angles left of the round add up,
    with the whole round for a polygon that holds the starting point. ``ends`` are relative to the centre. Whether an
    edge crosses follows from its ends alone, so edges that share an end agree.
    """
    ax, ay, bx, by = ends
    dx, dy = bx - ax, by - ay
    reach = F.lit(float(r) * float(r))
    in_a, in_b = ax * ax + ay * ay < reach, bx * bx + by * by < reach
    qa, qb, qc = dx * dx + dy * dy, ax * dx + ay * dy, ax * ax + ay * ay - reach
    root = F.sqrt(F.greatest(F.lit(0.0), qb * qb - qa * qc))

    def left(t: Column) -> Column:
        return F.lit(2 * math.pi) - F.pmod(F.atan2(ay + t * dy, ax + t * dx) - F.lit(OUTSET), F.lit(2 * math.pi))

    enter, leave = left(F.try_divide(-qb - root, qa)), left(F.try_divide(-qb + root, qa))
    through = ~in_a & ~in_b & (qb < 0) & (qb + qa > 0) & (qb * qb > qa * qc)
    turn = F.when(in_a & ~in_b, leave).when(~in_a & in_b, -enter).when(through, leave - enter)
    return F.coalesce(turn, F.lit(0.0))


def segment_length(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot(x2 - x1, y2 - y1)


def point_segment_distance2(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance from a point to a segment (a point when both ends agree)."""
    dx, dy = x2 - x1, y2 - y1
    len2 = dx * dx + dy * dy
    along = F.coalesce(F.try_divide((px - x1) * dx + (py - y1) * dy, len2), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey


def crossing_sign(px: Column, py: Column) -> Column:
    """Tile row's sign ``s`` when the ray from the point to the east meets it, else 0.

    Rings run with their interior on the left, so the signs of all edges of a polygon add up
    to 1 inside and 0 outside: a plain sum, which Spark can combine on the map side.  Edges are
    stored lower end first and tested by their own ends, so that both polygons at a common edge
    reach the same verdict and a point on it belongs to exactly one.
    """
    c = F.col
    east = c("x1") + (py - c("y1")) * (c("x2") - c("x1")) / (c("y2") - c("y1"))
    return F.when((c("lo") <= py) & (py < c("hi")) & (px < east), c("s")).otherwise(F.lit(0))


def with_inside_share(df: DataFrame, out: str, touch: float = TOUCH) -> DataFrame:
    """Signed share of segment (ax, ay, bx, by) lying west of a tile row's edge.

    This is :func:`crossing_sign` averaged along the segment, in closed form.  Summed over the
    edges of a polygon it gives the share of the segment inside the polygon - for any polygon,
    with no sorting of crossings.  A stretch that lies on the edge counts half, which makes
    areas of polygons with common boundaries come out right; ``touch`` is how near that is.
    """
    c = F.col
    df = df.filter(
        (F.least("ay", "by") <= c("hi"))
        & (F.greatest("ay", "by") >= c("lo"))
        & (F.least("ax", "bx") <= F.greatest("x1", "x2") + F.lit(touch))
    )
    # No filters beyond this point: Spark would push them, and all they are made of, into the join.
    df = df.withColumns({"_dy": c("by") - c("ay"), "_slope": (c("x2") - c("x1")) / (c("y2") - c("y1"))})
    flat = c("_dy") == 0
    ta, tb = F.try_divide(c("lo") - c("ay"), c("_dy")), F.try_divide(c("hi") - c("ay"), c("_dy"))
    df = df.withColumns(
        {
            "_t0": F.when(flat, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(ta, tb))),
            "_t1": F.when(flat, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(ta, tb))),
        }
    )

    def gap(t: Column) -> Column:
        return c("x1") + (c("ay") + t * c("_dy") - c("y1")) * c("_slope") - (c("ax") + t * (c("bx") - c("ax")))

    df = df.withColumns({"_g0": gap(c("_t0")), "_g1": gap(c("_t1"))})
    # Distance across the edge follows from the gap measured along x.
    lean = F.sqrt(F.lit(1.0) + c("_slope") * c("_slope"))
    on_edge = (F.abs("_g0") < F.lit(touch) * lean) & (F.abs("_g1") < F.lit(touch) * lean)
    west = (
        F.when(on_edge, F.lit(0.5))
        .when((c("_g0") >= 0) & (c("_g1") >= 0), F.lit(1.0))
        .when((c("_g0") <= 0) & (c("_g1") <= 0), F.lit(0.0))
        .otherwise(F.try_divide(F.greatest("_g0", "_g1"), F.abs("_g0") + F.abs("_g1")))
    )
    # A level segment at the height of an edge's end sees that edge on one side only.
    level = F.when(flat & ((c("ay") == c("lo")) | (c("ay") == c("hi"))), F.lit(0.5)).otherwise(F.lit(1.0))
    share = c("s") * level * west * F.greatest(F.lit(0.0), c("_t1") - c("_t0"))
    return df.withColumn(out, share).drop("_dy", "_slope", "_t0", "_t1", "_g0", "_g1")


def edge_contact(near: float) -> dict[str, Column]:
    """How segment (ax, ay, bx, by) meets edge (x1, y1, x2, y2): ``along``, the length that lies on it, and ``crossed``,
    whether both ends of each lie beyond the other's line by more than ``near``."""
    c = F.col
    ex, ey, dx, dy = c("x2") - c("x1"), c("y2") - c("y1"), c("bx") - c("ax"), c("by") - c("ay")
    edge, own = F.sqrt(ex * ex + ey * ey), F.sqrt(dx * dx + dy * dy)

    def off(px: str, py: str, qx: str, qy: str, ux: Column, uy: Column, size: Column) -> Column:
        return F.try_divide(ux * (c(py) - c(qy)) - uy * (c(px) - c(qx)), size)

    a, b = (off(*p, "x1", "y1", ex, ey, edge) for p in (("ax", "ay"), ("bx", "by")))
    p, q = (off(*v, "ax", "ay", dx, dy, own) for v in (("x1", "y1"), ("x2", "y2")))
    beyond = lambda u, v: (F.least(u, v) < -near) & (F.greatest(u, v) > near)
    s, t = (F.try_divide((c(m) - c("x1")) * ex + (c(n) - c("y1")) * ey, edge) for m, n in (("ax", "ay"), ("bx", "by")))
    shared = F.least(F.greatest(s, t), edge) - F.greatest(F.least(s, t), F.lit(0.0))
    along = F.when((F.abs(a) <= near) & (F.abs(b) <= near), F.greatest(F.lit(0.0), shared)).otherwise(F.lit(0.0))
    return {"along": F.coalesce(along, F.lit(0.0)), "crossed": F.coalesce(beyond(a, b) & beyond(p, q), F.lit(False))}
