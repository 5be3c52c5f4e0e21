"""Shared parts of the queries: layers, rounding, and SQL building blocks for the oracle."""

from __future__ import annotations

import math
import os
from collections.abc import Callable

import fixture_layers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.operators.raster import RasterGrid
from terracell.plans.registry import compute
from terracell.session import scratch_root, tune
from terracell.sources.layers import POLLUTANTS, Layers

PI = math.pi
# Georeference of the derived rasters.
GRID = RasterGrid(950_000.0, 1_940_000.0, 200.0)
# Derived layers that hold for all years, or all versions.
TIMELESS, UNVERSIONED = ("border_edge", "road_lane"), ("landuse_edge",)
COS = math.cos(PI / 32)

# All emission amounts of the fixture are multiples of 1/800000.
AMOUNTS = 800_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_registered: dict[str, str] = {}


def prepare(spark: SparkSession, sf_dir: str) -> Layers:
    """Layers derived from the driver's tables, as views of this session."""
    tune(spark)
    scratch_root(spark)
    # Temporary views belong to one session of one application.
    session = f"{spark.sparkContext.applicationId}/{spark._jsparkSession.hashCode()}"
    if _registered.get(session) != sf_dir:
        fixture_layers.register(spark, sf_dir)
        _registered[session] = sf_dir
    return layers(spark)


def layers(spark: SparkSession) -> Layers:
    def resolve(name: str) -> DataFrame:
        if name in ("sgis_bnu", "sgis_bem", "sgis_ho_gb"):
            return spark.table("sgis_wide")
        df = spark.table(name)
        if name.startswith("emission_") and name != "emission_cell":
            # Whole multiples of the smallest amount add up exactly, whatever the order.
            df = df.withColumns({p: F.round(F.col(p) * AMOUNTS).cast("bigint") for p in POLLUTANTS})
        return df

    return Layers(resolve, TIMELESS, UNVERSIONED)


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query ``f(spark, layers)`` and its oracle."""

    def add(build: Callable[[SparkSession, Layers], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: build(spark, prepare(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = fixture_layers.with_layers(sql)
        return build

    return add


def amounts(df: DataFrame) -> DataFrame:
    """Emission columns back in their own unit."""
    return df.select(*[(F.col(c) / AMOUNTS).alias(c) if c.startswith("EM_") else F.col(c) for c in df.columns])


def rounded(df: DataFrame, digits: int = 4, **own: int) -> DataFrame:
    """Doubles rounded, as summation order differs between engines."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind == "double":
            c = F.round(c, own.get(f.name, digits))
        columns.append(c.alias(f.name))
    return df.select(*columns)


def variable_query(
    name: str, sql: str, key: str | None = None, digits: int = 4, own: dict[str, int] | None = None,
    tables: dict[str, str] | None = None, **args,
) -> None:
    """Register a variable; ``tables`` puts other views in the place of its layers."""

    @query(key or name, sql)
    def run(spark: SparkSession, given: Layers) -> DataFrame:
        lay = Layers(lambda n: given.get(tables.get(n, n)), TIMELESS, UNVERSIONED) if tables else given
        result = compute(lay, name, grid=GRID, **args)
        if name in ("border_emission", "emission_vector"):
            return amounts(result)
        return rounded(result, digits, **(own or {}))


# SQL building blocks


def in_disc(dx: str, dy: str, r: float) -> str:
    return f"(({dx})*({dx})+({dy})*({dy}) <= {float(r) * float(r)!r})"


def in_gon(dx: str, dy: str, r: float) -> str:
    """Inside the 32-gon of circumradius r."""
    return (
        f"(sqrt(({dx})*({dx})+({dy})*({dy})) * cos(((atan2({dy},{dx}) + {2 * PI!r}) % {PI / 16!r}) - {PI / 32!r}) "
        f"< {r * COS!r})"
    )


def near(a: str, b: str, r: float) -> str:
    """Box filter that lets the oracle join quickly."""
    return f"{b}.x BETWEEN {a}.x - {r} AND {a}.x + {r} AND {b}.y BETWEEN {a}.y - {r} AND {a}.y + {r}"


def point_seg(px: str, py: str, s: str = "s") -> str:
    """Distance from a point to segment s."""
    dx, dy = f"({s}.x2-{s}.x1)", f"({s}.y2-{s}.y1)"
    t = (
        f"greatest(0e0, least(1e0, coalesce((({px}-{s}.x1)*{dx}+({py}-{s}.y1)*{dy})"
        f"/nullif({dx}*{dx}+{dy}*{dy},0), 0e0)))"
    )
    return f"sqrt(pow({px}-({s}.x1+{t}*{dx}),2)+pow({py}-({s}.y1+{t}*{dy}),2))"


def gon_sides(r: float) -> str:
    """Rows (k, nx, ny, c1, s1, c2, s2): outward normals and corners of the 32-gon."""
    a = PI / 16
    return (
        f"SELECT k, cos((k+0.5)*{a!r}) AS nx, sin((k+0.5)*{a!r}) AS ny, {r}*cos(k*{a!r}) AS c1, {r}*sin(k*{a!r}) AS s1, "
        f"{r}*cos((k+1)*{a!r}) AS c2, {r}*sin((k+1)*{a!r}) AS s2 FROM (SELECT unnest(generate_series(0,31)) AS k) g"
    )


def gon_clip(segs: str, r: float, keep: str) -> str:
    """CTEs ending in ``gon_parts(tot_reg_cd, cx, cy, <keep>, x1, y1, x2, y2, share)``.

    Each segment near a centre is cut by the 32 half-planes of the buffer.
    """
    kept = ", ".join(f"s.{c}" for c in keep.split(", ") if c)
    kept = f"{kept}, " if kept else ""
    return f"""sides AS ({gon_sides(r)}),
near_segs AS (SELECT c.tot_reg_cd, c.x AS cx, c.y AS cy, {kept}s.x1, s.y1, s.x2, s.y2, row_number() OVER () AS rn
  FROM centers c JOIN ({segs}) s ON least(s.x1,s.x2) < c.x + {r} AND greatest(s.x1,s.x2) > c.x - {r}
   AND least(s.y1,s.y2) < c.y + {r} AND greatest(s.y1,s.y2) > c.y - {r}),
cuts AS (SELECT n.rn, max(CASE WHEN rate < 0 THEN room/rate WHEN rate = 0 AND room <= 0 THEN 2e0 ELSE 0e0 END) AS t_in,
   min(CASE WHEN rate > 0 THEN room/rate ELSE 1e0 END) AS t_out
  FROM (SELECT n.rn, k.nx*(n.x2-n.x1)+k.ny*(n.y2-n.y1) AS rate, {r * COS!r} - (k.nx*(n.x1-n.cx)+k.ny*(n.y1-n.cy)) AS room
        FROM near_segs n CROSS JOIN sides k) n GROUP BY n.rn),
gon_parts AS (SELECT n.*, greatest(0e0, least(1e0, t_out) - greatest(0e0, t_in)) AS share FROM near_segs n JOIN cuts USING (rn))"""


def poly_clip(name: str, segs: str, seg_key: str, polys: str, poly_key: str) -> str:
    """CTEs ending in ``<name>(<seg_key>, ax, ay, bx, by, <poly_key>, t0, t1)``: parts of segments inside polygons.

    Crossings are sorted along the segment and every part is tested at its middle.
    """
    sk = ", ".join(f"s.{c}" for c in seg_key.split(", "))
    pk = poly_key
    pair = f"{name}_pair"
    return f"""{name}_seg AS (SELECT *, row_number() OVER () AS sid FROM ({segs}) q),
{name}_poly AS ({polys}),
{name}_box AS (SELECT {pk}, min(least(x1,x2)) AS lx, max(greatest(x1,x2)) AS hx, min(least(y1,y2)) AS ly, max(greatest(y1,y2)) AS hy
  FROM {name}_poly GROUP BY {pk}),
{pair} AS (SELECT s.*, {', '.join('b.' + c for c in pk.split(', '))} FROM {name}_seg s JOIN {name}_box b
  ON least(s.ax,s.bx) <= b.hx AND greatest(s.ax,s.bx) >= b.lx AND least(s.ay,s.by_) <= b.hy AND greatest(s.ay,s.by_) >= b.ly),
{name}_cut AS (SELECT sid, {pk}, 0e0 AS t FROM {pair} UNION SELECT sid, {pk}, 1e0 FROM {pair}
  UNION SELECT sid, {pk}, t FROM (SELECT p.sid, {', '.join('p.' + c for c in pk.split(', '))},
     ((e.x1-p.ax)*(e.y2-e.y1)-(e.y1-p.ay)*(e.x2-e.x1)) / nullif((p.bx-p.ax)*(e.y2-e.y1)-(p.by_-p.ay)*(e.x2-e.x1),0) AS t,
     ((e.x1-p.ax)*(p.by_-p.ay)-(e.y1-p.ay)*(p.bx-p.ax)) / nullif((p.bx-p.ax)*(e.y2-e.y1)-(p.by_-p.ay)*(e.x2-e.x1),0) AS u
     FROM {pair} p JOIN {name}_poly e USING ({pk})) c WHERE t > 0 AND t < 1 AND u >= 0 AND u <= 1),
{name}_part AS (SELECT * FROM (SELECT sid, {pk}, t AS t0, lead(t) OVER (PARTITION BY sid, {pk} ORDER BY t) AS t1 FROM {name}_cut) l WHERE t1 > t0),
{name}_mid AS (SELECT p.*, s.ax + (t0+t1)/2*(s.bx-s.ax) AS mx, s.ay + (t0+t1)/2*(s.by_-s.ay) AS my FROM {name}_part p JOIN {name}_seg s USING (sid)),
{name} AS (SELECT {sk}, s.ax, s.ay, s.bx, s.by_, {', '.join('m.' + c for c in pk.split(', '))}, m.t0, m.t1
  FROM {name}_mid m JOIN {name}_seg s USING (sid) JOIN {name}_poly e USING ({pk})
  WHERE (e.y1 > m.my) <> (e.y2 > m.my) AND m.mx < (e.x2-e.x1)*(m.my-e.y1)/nullif(e.y2-e.y1,0)+e.x1
  GROUP BY ALL HAVING count(*) % 2 = 1)"""


def in_border(px: str, py: str, alias: str = "b") -> str:
    """Join condition: border edge ``alias`` crossed by the ray going east from the point.

    Edges are taken lower end first, so both borders at a common edge compute the same number.
    """
    a = alias
    low_x, high_x = f"(CASE WHEN {a}.y1 < {a}.y2 THEN {a}.x1 ELSE {a}.x2 END)", f"(CASE WHEN {a}.y1 < {a}.y2 THEN {a}.x2 ELSE {a}.x1 END)"
    low_y, high_y = f"least({a}.y1,{a}.y2)", f"greatest({a}.y1,{a}.y2)"
    return (f"({a}.y1 > {py}) <> ({a}.y2 > {py}) AND "
            f"{px} < {low_x}+({py}-{low_y})*({high_x}-{low_x})/nullif({high_y}-{low_y},0)")


def border_points(points: str, keep: str) -> str:
    """CTE ``inside(sigungu_cd, <keep>)``: points (pid, x, y, ...) in borders by even-odd crossings."""
    return f"""pts AS (SELECT *, row_number() OVER () AS pid FROM ({points}) q),
hit AS (SELECT b.sigungu_cd, p.pid FROM pts p JOIN border_edge b ON {in_border('p.x', 'p.y')}
  GROUP BY b.sigungu_cd, p.pid HAVING count(*) % 2 = 1),
inside AS (SELECT h.sigungu_cd, {keep} FROM hit h JOIN pts USING (pid))"""


BORDER_MEASURES = """org AS (SELECT sigungu_cd, min(x1) AS ox, min(y1) AS oy FROM border_edge GROUP BY sigungu_cd),
loc AS (SELECT e.sigungu_cd, ox, oy, x1-ox AS ax, y1-oy AS ay, x2-ox AS bx, y2-oy AS by_,
  (x1-ox)*(y2-oy)-(x2-ox)*(y1-oy) AS cr FROM border_edge e JOIN org USING (sigungu_cd)),
measures AS (SELECT sigungu_cd, sum(cr)/2 AS area, min(ox)+sum((ax+bx)*cr)/(3*sum(cr)) AS x, min(oy)+sum((ay+by_)*cr)/(3*sum(cr)) AS y
  FROM loc GROUP BY sigungu_cd)"""


def scratch_dir(spark: SparkSession) -> str:
    return spark.conf.get("spark.checkpoint.dir")


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("os",)]
