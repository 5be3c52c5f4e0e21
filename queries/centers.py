"""Centroid variables and counts around user coordinates."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.plans.registry import compute
from terracell.sources.layers import Layers

from .borders import CODES, LABELS
from .support import COS, GRID, gon_clip, gon_sides, in_disc, in_gon, near, point_seg, poly_clip, query, rounded, variable_query

YEAR, R = 2010, 500
CELL_XY = "950000e0 + t.col*200 + 100 AS x, 1940000e0 + t.row*200 + 100 AS y"
AT_CELL = "t.col = cast(floor((c.x-950000)/200) AS int) AND t.row = cast(floor((c.y-1940000)/200) AS int)"

for _v, _layer, _out in (("dem_value", "dem", "Altitude_k"), ("dsm_value", "dsm", "Altitude_a")):
    variable_query(
        _v, f"""SELECT c.tot_reg_cd, round(t.val,4) AS "{_out}" FROM centers c JOIN raster_cell t ON {AT_CELL} AND t.layer = '{_layer}'"""
    )


def _count(layer: str, where: str, out: str, r: float = R) -> str:
    return f"""WITH hits AS (SELECT c.tot_reg_cd, count(*) AS n FROM centers c JOIN (SELECT * FROM {layer} WHERE {where}) t
ON {near('c', 't', r)} AND {in_gon('t.x-c.x', 't.y-c.y', r)} GROUP BY c.tot_reg_cd)
SELECT c.tot_reg_cd, coalesce(h.n,0) AS "{out}" FROM centers c LEFT JOIN hits h ON h.tot_reg_cd = c.tot_reg_cd"""


def _alive(year: int) -> str:
    return f"cast(substring(date,1,4) AS int) <= {year} AND (date_c IS NULL OR cast(substring(date_c,1,4) AS int) >= {year})"


variable_query("bus_stop_count", _count("bus_stop", "year = 2023", "C_Bus_0500"), year=2023, radius=R)
variable_query("bus_stop_count", _count("bus_stop", "year = 2023", "C_Bus_5000", 5000), "bus_stop_count_wide", year=2023, radius=5000)
variable_query("rail_station_count", _count("railstation", "year = 2005", "C_Railstation_1000", 1000), year=2000, radius=1000)
variable_query("clinic_count", _count("clinics", _alive(YEAR), "C_Clinic_2010_0500"), year=YEAR, radius=R)
variable_query("hospital_count", _count("hospitals", _alive(YEAR), "C_Hospital_2010_0500"), year=YEAR, radius=R)


def _nearest_point(layer: str, where: str, out: str) -> str:
    return f"""SELECT c.tot_reg_cd, round(min(sqrt(pow(c.x-t.x,2)+pow(c.y-t.y,2))),4) AS "{out}"
FROM centers c CROSS JOIN (SELECT * FROM {layer} WHERE {where}) t GROUP BY c.tot_reg_cd"""


def _nearest_line(layer: str, where: str, out: str) -> str:
    return f"""SELECT c.tot_reg_cd, round(min({point_seg('c.x', 'c.y')}),4) AS "{out}"
FROM centers c CROSS JOIN (SELECT * FROM {layer} WHERE {where}) s GROUP BY c.tot_reg_cd"""


variable_query("bus_stop_distance", _nearest_point("bus_stop", "year = 2023", "D_Bus_2023"), year=2023)
variable_query("airport_distance", _nearest_point("airport", "year = 2010", "D_Airport_2010"), year=YEAR)
variable_query("rail_distance", _nearest_line("rail_seg", "year = 2005", "D_Rail_2005"), year=2000)
variable_query("rail_station_distance", _nearest_point("railstation", "year = 2005", "D_Sub_2005"), year=2000)
variable_query("coastline_distance", _nearest_line("coast_seg", "year = 2010", "D_Coast_2010"), year=YEAR)
variable_query("mdl_distance", _nearest_line("mdl_seg", "year = 2010", "D_North_2010"), year=YEAR)
variable_query("port_distance", _nearest_point("ports", "year = 2010", "D_Port_2010"), year=YEAR)
variable_query("mr1_distance", _nearest_line("mr1_seg", "year = 2010", "D_MR1_2010"), year=YEAR)
variable_query("mr2_distance", _nearest_line("mr2_seg", "year = 2010", "D_MR2_2010"), year=YEAR)
variable_query("road_distance", _nearest_line("road_seg", "year = 2010", "D_Road_2010"), year=YEAR)
variable_query(
    "river_distance",
    f"""WITH riv AS (SELECT * FROM river_edge WHERE year = 2010),
held AS (SELECT DISTINCT tot_reg_cd FROM (SELECT c.tot_reg_cd, s.fid FROM centers c JOIN riv s
  ON (s.y1 > c.y) <> (s.y2 > c.y) AND c.x < (s.x2-s.x1)*(c.y-s.y1)/nullif(s.y2-s.y1,0)+s.x1
  GROUP BY c.tot_reg_cd, s.fid HAVING count(*) % 2 = 1) h)
SELECT c.tot_reg_cd, round(CASE WHEN max(h.tot_reg_cd) IS NOT NULL THEN 0 ELSE min({point_seg('c.x', 'c.y')}) END,4) AS "D_River_2010"
FROM centers c CROSS JOIN riv s LEFT JOIN held h ON h.tot_reg_cd = c.tot_reg_cd GROUP BY c.tot_reg_cd""",
    year=YEAR,
)
variable_query("clinic_distance", _nearest_point("clinics", _alive(YEAR), "D_Clinic_2010"), year=YEAR)
variable_query("hospital_distance", _nearest_point("hospitals", _alive(YEAR), "D_Hospital_2010"), year=YEAR)
variable_query(
    "car_mean",
    f"""SELECT c.tot_reg_cd, r.value AS "C_Car_sigungu_mean_registration" FROM centers c
JOIN car_registration r ON substring(c.tot_reg_cd,1,5) = r.sgg_cd WHERE r.year = {YEAR}""",
    year=YEAR,
)


def gon_area_sql(polys: str, ids: str, key: str, r: float) -> str:
    """CTEs ending in ``covered(tot_reg_cd, <key>, area)``: polygon area inside each 32-gon."""
    every = f"{ids}, {key}" if ids != key else key
    cols = every.replace(", ", ", ")
    pair_on = (f"b.lx < c.x + {r} AND b.hx > c.x - {r} AND b.ly < c.y + {r} AND b.hy > c.y - {r}")
    return f"""lay AS ({polys}),
{gon_clip('SELECT * FROM lay', r, cols)},
lay_box AS (SELECT {every}, min(least(x1,x2)) AS lx, max(greatest(x1,x2)) AS hx, min(least(y1,y2)) AS ly, max(greatest(y1,y2)) AS hy FROM lay GROUP BY {every}),
rim AS (SELECT DISTINCT c.tot_reg_cd, c.x AS cx, c.y AS cy, k.k, c.x+k.c1 AS ax, c.y+k.s1 AS ay, c.x+k.c2 AS bx, c.y+k.s2 AS by_
  FROM centers c JOIN lay_box b ON {pair_on} CROSS JOIN sides k),
{poly_clip('rimin', 'SELECT * FROM rim', 'tot_reg_cd, cx, cy', 'SELECT * FROM lay', every)},
covered AS (SELECT tot_reg_cd, {key}, sum(a) AS area FROM (
  SELECT tot_reg_cd, {key}, share*((x1-cx)*(y2-cy)-(x2-cx)*(y1-cy))/2 AS a FROM gon_parts
  UNION ALL SELECT tot_reg_cd, {key}, (t1-t0)*((ax-cx)*(by_-cy)-(bx-cx)*(ay-cy))/2 FROM rimin) u GROUP BY tot_reg_cd, {key})"""


def weights_sql(r: float) -> str:
    """CTEs ending in ``ia(center_reg_cd, border_reg_cd, area, zone_area)``."""
    edges = "SELECT sigungu_cd, x1, y1, x2, y2 FROM border_edge"
    return f"""{gon_area_sql(edges, 'sigungu_cd', 'sigungu_cd', r)},
org AS (SELECT sigungu_cd, min(x1) AS ox, min(y1) AS oy FROM border_edge GROUP BY sigungu_cd),
zarea AS (SELECT sigungu_cd, sum((x1-ox)*(y2-oy)-(x2-ox)*(y1-oy))/2 AS zone_area FROM border_edge JOIN org USING (sigungu_cd) GROUP BY sigungu_cd),
ia AS (SELECT tot_reg_cd AS center_reg_cd, sigungu_cd AS border_reg_cd, area, zone_area FROM covered JOIN zarea USING (sigungu_cd) WHERE area > 1e-6)"""


def _weighted(table: str, columns: dict[str, str], r: float = R, total: str | None = None) -> str:
    one = {n: f"coalesce(sum(cast(p.{c} AS double)*ia.area/ia.zone_area),0)" for c, n in columns.items()}
    items = [f'round({e},4) AS "{n}"' for n, e in one.items()]
    if total:
        items.append(f'round({" + ".join(one.values())},4) AS "{total}"')
    return f"""WITH {weights_sql(r)}
SELECT ia.center_reg_cd AS tot_reg_cd, {', '.join(items)} FROM ia
LEFT JOIN {table} p ON p.tot_reg_cd = ia.border_reg_cd AND p.year = {YEAR} GROUP BY ia.center_reg_cd"""


def _fan(prefix: str, n: int) -> dict[str, str]:
    return {f"v_{i:03d}": f"{prefix}_{i}_0500" for i in range(1, n + 1)}


variable_query("business_registration_count", _weighted("sgis_wide", _fan("B_bnu", 19), total="B_bnu_0500"), year=YEAR, radius=R, border_type="sgg")
variable_query("business_employee_count", _weighted("sgis_wide", _fan("B_bem", 19), total="B_bem_0500"), year=YEAR, radius=R, border_type="sgg")
variable_query("house_type_count", _weighted("sgis_wide", _fan("H_gb", 6), total="H_gb_0500"), year=YEAR, radius=R, border_type="sgg")
variable_query(
    "population", _weighted("sgis_pop", {"pop": "POP_0500", "pop_m": "POP_M_0500", "pop_f": "POP_F_0500"}), year=YEAR, radius=R, border_type="sgg",
)


def of_units(sql: str) -> str:
    """An oracle over counties turned to census units and their census tables."""
    for county, unit in (("border_edge", "unit_edge"), ("sigungu_cd", "unit_cd"), ("sgis_pop", "unit_pop"), ("sgis_wide", "unit_wide")):
        sql = sql.replace(county, unit)
    return sql


# The same four over census units, their own unit where none is named.
UNIT_TABLES = {"sgis_pop": "unit_pop", "sgis_bnu": "unit_wide", "sgis_bem": "unit_wide", "sgis_ho_gb": "unit_wide"}
for _name, _table, _columns, _total in (
    ("population", "sgis_pop", {"pop": "POP_0500", "pop_m": "POP_M_0500", "pop_f": "POP_F_0500"}, None),
    ("business_registration_count", "sgis_wide", _fan("B_bnu", 19), "B_bnu_0500"),
    ("business_employee_count", "sgis_wide", _fan("B_bem", 19), "B_bem_0500"),
    ("house_type_count", "sgis_wide", _fan("H_gb", 6), "H_gb_0500"),
):
    variable_query(_name, of_units(_weighted(_table, _columns, total=_total)), f"{_name}_units", tables=UNIT_TABLES, year=YEAR, radius=R)


def _emission(r: int) -> str:
    dec = ", ".join(f"cast(round(t.{p}*800000) AS bigint) AS {p}" for p in LABELS)

    def held(layer: str) -> str:
        ends = " AND ".join(in_gon(f"t.x{i}-c.x", f"t.y{i}-c.y", r) for i in (1, 2))
        box = f"t.x1 BETWEEN c.x - {r} AND c.x + {r} AND t.y1 BETWEEN c.y - {r} AND c.y + {r}"
        return f"""SELECT h.tot_reg_cd, {dec} FROM (SELECT c.tot_reg_cd, t.fid FROM centers c JOIN (SELECT *, count(*) OVER (PARTITION BY fid) AS n
    FROM {layer} WHERE year = {YEAR}) t ON {box} AND {ends} GROUP BY c.tot_reg_cd, t.fid, t.n HAVING count(*) = t.n) h
    JOIN (SELECT DISTINCT fid, {', '.join(LABELS)} FROM {layer} WHERE year = {YEAR}) t ON t.fid = h.fid"""

    return f"""WITH held AS (SELECT c.tot_reg_cd, {dec} FROM centers c JOIN emission_point t ON t.year = {YEAR} AND {near('c', 't', r)}
   AND {in_gon('t.x-c.x', 't.y-c.y', r)} UNION ALL {held('emission_line')} UNION ALL {held('emission_area')}),
sums AS (SELECT tot_reg_cd, {', '.join(f'sum({p}) AS {p}' for p in LABELS)} FROM held GROUP BY tot_reg_cd)
SELECT c.tot_reg_cd, {', '.join(f'cast(coalesce({p},0) AS double)/800000 AS "EM_{v}_{r:05d}"' for p, v in LABELS.items())}
FROM centers c LEFT JOIN sums s ON s.tot_reg_cd = c.tot_reg_cd"""


variable_query("emission_vector", _emission(3000), year=YEAR, radius=3000)
variable_query("emission_vector", _emission(10000), "emission_vector_wide", year=YEAR, radius=10000)


@query(
    "emission_raster_value",
    f"""SELECT c.tot_reg_cd, round(t.val,4) AS "EM_area_nox_2020" FROM centers c
JOIN emission_cell t ON {AT_CELL} AND t.emission_type = 'area' AND t.pollutant_type = 'nox'""",
)
def emission_raster_value(spark: SparkSession, lay: Layers) -> DataFrame:
    """The raster fixture is stamped 2019, a year this variable does not offer: restamp it."""

    def resolve(name: str) -> DataFrame:
        df = lay.get(name)
        return df.withColumn("year", F.lit(2020)) if name == "emission_cell" else df

    return rounded(
        compute(Layers(resolve), "emission_raster_value", grid=GRID, year=2020, radius=3000, emission_type="Area", pollutant_type="NOx")
    )


def _length(segs: str, out: str, weight: str = "1e0", r: int = R) -> str:
    return f"""WITH {gon_clip(segs, r, 'w')},
sums AS (SELECT tot_reg_cd, sum(share*w*sqrt(pow(x2-x1,2)+pow(y2-y1,2))) AS v FROM gon_parts GROUP BY tot_reg_cd)
SELECT c.tot_reg_cd, round(coalesce(v,0),3) AS "{out}" FROM centers c LEFT JOIN sums s ON s.tot_reg_cd = c.tot_reg_cd"""


def _segs(layer: str, year: int, weight: str = "1e0", lanes: bool = False) -> str:
    if lanes:
        return (f"SELECT t.x1, t.y1, t.x2, t.y2, {weight} AS w FROM {layer} t JOIN road_lane l ON l.id = t.original_id "
                f"WHERE t.year = {year}")
    return f"SELECT x1, y1, x2, y2, {weight} AS w FROM {layer} WHERE year = {year}"


variable_query("road_length", _length(_segs("road_seg", 2010), "road_l_0500"), digits=3, year=2010, radius=R)
variable_query("road_length_lane", _length(_segs("road_seg", 2010, "lanes"), "road_ll_0500"), digits=3, year=2010, radius=R)
variable_query(
    "road_length_lane_width", _length(_segs("road_seg", 2015, "l.lanes*l.width", True), "road_llw_0500"), digits=3, year=2015, radius=R
)
for _i in (1, 2):
    variable_query(f"mr{_i}_length", _length(_segs(f"mr{_i}_seg", 2010), f"MR{_i}_L_0500"), digits=3, year=2010, radius=R)
    variable_query(
        f"mr{_i}_length_lane", _length(_segs(f"mr{_i}_seg", 2010, "l.lanes", True), f"MR{_i}_LL_0500"), digits=3, year=2010, radius=R
    )
    variable_query(
        f"mr{_i}_length_lane_width", _length(_segs(f"mr{_i}_seg", 2015, "l.lanes*l.width", True), f"MR{_i}_LLW_0500"),
        digits=3, year=2015, radius=R,
    )

for _s in ("mean", "min", "max", "8mdn"):
    variable_query(
        f"ndvi_{_s}",
        f"""SELECT c.tot_reg_cd, round(coalesce(t.val,0),8) AS "ndvi_y1_{_s}_1000" FROM centers c LEFT JOIN ndvi_cell t
ON {AT_CELL} AND t.year = 2010 AND t.statistic = '{_s}'""",
        digits=8, year=2010, radius=1000,
    )
variable_query(
    "ndvi_median",
    f"""WITH cell AS (SELECT {CELL_XY}, floor(t.col/100) AS tc, floor(t.row/100) AS tr, t.val FROM ndvi_cell t
  WHERE t.year = 2010 AND t.statistic = 'median' AND t.val IS NOT NULL),
tile AS (SELECT c.tot_reg_cd, tc, tr, avg(t.val) AS m FROM centers c JOIN cell t ON {near('c', 't', 1000)}
  AND {in_gon('t.x-c.x', 't.y-c.y', 1000)} GROUP BY c.tot_reg_cd, tc, tr)
SELECT c.tot_reg_cd, round(coalesce(avg(m),0),12) AS "ndvi_y1_mm_median_1000" FROM centers c LEFT JOIN tile t ON t.tot_reg_cd = c.tot_reg_cd
GROUP BY c.tot_reg_cd""",
    digits=12, year=2010, radius=1000,
)

for _layer in ("dem", "dsm"):
    for _r in (1000, 5000):
        _shares = ", ".join(
            f"round(count(*) FILTER (WHERE t.val - o.val {op} {sgn}{s}) * 1e0 / count(*),6) AS {word}_{s}_{_r}"
            for s in (20, 50) for word, op, sgn in (("above", ">", ""), ("below", "<", "-"))
        )
        variable_query(
            "relative_elevation",
            f"""WITH cell AS (SELECT {CELL_XY}, t.val FROM raster_cell t WHERE t.layer = '{_layer}' AND t.val IS NOT NULL),
own AS (SELECT c.tot_reg_cd, c.x, c.y, t.val FROM centers c JOIN raster_cell t ON {AT_CELL} AND t.layer = '{_layer}')
SELECT substring(o.tot_reg_cd,1,5) AS sgg_cd, o.tot_reg_cd, {_shares} FROM own o JOIN cell t ON {near('o', 't', _r + 30)}
AND {in_gon('t.x-o.x', 't.y-o.y', _r + 30)} AND NOT {in_gon('t.x-o.x', 't.y-o.y', _r)} GROUP BY o.tot_reg_cd""",
            f"relative_{_layer}_{_r}", digits=6, layer=_layer, distance=_r,
        )

_lu = ", ".join(
    f'round(coalesce(sum(v.area) FILTER (WHERE v.code = {c}),0)/{math.pi * R * R!r},6) AS "LS{c}_0500"' for c in CODES
)
variable_query(
    "landuse",
    f"""WITH {gon_area_sql('SELECT fid, code, x1, y1, x2, y2 FROM landuse_edge WHERE year = 2020', 'fid', 'code', R)}
SELECT c.tot_reg_cd, {_lu} FROM centers c LEFT JOIN covered v ON v.tot_reg_cd = c.tot_reg_cd GROUP BY c.tot_reg_cd""",
    digits=6, year=2020, radius=R,
)


# The same over true circles: every edge adds a triangle where it is inside and a sector where it is not.
_SECTOR = "atan2({ax}*({by})-({bx})*{ay}, {ax}*({bx})+{ay}*({by}))"


def _kernel(r: float) -> str:
    at = {t: (f"(ax+{t}*(bx-ax))", f"(ay+{t}*(by_-ay))") for t in ("t0", "t1")}
    before = _SECTOR.format(ax="ax", ay="ay", bx=at["t0"][0], by=at["t0"][1])
    after = _SECTOR.format(ax=at["t1"][0], ay=at["t1"][1], bx="bx", by="by_")
    return f"{r * r / 2!r}*({before} + {after}) + (t1-t0)*(ax*by_-bx*ay)/2"


variable_query(
    "landuse",
    f"""WITH lay AS (SELECT fid, code, x1, y1, x2, y2 FROM landuse_edge WHERE year = 2020),
box AS (SELECT fid, min(least(x1,x2)) AS lx, max(greatest(x1,x2)) AS hx, min(least(y1,y2)) AS ly, max(greatest(y1,y2)) AS hy FROM lay GROUP BY fid),
rel AS (SELECT c.tot_reg_cd, e.code, e.x1-c.x AS ax, e.y1-c.y AS ay, e.x2-c.x AS bx, e.y2-c.y AS by_ FROM centers c
  JOIN box b ON b.lx < c.x + {R} AND b.hx > c.x - {R} AND b.ly < c.y + {R} AND b.hy > c.y - {R} JOIN lay e ON e.fid = b.fid),
roots AS (SELECT *, pow(bx-ax,2)+pow(by_-ay,2) AS qa, ax*(bx-ax)+ay*(by_-ay) AS qb, ax*ax+ay*ay-{R * R} AS qc FROM rel),
cut AS (SELECT *, CASE WHEN qb*qb > qa*qc THEN greatest(0e0, least(1e0, (-qb-sqrt(qb*qb-qa*qc))/qa)) ELSE 0e0 END AS t0,
  CASE WHEN qb*qb > qa*qc THEN greatest(0e0, least(1e0, (-qb+sqrt(qb*qb-qa*qc))/qa)) ELSE 0e0 END AS t1 FROM roots),
covered AS (SELECT tot_reg_cd, code, sum({_kernel(R)}) AS area FROM cut GROUP BY tot_reg_cd, code)
SELECT c.tot_reg_cd, {_lu} FROM centers c LEFT JOIN covered v ON v.tot_reg_cd = c.tot_reg_cd GROUP BY c.tot_reg_cd""",
    "landuse_exact", digits=6, year=2020, radius=R, exact=True,
)


# User coordinates: degrees spread over the box of the layers

POINTS = """SELECT c_custkey AS point_id, 126.935e0 + (c_custkey*7919 % 9973)*0.0000225e0 AS x,
  37.46e0 + (c_custkey*6101 % 9967)*0.000018e0 AS y FROM customer"""


def _projected() -> str:
    """CTE ``metric``: the points in EPSG:5179 by the Krueger series, coefficients written out."""
    from terracell.functions import projection as p

    n, radius, alpha = p._series()
    e = 2 * math.sqrt(n) / (1 + n)
    k = p.SCALE * radius
    east = " + ".join(["eta"] + [f"{a!r}*cos({2 * j}*xi)*sinh({2 * j}*eta)" for j, a in enumerate(alpha, 1)])
    north = " + ".join(["xi"] + [f"{a!r}*sin({2 * j}*xi)*cosh({2 * j}*eta)" for j, a in enumerate(alpha, 1)])
    return f"""given AS ({POINTS}),
sn AS (SELECT *, sin(radians(y)) AS s, radians(x - 127.5e0) AS dl FROM given),
tt AS (SELECT *, sinh(0.5e0*ln((1+s)/(1-s)) - {e!r}*0.5e0*ln((1+{e!r}*s)/(1-{e!r}*s))) AS t FROM sn),
xe AS (SELECT *, atan2(t, cos(dl)) AS xi, sin(dl)/sqrt(1+t*t) AS q FROM tt),
xh AS (SELECT *, 0.5e0*ln((1+q)/(1-q)) AS eta FROM xe),
metric AS (SELECT point_id, x AS lon, y AS lat, 1000000e0 + {k!r}*({east}) AS x,
  {p.FALSE_NORTHING - p.SCALE * p._origin_northing()!r} + {k!r}*({north}) AS y FROM xh)"""


def custom_points(spark: SparkSession) -> DataFrame:
    return spark.sql(POINTS)


def _custom(layer: str, where: str, out: str, r: int) -> str:
    return f"""WITH {_projected()}
SELECT m.point_id, round(m.lon,7) AS x, round(m.lat,7) AS y, coalesce(h.n,0) AS "{out}" FROM metric m LEFT JOIN (
  SELECT m.point_id, count(*) AS n FROM metric m JOIN (SELECT * FROM {layer} WHERE {where}) t
  ON {near('m', 't', r)} AND {in_disc('t.x-m.x', 't.y-m.y', r)} GROUP BY m.point_id) h ON h.point_id = m.point_id"""


@query("custom_bus_stop_count", _custom("bus_stop", "year = 2023", "C_Bus_0500", 500))
def custom_bus_stop_count(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(compute(lay, "custom_bus_stop_count", year=2023, radius=500, units=custom_points(spark)), 7)


@query("custom_hospital_count", _custom("hospitals", _alive(YEAR), "C_Hospital_2010_1000", 1000))
def custom_hospital_count(spark: SparkSession, lay: Layers) -> DataFrame:
    return rounded(compute(lay, "custom_hospital_count", year=YEAR, radius=1000, units=custom_points(spark)), 7)
