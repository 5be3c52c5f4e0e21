"""Border variables."""

from __future__ import annotations

from .support import BORDER_MEASURES, border_points, point_seg, poly_clip, variable_query

YEAR = 2010
CODES = [110, 120, 130, 140, 150, 160, 200, 310, 320, 330, 400, 500, 600, 710]
LABELS = {"co": "CO", "nox": "NOx", "nh3": "NH3", "voc": "VOC", "pm10": "PM10", "sox": "SOx", "tsp": "TSP"}
ALL_BORDERS = "(SELECT DISTINCT sigungu_cd FROM border_edge) z"


def overlay_sql(polys: str, key: str) -> str:
    """CTEs ending in ``overlay(sigungu_cd, <key>, area)``."""
    border = "SELECT sigungu_cd, x1, y1, x2, y2 FROM border_edge"
    cross = "((ax-ox)*(by_-oy)-(bx-ox)*(ay-oy))/2*(t1-t0)"
    return f"""lay AS ({polys}),
org AS (SELECT sigungu_cd, min(x1) AS ox, min(y1) AS oy FROM border_edge GROUP BY sigungu_cd),
{poly_clip('pin', f'SELECT fid, {key}, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS by_ FROM lay', f'fid, {key}', border, 'sigungu_cd')},
{poly_clip('bin', 'SELECT sigungu_cd, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS by_ FROM border_edge', 'sigungu_cd',
           f'SELECT fid, {key}, x1, y1, x2, y2 FROM lay', f'fid, {key}')},
overlay AS (SELECT sigungu_cd, {key}, sum(a) AS area FROM (
  SELECT sigungu_cd, {key}, {cross} AS a FROM pin JOIN org USING (sigungu_cd)
  UNION ALL SELECT sigungu_cd, {key}, {cross} FROM bin JOIN org USING (sigungu_cd)) u GROUP BY sigungu_cd, {key})"""


variable_query(
    "border_river",
    f"""WITH {overlay_sql('SELECT fid, 1 AS one, x1, y1, x2, y2 FROM river_edge', 'one')}
SELECT sigungu_cd, round(coalesce(area,0),2) AS river_area_sum FROM {ALL_BORDERS} LEFT JOIN overlay USING (sigungu_cd)""",
    digits=2, year=YEAR,
)

_held = ", ".join(f"sum({p}) AS {p}" for p in LABELS)
_dec = ", ".join(f"cast(round({p}*800000) AS bigint) AS {p}" for p in LABELS)


def _corners_inside(layer: str) -> str:
    """Features whose corners all lie on or within every edge of a (convex) border."""
    side = "(b.x2-b.x1)*({y}-b.y1)-(b.y2-b.y1)*({x}-b.x1) >= 0"
    both = " AND ".join(side.format(x=f"f.x{i}", y=f"f.y{i}") for i in (1, 2))
    return f"""SELECT sigungu_cd, {_dec} FROM (SELECT b.sigungu_cd, f.fid FROM {layer} f CROSS JOIN border_edge b
   WHERE f.year = {YEAR} GROUP BY b.sigungu_cd, f.fid HAVING bool_and({both})) h
   JOIN (SELECT DISTINCT fid, {', '.join(LABELS)} FROM {layer} WHERE year = {YEAR}) a USING (fid)"""


_pollutants = ", ".join(LABELS)
variable_query(
    "border_emission",
    f"""WITH {border_points(f'SELECT x, y, {_dec} FROM emission_point WHERE year = {YEAR}', _pollutants)},
held AS (SELECT sigungu_cd, {_pollutants} FROM inside
  UNION ALL {_corners_inside('emission_line')} UNION ALL {_corners_inside('emission_area')}),
sums AS (SELECT sigungu_cd, {_held} FROM held GROUP BY sigungu_cd)
SELECT sigungu_cd, {', '.join(f'cast(coalesce({p},0) AS double)/800000 AS "EM_{v}_{YEAR}"' for p, v in LABELS.items())}
FROM {ALL_BORDERS} LEFT JOIN sums USING (sigungu_cd)""",
    year=YEAR,
)

variable_query(
    "border_car_registration",
    f"""WITH {BORDER_MEASURES}
SELECT m.sigungu_cd, c.year, c.value AS sigungu_car_registration, round(m.area,4) AS area,
  round(m.area / nullif(c.value,0),4) AS area_per_car
FROM measures m JOIN car_registration c ON substring(m.sigungu_cd,1,5) = c.sgg_cd WHERE c.year = {YEAR}""",
    year=YEAR,
)

_LANDUSE = f"""WITH {overlay_sql(f'SELECT fid, code, x1, y1, x2, y2 FROM landuse_edge WHERE year = {YEAR}', 'code')},
{BORDER_MEASURES.split('measures AS')[0].split('loc AS')[1].join(['loc AS', '']).rstrip().rstrip(',')},
measures AS (SELECT sigungu_cd, sum(cr)/2 AS area FROM loc GROUP BY sigungu_cd)
SELECT m.sigungu_cd, {', '.join(f"round(coalesce(sum(o.area) FILTER (WHERE o.code = {c}),0),3) AS lu_{c}_area, "
                              f"round(coalesce(sum(o.area) FILTER (WHERE o.code = {c}),0)/max(m.area),3) AS lu_{c}_ratio"
                              for c in CODES)}
FROM measures m LEFT JOIN overlay o USING (sigungu_cd) GROUP BY m.sigungu_cd"""
variable_query("border_landuse_area", _LANDUSE, digits=3, year=YEAR)

variable_query(
    "border_coastline_distance",
    f"""WITH {BORDER_MEASURES}
SELECT sigungu_cd, round(min({point_seg('m.x', 'm.y')}),4) AS centroid_to_coastline
FROM measures m CROSS JOIN (SELECT * FROM coast_seg WHERE year = {YEAR}) s GROUP BY sigungu_cd, s.fid""",
    year=YEAR,
)


def _named(layer: str, name: str, out: str, dist: str) -> str:
    return f"""WITH {BORDER_MEASURES},
ranked AS (SELECT sigungu_cd, p.{name}, sqrt(pow(m.x-p.x,2)+pow(m.y-p.y,2)) AS d,
  row_number() OVER (PARTITION BY sigungu_cd ORDER BY sqrt(pow(m.x-p.x,2)+pow(m.y-p.y,2)), p.{name}) AS rn
  FROM measures m CROSS JOIN {layer} p WHERE p.year = {YEAR})
SELECT sigungu_cd, {name} AS {out}, round(d,4) AS {dist} FROM ranked WHERE rn = 1"""


variable_query("border_airport_distance", _named("airport", "name", "airport_name", "distance_to_nearest_airport"), year=YEAR)
variable_query("border_port_distance", _named("ports", "alias", "port_alias", "port_distance"), year=YEAR)
variable_query(
    "border_mdl_distance",
    f"""WITH {BORDER_MEASURES}
SELECT sigungu_cd, round(min({point_seg('m.x', 'm.y')}),4) AS mdl_distance
FROM measures m CROSS JOIN (SELECT * FROM mdl_seg WHERE year = {YEAR}) s GROUP BY sigungu_cd""",
    year=YEAR,
)


def _length(layer: str, year: int, out: str) -> str:
    segs = f"SELECT fid, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS by_ FROM {layer} WHERE year = {year}"
    return f"""WITH {poly_clip('lin', segs, 'fid', 'SELECT sigungu_cd, x1, y1, x2, y2 FROM border_edge', 'sigungu_cd')},
sums AS (SELECT sigungu_cd, sum((t1-t0)*sqrt(pow(bx-ax,2)+pow(by_-ay,2))) AS l FROM lin GROUP BY sigungu_cd)
SELECT sigungu_cd, round(coalesce(l,0),3) AS {out} FROM {ALL_BORDERS} LEFT JOIN sums USING (sigungu_cd)"""


variable_query("border_rail", _length("rail_seg", YEAR, "rail_length"), digits=3, year=YEAR)
variable_query("border_road", _length("road_seg", 2005, "road_length"), digits=3, year=2000)


def stats_sql(value: str, prefix: str) -> str:
    return (
        f"count({value}) AS {prefix}_count, round(sum({value}),4) AS {prefix}_sum, round(avg({value}),10) AS {prefix}_mean, "
        f"round(stddev_pop({value}),4) AS {prefix}_std, round(min({value}),4) AS {prefix}_min, round(max({value}),4) AS {prefix}_max"
    )


def cells(where: str, table: str, extra: str = "val") -> str:
    return f"SELECT 950000e0 + col*200 + 100 AS x, 1940000e0 + row*200 + 100 AS y, {extra} FROM {table} WHERE {where}"


_NDVI = f"""WITH {border_points(cells(f"year = {YEAR} AND statistic = 'mean'", 'ndvi_cell'), 'val')}
SELECT sigungu_cd, {stats_sql('val', 'ndvi')} FROM inside GROUP BY sigungu_cd"""
variable_query("border_ndvi", _NDVI, own={"ndvi_mean": 10}, year=YEAR)
variable_query(
    "border_topographic_model",
    f"""WITH {border_points(cells('true', 'raster_cell', 'layer, val'), 'layer, val')}
SELECT sigungu_cd, {', '.join(stats_sql(f"(CASE WHEN layer = '{v}' THEN val END)", v) for v in ('dem', 'dsm'))}
FROM inside GROUP BY sigungu_cd""",
    own={"dem_mean": 10, "dsm_mean": 10}, year=YEAR,
)
_added = """SELECT pollutant_type, col, row, CASE WHEN count(val) = 3 THEN sum(val) END AS val
  FROM emission_cell WHERE year = 2019 GROUP BY pollutant_type, col, row HAVING count(*) = 3"""
variable_query(
    "border_raster_emission",
    f"""WITH added AS ({_added}),
{border_points(cells('true', 'added', 'pollutant_type, val'), 'pollutant_type, val')}
SELECT sigungu_cd, {', '.join(f"round(sum(CASE WHEN pollutant_type = '{p}' THEN val END),4) AS r_emission_{p}" for p in LABELS)}
FROM inside GROUP BY sigungu_cd""",
    year=2019,
)


def _facility(layer: str, out: str) -> str:
    alive = f"date <= '{YEAR}-12-31' AND (date_c IS NULL OR date_c >= '{YEAR}-01-01') AND operation = 1"
    return f"""WITH {border_points(f'SELECT x, y, id FROM {layer} WHERE {alive}', 'id')}
SELECT z.sigungu_cd, count(i.id) AS {out} FROM {ALL_BORDERS} LEFT JOIN inside i USING (sigungu_cd) GROUP BY z.sigungu_cd"""


variable_query("border_clinic", _facility("clinics", "clinic_count"), year=YEAR)
variable_query("border_hospital", _facility("hospitals", "hospital_count"), year=YEAR)


def _towns(sql: str) -> str:
    """An oracle over counties turned to towns, of which half are concave."""
    return sql.replace("border_edge", "town_edge").replace("sigungu_cd", "adm_dr_cd")


def _grid(sql: str) -> str:
    """An oracle over counties turned to census grid units."""
    return f"SELECT unit_cd AS tot_reg_cd, * EXCLUDE (unit_cd) FROM ({sql.replace('border_edge', 'unit_edge').replace('sigungu_cd', 'unit_cd')}) q"


for _kind, _turn in (("emd", _towns), ("jgg", _grid)):
    variable_query("border_road", _turn(_length("road_seg", YEAR, "road_length")), f"border_road_{_kind}", digits=3, year=YEAR, border_type=_kind)
    variable_query("border_hospital", _turn(_facility("hospitals", "hospital_count")), f"border_hospital_{_kind}", year=YEAR, border_type=_kind)
    _mean = _NDVI.replace(",10) AS ndvi_mean", ",8) AS ndvi_mean")
    variable_query("border_ndvi", _turn(_mean), f"border_ndvi_{_kind}", own={"ndvi_mean": 8}, year=YEAR, border_type=_kind)
variable_query("border_landuse_area", _towns(_LANDUSE), "border_landuse_area_emd", digits=3, year=YEAR, border_type="emd")
