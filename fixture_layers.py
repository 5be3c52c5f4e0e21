"""Geographic layers derived from the driver's tables by arithmetic on their keys.

The same text runs in Spark SQL (as temporary views) and in DuckDB (as common table expressions).
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

RECIPES = {
    "centers": """
SELECT cast(11000 + c_nationkey*10 as string) || lpad(cast(c_custkey as string),8,'0') AS tot_reg_cd,
  950000.0e0 + (c_custkey*7919) % 19997 AS x, 1940000.0e0 + (c_custkey*6101) % 19993 AS y FROM customer
""",
    "corner": """
SELECT i, j,
  950000.0e0 + i*4000 + CASE WHEN i BETWEEN 1 AND 4 AND j BETWEEN 1 AND 4 THEN ((i*37+j*61)%7-3)*100 ELSE 0 END AS x,
  1940000.0e0 + j*4000 + CASE WHEN i BETWEEN 1 AND 4 AND j BETWEEN 1 AND 4 THEN ((i*53+j*29)%7-3)*100 ELSE 0 END AS y
  FROM (SELECT n_nationkey AS i FROM nation WHERE n_nationkey < 6) a CROSS JOIN (SELECT n_nationkey AS j FROM nation WHERE n_nationkey < 6) b
""",
    "border_edge": """
SELECT cast(11000 + n.n_nationkey*10 as string) AS sigungu_cd, n.n_name AS sigungu_nm, e.seg,
  p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2
  FROM nation n CROSS JOIN (SELECT 0 AS seg, 0 AS ai, 0 AS aj, 1 AS bi, 0 AS bj UNION ALL SELECT 1,1,0,1,1 UNION ALL SELECT 2,1,1,0,1 UNION ALL SELECT 3,0,1,0,0) e
  JOIN corner p ON p.i = n.n_nationkey % 5 + e.ai AND p.j = cast(floor(n.n_nationkey/5) as int) + e.aj
  JOIN corner q ON q.i = n.n_nationkey % 5 + e.bi AND q.j = cast(floor(n.n_nationkey/5) as int) + e.bj
""",
    "border_edge_emd": """
SELECT cast(1100000 + n.n_nationkey*1000 + h.half as string) AS adm_dr_cd, n.n_name AS adm_dr_nm, e.seg, y.year,
  CASE e.a WHEN 0 THEN a.x WHEN 1 THEN b.x WHEN 2 THEN c.x WHEN 3 THEN d.x ELSE a.x*0.4e0 + b.x*0.35e0 + c.x*0.25e0 END AS x1,
  CASE e.a WHEN 0 THEN a.y WHEN 1 THEN b.y WHEN 2 THEN c.y WHEN 3 THEN d.y ELSE a.y*0.4e0 + b.y*0.35e0 + c.y*0.25e0 END AS y1,
  CASE e.b WHEN 0 THEN a.x WHEN 1 THEN b.x WHEN 2 THEN c.x WHEN 3 THEN d.x ELSE a.x*0.4e0 + b.x*0.35e0 + c.x*0.25e0 END AS x2,
  CASE e.b WHEN 0 THEN a.y WHEN 1 THEN b.y WHEN 2 THEN c.y WHEN 3 THEN d.y ELSE a.y*0.4e0 + b.y*0.35e0 + c.y*0.25e0 END AS y2
  FROM nation n CROSS JOIN (SELECT 1 AS half UNION ALL SELECT 2) h
  JOIN (SELECT 1 AS half, 0 AS seg, 0 AS a, 1 AS b UNION ALL SELECT 1,1,1,2 UNION ALL SELECT 1,2,2,4 UNION ALL SELECT 1,3,4,0
    UNION ALL SELECT 2,0,0,4 UNION ALL SELECT 2,1,4,2 UNION ALL SELECT 2,2,2,3 UNION ALL SELECT 2,3,3,0) e ON e.half = h.half
  JOIN corner a ON a.i = n.n_nationkey % 5 AND a.j = cast(floor(n.n_nationkey/5) as int)
  JOIN corner b ON b.i = n.n_nationkey % 5 + 1 AND b.j = cast(floor(n.n_nationkey/5) as int)
  JOIN corner c ON c.i = n.n_nationkey % 5 + 1 AND c.j = cast(floor(n.n_nationkey/5) as int) + 1
  JOIN corner d ON d.i = n.n_nationkey % 5 AND d.j = cast(floor(n.n_nationkey/5) as int) + 1
  CROSS JOIN (SELECT 2000 AS year UNION ALL SELECT 2005 UNION ALL SELECT 2010 UNION ALL SELECT 2015 UNION ALL SELECT 2020) y
""",
    "town_edge": """
SELECT adm_dr_cd, adm_dr_nm, seg, x1, y1, x2, y2 FROM border_edge_emd WHERE year = 2010
""",
    "border_edge_jgg": """
SELECT cast(1100000000000 + a.n_nationkey*100 + b.n_nationkey as string) AS tot_reg_cd, 2023 AS year, e.seg,
  950000.0e0 + (a.n_nationkey + e.ai)*800 AS x1, 1940000.0e0 + (b.n_nationkey + e.aj)*800 AS y1,
  950000.0e0 + (a.n_nationkey + e.bi)*800 AS x2, 1940000.0e0 + (b.n_nationkey + e.bj)*800 AS y2
  FROM nation a CROSS JOIN nation b
  CROSS JOIN (SELECT 0 AS seg, 0 AS ai, 0 AS aj, 1 AS bi, 0 AS bj UNION ALL SELECT 1,1,0,1,1 UNION ALL SELECT 2,1,1,0,1 UNION ALL SELECT 3,0,1,0,0) e
""",
    "unit_edge": """
SELECT tot_reg_cd AS unit_cd, seg, x1, y1, x2, y2 FROM border_edge_jgg
""",
    "unit_pop": """
SELECT cast(1100000000000 + i*100 + j as string) AS tot_reg_cd, y.year, count(*)*10 + y.year % 7 AS pop, count(*)*4 AS pop_m, count(*)*6 + y.year % 7 AS pop_f
  FROM (SELECT cast(floor((x-950000)/800) as bigint) AS i, cast(floor((y-1940000)/800) as bigint) AS j FROM centers) c
  CROSS JOIN (SELECT 2000 AS year UNION ALL SELECT 2005 UNION ALL SELECT 2010 UNION ALL SELECT 2015 UNION ALL SELECT 2020) y GROUP BY i, j, y.year
""",
    "bus_stop": """
SELECT p_partkey AS id, 2023 AS year, 950000.0e0 + (p_partkey*7253) % 19991 AS x, 1940000.0e0 + (p_partkey*9341) % 19979 AS y FROM part
""",
    "railstation": """
SELECT s_suppkey AS id, cast(2000 + 5*(s_suppkey % 5) as int) AS year, 950000.0e0 + (s_suppkey*6203) % 19991 AS x, 1940000.0e0 + (s_suppkey*4801) % 19979 AS y FROM supplier
""",
    "hospitals": """
SELECT o_orderkey AS id, substring(cast(o_orderdate as string),1,10) AS date,
  CASE WHEN o_orderstatus = 'F' THEN cast(cast(substring(cast(o_orderdate as string),1,4) as int) + 3 + o_custkey % 20 as string) || '-06-30' END AS date_c,
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS operation,
  950000.0e0 + (o_orderkey*7919 + o_custkey) % 19997 AS x, 1940000.0e0 + (o_orderkey*3571 + o_custkey) % 19993 AS y FROM orders WHERE o_orderkey % 5 = 0
""",
    "clinics": """
SELECT o_orderkey AS id, substring(cast(o_orderdate as string),1,10) AS date,
  CASE WHEN o_orderstatus = 'F' THEN cast(cast(substring(cast(o_orderdate as string),1,4) as int) + 3 + o_custkey % 20 as string) || '-06-30' END AS date_c,
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS operation,
  950000.0e0 + (o_orderkey*7919 + o_custkey) % 19997 AS x, 1940000.0e0 + (o_orderkey*3571 + o_custkey) % 19993 AS y FROM orders WHERE o_orderkey % 5 = 1
""",
    "road_seg": """
SELECT l_orderkey*10 + l_linenumber AS fid, l_orderkey AS original_id, cast(2005 + 5*(l_linenumber % 4) as int) AS year,
  1 + sk % 4 AS lanes, 2.5e0 + (pk % 5)*0.25e0 AS width,
  950000.0e0 + (l_orderkey*7919 + pk*13) % 19001 AS x1, 1940000.0e0 + (l_orderkey*6101 + pk*17) % 19001 AS y1,
  950000.0e0 + (l_orderkey*7919 + pk*13) % 19001 + (pk*31) % 901 AS x2, 1940000.0e0 + (l_orderkey*6101 + pk*17) % 19001 + (sk*97) % 887 AS y2
  FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey, l_linenumber) t
""",
    "rail_seg": """
SELECT fid, original_id, year, x1, y1, x2, y2 FROM road_seg WHERE original_id % 7 = 0
""",
    "mr1_seg": """
SELECT fid, original_id, year, x1, y1, x2, y2 FROM road_seg WHERE lanes = 4
""",
    "mr2_seg": """
SELECT fid, original_id, year, x1, y1, x2, y2 FROM road_seg WHERE lanes = 3
""",
    "road_lane": """
SELECT o_orderkey AS id, 1 + o_custkey % 4 AS lanes, 2.5e0 + (o_custkey % 5)*0.25e0 AS width FROM orders
""",
    "landuse_edge": """
SELECT p_partkey AS fid, element_code AS code, cast(2000 + 5*(p_partkey % 5) as int) AS year, seg,
  cx + s*ax AS x1, cy + s*ay AS y1, cx + s*bx AS x2, cy + s*by_ AS y2 FROM (
  SELECT p_partkey, CASE p_partkey % 14 WHEN 0 THEN 110 WHEN 1 THEN 120 WHEN 2 THEN 130 WHEN 3 THEN 140 WHEN 4 THEN 150 WHEN 5 THEN 160 WHEN 6 THEN 200
    WHEN 7 THEN 310 WHEN 8 THEN 320 WHEN 9 THEN 330 WHEN 10 THEN 400 WHEN 11 THEN 500 WHEN 12 THEN 600 ELSE 710 END AS element_code,
    950700.0e0 + (p_partkey*5279) % 18501 AS cx, 1940700.0e0 + (p_partkey*8831) % 18503 AS cy, 60.0e0 + p_size*11 AS s FROM part) p
  CROSS JOIN (SELECT 0 AS seg, -1.0e0 AS ax, -0.8e0 AS ay, 0.9e0 AS bx, -1.0e0 AS by_ UNION ALL SELECT 1,0.9e0,-1.0e0,1.0e0,0.7e0 UNION ALL SELECT 2,1.0e0,0.7e0,0.1e0,0.2e0 UNION ALL SELECT 3,0.1e0,0.2e0,-0.7e0,1.0e0 UNION ALL SELECT 4,-0.7e0,1.0e0,-1.0e0,-0.8e0) e
""",
    "river_edge": """
SELECT fid, year, seg, x1, y1, x2, y2 FROM landuse_edge WHERE code = 710
""",
    "coast_seg": """
SELECT r_regionkey AS fid, y.year, s.seg, 948000.0e0 - r_regionkey*500 + s.a*300 AS x1, 1940000.0e0 + r_regionkey*4000 + s.seg*1300 AS y1,
  948000.0e0 - r_regionkey*500 + s.b*300 AS x2, 1940000.0e0 + r_regionkey*4000 + (s.seg+1)*1300 AS y2
  FROM region CROSS JOIN (SELECT 0 AS seg, 0 AS a, 1 AS b UNION ALL SELECT 1,1,-1 UNION ALL SELECT 2,-1,0) s
  CROSS JOIN (SELECT 2000 AS year UNION ALL SELECT 2005 UNION ALL SELECT 2010 UNION ALL SELECT 2015 UNION ALL SELECT 2020) y
""",
    "mdl_seg": """
SELECT fid, year, seg, 950000.0e0 + fid*4000 + seg*1300 AS x1, 1962000.0e0 + fid*150 + x1 % 97 AS y1,
  950000.0e0 + fid*4000 + (seg+1)*1300 AS x2, 1962000.0e0 + fid*150 + x2 % 97 AS y2 FROM coast_seg
""",
    "airport": """
SELECT n_name AS name, y.year, 940000.0e0 + (n_nationkey*7307) % 40009 AS x, 1930000.0e0 + (n_nationkey*9973) % 40013 AS y
  FROM nation CROSS JOIN (SELECT 2000 AS year UNION ALL SELECT 2005 UNION ALL SELECT 2010 UNION ALL SELECT 2015 UNION ALL SELECT 2020) y WHERE n_nationkey % 3 = 0
""",
    "ports": """
SELECT n_name AS alias, y.year, 940000.0e0 + (n_nationkey*4007) % 40009 AS x, 1930000.0e0 + (n_nationkey*8513) % 40013 AS y
  FROM nation CROSS JOIN (SELECT 2000 AS year UNION ALL SELECT 2005 UNION ALL SELECT 2010 UNION ALL SELECT 2015 UNION ALL SELECT 2020) y WHERE n_nationkey % 4 = 1
""",
    "car_registration": """
SELECT cast(11000 + c_nationkey*10 as string) AS sgg_cd, y.year, count(*) * 100 + y.year % 100 AS value
  FROM customer CROSS JOIN (SELECT 2000 AS year UNION ALL SELECT 2005 UNION ALL SELECT 2010 UNION ALL SELECT 2015 UNION ALL SELECT 2020) y GROUP BY c_nationkey, y.year
""",
    "emission_point": """
SELECT o_orderkey AS id, cast(2000 + 5*(o_orderkey % 5) as int) AS year, 950000.0e0 + (o_orderkey*4513) % 19997 AS x, 1940000.0e0 + (o_orderkey*8117) % 19993 AS y,
  o_totalprice/1000 AS co, o_totalprice/2000 AS nox, o_custkey*0.5e0 AS nh3, o_custkey*0.25e0 AS voc, o_totalprice/4000 AS pm10, o_totalprice/8000 AS sox, o_custkey*0.125e0 AS tsp FROM orders
""",
    "emission_line": """
SELECT fid, year, lanes*10.0e0 AS co, lanes*8.0e0 AS nox, lanes*0.5e0 AS nh3, lanes*3.0e0 AS voc, lanes*2.0e0 AS pm10, lanes*1.0e0 AS sox, lanes*4.0e0 AS tsp,
  x1, y1, x2, y2 FROM road_seg WHERE original_id % 3 = 0
""",
    "emission_area": """
SELECT fid, year, code*1.0e0 AS co, code*0.5e0 AS nox, code*0.25e0 AS nh3, code*0.125e0 AS voc, code*2.0e0 AS pm10, code*3.0e0 AS sox, code*4.0e0 AS tsp, seg, x1, y1, x2, y2 FROM landuse_edge WHERE fid % 2 = 0
""",
    "raster_cell": """
SELECT 'dem' AS layer, cast(event_id % 100 as int) AS col, cast(floor(event_id/100) as int) AS row,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE value END AS val FROM events
  UNION ALL SELECT 'dsm', cast(event_id % 100 as int), cast(floor(event_id/100) as int), CASE WHEN event_id % 43 = 0 THEN NULL ELSE value + user_id % 20 END FROM events
""",
    "ndvi_cell": """
SELECT s.statistic, y.year, r.col, r.row, r.val*s.k/500 AS val FROM raster_cell r
  CROSS JOIN (SELECT 'mean' AS statistic, 1.0e0 AS k UNION ALL SELECT 'median',0.9e0 UNION ALL SELECT 'min',0.5e0 UNION ALL SELECT 'max',1.5e0 UNION ALL SELECT '8mdn',1.1e0) s
  CROSS JOIN (SELECT 2000 AS year UNION ALL SELECT 2005 UNION ALL SELECT 2010 UNION ALL SELECT 2015 UNION ALL SELECT 2020) y WHERE r.layer = 'dem'
""",
    "emission_cell": """
SELECT t.emission_type, p.pollutant_type, 2019 AS year, cast(e.event_id % 100 as int) AS col, cast(floor(e.event_id/100) as int) AS row,
  CASE WHEN e.event_id % t.hole = 0 THEN NULL ELSE e.value*t.k*p.k END AS val FROM events e
  CROSS JOIN (SELECT 'point' AS emission_type, 1.0e0 AS k, 37 AS hole UNION ALL SELECT 'line',2.0e0,53 UNION ALL SELECT 'area',3.0e0,71) t
  CROSS JOIN (SELECT 'co' AS pollutant_type, 1.0e0 AS k UNION ALL SELECT 'nox',0.5e0 UNION ALL SELECT 'nh3',0.1e0 UNION ALL SELECT 'voc',0.2e0 UNION ALL SELECT 'pm10',0.3e0 UNION ALL SELECT 'sox',0.4e0 UNION ALL SELECT 'tsp',0.6e0) p
""",
    "sgis_pop": """
SELECT cast(11000 + c_nationkey*10 as string) AS tot_reg_cd, y.year, count(*)*10 + y.year % 7 AS pop, count(*)*4 AS pop_m, count(*)*6 + y.year % 7 AS pop_f
  FROM customer CROSS JOIN (SELECT 2000 AS year UNION ALL SELECT 2005 UNION ALL SELECT 2010 UNION ALL SELECT 2015 UNION ALL SELECT 2020) y GROUP BY c_nationkey, y.year
""",
}

# Wide census table: 19 business columns; further ones follow the pattern of the first six.
_BASES = ["pop", "pop_m", "pop_f"]
RECIPES["sgis_wide"] = (
    "SELECT tot_reg_cd, year, pop*1 AS v_001, pop*2 AS v_002, pop*3 AS v_003, pop_m*1 AS v_004, "
    "pop_m*2 AS v_005, pop_f*2 AS v_006, "
    + ", ".join(f"{_BASES[i % 3]}*{i} AS v_{i:03d}" for i in range(7, 20))
    + " FROM sgis_pop"
)


RECIPES["unit_wide"] = RECIPES["sgis_wide"].replace("sgis_pop", "unit_pop")


def _uses(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    return [n for n in RECIPES if n in words]


def closure(names: list[str]) -> list[str]:
    """The named layers and those they are built from, in order of use."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        for used in _uses(RECIPES[name]):
            if used != name:
                visit(used)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        visit(name)
    return wanted


def register(spark: SparkSession, sf_dir: str) -> None:
    """Register the driver's tables and all layers as temporary views."""
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    for name, sql in RECIPES.items():
        spark.sql(sql).createOrReplaceTempView(name)


def with_layers(sql: str) -> str:
    """Prefix a DuckDB query with the layers it reads."""
    own = re.findall(r"[a-z_0-9]+", sql)
    names = closure([n for n in RECIPES if n in own])
    ctes = ",\n".join(f"{n} AS ({RECIPES[n].strip()})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        body = body[5:]
        return f"WITH {ctes},\n{body}" if ctes else f"WITH {body}"
    return f"WITH {ctes}\n{body}" if ctes else body
