"""DuckDB twins of ``gridloom.sources.fixtures`` (CTE bodies).

The oracle SQL rebuilds the same integer-valued inputs from the driver views,
then computes each operator's answer with plain SQL arithmetic. These are CTE
bodies meant to be placed in a ``WITH`` list.
"""

from __future__ import annotations

from gridloom.functions.rules import ENUMS
from gridloom.sources.fixtures import GRID, LANDUSE_PAIRS, PLACE_VALUES, POI_PAIRS, ROAD_VALUES, WATER_PAIRS


def _lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values, idx_sql: str) -> str:
    return f"{_lst(values)}[(({idx_sql}) % {len(values)}) + 1]"


POI = f"""
poi AS (
  SELECT c_custkey AS osm_id,
         CAST((c_custkey*7919 + c_custkey*c_custkey*31) % {GRID} AS DOUBLE) AS x,
         CAST((c_custkey*104729 + c_custkey*c_custkey*17) % {GRID} AS DOUBLE) AS y,
         {pick([p[0] for p in POI_PAIRS], 'c_custkey*7 + c_nationkey')} AS class,
         {pick([p[1] for p in POI_PAIRS], 'c_custkey*7 + c_nationkey')} AS subclass,
         CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN NULL ELSE 'DE ' || c_name END AS name_de,
         CASE WHEN c_custkey % 2 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN NULL ELSE 'EN ' || c_name END AS name_en,
         CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS name,
         CAST(floor(c_acctbal) AS INTEGER) AS ele,
         CAST(c_custkey % 2 AS INTEGER) AS access,
         CAST(c_custkey % 3 AS INTEGER) AS parking,
         CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS subway,
         CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS religion
  FROM customer)"""

LABEL = f"""
label_pts AS (
  SELECT c_custkey AS osm_id,
         CAST((c_custkey*15485863) % {GRID} AS DOUBLE) AS x,
         CAST((c_custkey*32452843) % {GRID} AS DOUBLE) AS y,
         'place' AS class,
         {pick(PLACE_VALUES, 'c_custkey')} AS subclass,
         CASE WHEN c_custkey % 3 = 0 THEN 'LD' || CAST(c_custkey % 150 AS VARCHAR) ELSE '' END AS name_de,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '' END AS name_en,
         'L' || CAST(c_custkey % 200 AS VARCHAR) AS name,
         CAST(c_custkey % 3000 AS INTEGER) AS ele,
         CAST(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE (c_custkey % 50) * 100 END AS INTEGER) AS pop
  FROM customer)"""

# node rows of the ways, with the order the assembly must follow
WAY_NODES = f"""
way_nodes AS (
  SELECT o_orderkey AS fid, l_linenumber AS k1, l_partkey AS k2, l_suppkey AS k3,
         CAST((o_orderkey*7919) % {GRID} + l_partkey % 997 AS DOUBLE) AS x,
         CAST((o_orderkey*104729) % {GRID} + (l_suppkey*37) % 991 AS DOUBLE) AS y
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
way_seq AS (
  SELECT fid, x, y,
         CAST(row_number() OVER (PARTITION BY fid ORDER BY k1, k2, k3) - 1 AS INTEGER) AS seq,
         count(*) OVER (PARTITION BY fid) AS nv
  FROM way_nodes),
line_verts AS (SELECT fid, seq, x, y FROM way_seq WHERE nv >= 2)"""

_RANK_LIST = _lst(ENUMS["rank"])

WAY_ATTRS = f"""
way_attrs AS (
  SELECT o_orderkey AS fid, 'highway' AS class,
         {pick(ROAD_VALUES, 'o_orderkey')} AS subclass,
         (o_orderkey % 2 = 0) AS oneway,
         CAST(o_orderkey % 6 AS INTEGER) AS tracktype,
         CAST(o_orderkey % 3 AS INTEGER) AS service,
         CAST(o_orderkey % 4 AS INTEGER) AS bicycle,
         CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 7 END AS INTEGER) AS scale,
         (o_orderkey % 10 = 1) AS tunnel,
         (o_orderkey % 9 = 0) AS bridge,
         CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 5 - 2 END AS INTEGER) AS layer,
         CASE WHEN o_orderkey % 3 = 0 THEN 'A ' || CAST(o_orderkey % 100 AS VARCHAR)
              WHEN o_orderkey % 3 = 1 THEN 'B' END AS ref,
         CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'RD' || CAST(o_custkey % 40 AS VARCHAR) END AS name_de,
         CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE '' END AS name_en,
         'R' || CAST(o_custkey % 40 AS VARCHAR) AS name,
         CASE WHEN o_orderkey % 8 = 0 THEN 'summer_toboggan' WHEN o_orderkey % 8 = 1 THEN NULL ELSE '' END
           AS attraction,
         ['river', 'canal', 'stream', 'ditch'][(o_orderkey % 4) + 1] AS water_subclass
  FROM orders),
way_attrs_r AS (
  SELECT *, CAST(coalesce(list_position({_RANK_LIST}, subclass), 0) AS INTEGER) AS rank FROM way_attrs)"""

# Octagon shell (counter-clockwise, 9 vertices incl. closing) + optional hole.
_OCT = [
    ("cx - r + c", "cy - r"), ("cx + r - c", "cy - r"), ("cx + r", "cy - r + c"), ("cx + r", "cy + r - c"),
    ("cx + r - c", "cy + r"), ("cx - r + c", "cy + r"), ("cx - r", "cy + r - c"), ("cx - r", "cy - r + c"),
    ("cx - r + c", "cy - r"),
]
_HOLE = [("cx - h", "cy - h"), ("cx - h", "cy + h"), ("cx + h", "cy + h"), ("cx + h", "cy - h"), ("cx - h", "cy - h")]
_VERTS = ", ".join(
    [f"{{'ring': 0, 'seq': {i}, 'x': CAST({x} AS DOUBLE), 'y': CAST({y} AS DOUBLE)}}" for i, (x, y) in enumerate(_OCT)]
    + [f"{{'ring': 1, 'seq': {i}, 'x': CAST({x} AS DOUBLE), 'y': CAST({y} AS DOUBLE)}}"
       for i, (x, y) in enumerate(_HOLE)]
)

POLY = f"""
poly_base AS (
  SELECT p_partkey AS osm_id, p_partkey, p_size,
         (p_partkey*7919) % {GRID} AS cx, (p_partkey*104729) % {GRID} AS cy,
         p_size*10 AS r, p_size*3 AS c, p_size AS h,
         {pick([p[0] for p in LANDUSE_PAIRS], 'p_partkey')} AS submap,
         {pick([p[1] for p in LANDUSE_PAIRS], 'p_partkey')} AS class,
         {pick([p[2] for p in LANDUSE_PAIRS], 'p_partkey')} AS subclass,
         {pick([p[1] for p in WATER_PAIRS], 'p_partkey')} AS water_subclass,
         CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'PD' || CAST(p_partkey % 90 AS VARCHAR) END AS name_de,
         CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE '' END AS name_en,
         CASE WHEN p_partkey % 9 = 0 THEN '' ELSE 'P' || CAST(p_partkey % 90 AS VARCHAR) END AS name,
         CAST(p_partkey % 900 AS INTEGER) AS ele,
         CASE WHEN p_partkey % 3 = 0 THEN 'paved' ELSE '' END AS surface
  FROM part),
poly_verts_raw AS (
  SELECT osm_id, p_partkey, unnest([{_VERTS}]) AS v FROM poly_base),
poly_verts AS (
  SELECT osm_id, v.ring AS ring, v.seq AS seq, v.x AS x, v.y AS y
  FROM poly_verts_raw WHERE v.ring = 0 OR p_partkey % 7 = 0)"""

TRACK = """
track_pts AS (
  SELECT user_id AS track_id, event_id AS point_id, ts AS time,
         10.0 + ((event_id*31) % 1000) / 1000.0 AS lon,
         48.0 + ((event_id*17) % 1000) / 1000.0 AS lat,
         value AS ele,
         CAST(CASE WHEN event_id % 4 = 0 THEN NULL ELSE 60 + event_id % 100 END AS DOUBLE) AS hr
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)
