"""Registered queries: name -> (spark plan, DuckDB oracle SQL or None).

Each Spark plan reads the driver tables under ``sf_dir`` through the fixture
builders and runs the library's operator over all of it. Each oracle rebuilds
the same inputs in DuckDB from the pre-registered driver views and computes
the answer with plain SQL. Floats are rounded on both sides; every output
column is aliased to the same name on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators import attributes as A
from gridloom.operators.assemble import assemble_lines
from gridloom.operators.cluster import cluster_points
from gridloom.plans import oracle_fixtures as OF
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

# Fixed value: the name fallback of the layers, as SQL
NAME_SQL = ("CASE WHEN (name_de <> '') IS NOT FALSE THEN name_de WHEN (name_en <> '') IS NOT FALSE THEN name_en "
            "ELSE name END")


def query(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def lines(t: Tables) -> DataFrame:
    """Assembled ways (fid, geom, nv) -- S2 over the node rows."""
    return assemble_lines(FX.way_nodes(t), "fid", ("k1", "k2", "k3"))


# ---------------------------------------------------------------- P: attributes

@query("name_fallback", OF.with_(OF.POI) + f"\nSELECT osm_id, {NAME_SQL} AS name FROM poi")
def q_name_fallback(spark, d):
    p = FX.poi_points(Tables(spark, d))
    return p.select("osm_id", A.name_fallback().alias("name"))


@query("filter_project", OF.with_(OF.LABEL) + f"""
SELECT osm_id, x, y, class, subclass, {NAME_SQL} AS name, ele, pop
FROM label_pts WHERE subclass NOT IN ('city', 'hamlet')""")
def q_filter_project(spark, d):
    lab = FX.label_points(Tables(spark, d))
    lab = lab.withColumn("geom", G.point_geom("x", "y"))
    out = A.filter_project(lab, ["osm_id", "x", "y", "class", "subclass", A.name_fallback().alias("name"), "ele",
                                 "pop"], ~F.col("subclass").isin("city", "hamlet"))
    return out.drop("geom")


@query("not_true_filter", OF.with_(OF.WAY_ATTRS) + """
SELECT fid, attraction FROM way_attrs WHERE (attraction <> '') IS NOT TRUE""")
def q_not_true(spark, d):
    w = FX.way_attrs(Tables(spark, d))
    return w.where(A.is_not_true(F.col("attraction") != "")).select("fid", "attraction")


@query("ref_parts", OF.with_(OF.WAY_ATTRS) + r"""
SELECT fid, nullif(regexp_extract(ref, '\w+'), '') AS ref_prefix, nullif(regexp_extract(ref, '\d+'), '') AS ref_num,
       CAST(CASE WHEN layer IS NULL THEN 0 ELSE layer END AS INTEGER) AS layer
FROM way_attrs""")
def q_ref_parts(spark, d):
    w = FX.way_attrs(Tables(spark, d))
    return w.select("fid", A.ref_prefix().alias("ref_prefix"), A.ref_number().alias("ref_num"),
                    A.null_default("layer").cast("int").alias("layer"))


# ---------------------------------------------------------------- G: measures

_POLY_AREA_SQL = """
ring_area AS (
  SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
  FROM (SELECT osm_id, ring, seq, x, y,
               lead(x) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS ny FROM poly_verts)
  WHERE nx IS NOT NULL GROUP BY osm_id, ring),
poly_area AS (
  SELECT osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM ring_area GROUP BY osm_id)"""

_RING_LEN_SQL = """
poly_perim AS (
  SELECT osm_id, sum(sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y))) AS perimeter
  FROM (SELECT osm_id, ring, seq, x, y,
               lead(x) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS ny FROM poly_verts)
  WHERE nx IS NOT NULL GROUP BY osm_id)"""

_LINE_LEN_SQL = """
line_len AS (
  SELECT fid, sum(CASE WHEN nx IS NULL THEN 0 ELSE sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y)) END) AS length,
         count(*) AS nv,
         bool_and(CASE WHEN seq = 0 THEN (x = lx AND y = ly) ELSE TRUE END) AS closed
  FROM (SELECT fid, seq, x, y,
               lead(x) OVER (PARTITION BY fid ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY fid ORDER BY seq) AS ny,
               last_value(x) OVER (PARTITION BY fid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING
                                   AND UNBOUNDED FOLLOWING) AS lx,
               last_value(y) OVER (PARTITION BY fid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING
                                   AND UNBOUNDED FOLLOWING) AS ly
        FROM line_verts)
  GROUP BY fid)"""


@query("polygon_area", OF.with_(OF.POLY, _POLY_AREA_SQL) + """
SELECT osm_id, round(area, 3) AS area FROM poly_area""")
def q_polygon_area(spark, d):
    p = FX.polygons(Tables(spark, d))
    return p.select("osm_id", F.round(G.area("geom"), 3).alias("area"))


@query("perimeter", OF.with_(OF.POLY, _RING_LEN_SQL) + """
SELECT osm_id, round(perimeter, 4) AS perimeter, CAST(round_even(perimeter, 0) AS INTEGER) AS perimeter_int
FROM poly_perim""")
def q_perimeter(spark, d):
    p = FX.polygons(Tables(spark, d))
    per = G.perimeter("geom")
    return p.select("osm_id", F.round(per, 4).alias("perimeter"), A.as_pg_int(per).alias("perimeter_int"))


@query("line_length", OF.with_(OF.WAY_NODES, _LINE_LEN_SQL) + """
SELECT fid, round(length, 4) AS length, CAST(round_even(length, 0) AS INTEGER) AS length_int,
       CAST(nv AS INTEGER) AS nv, closed FROM line_len""")
def q_line_length(spark, d):
    ln = lines(Tables(spark, d))
    length = G.length("geom")
    return ln.select("fid", F.round(length, 4).alias("length"), A.as_pg_int(length).alias("length_int"),
                     F.col("nv").cast("int").alias("nv"), G.is_closed("geom").alias("closed"))


@query("is_closed", OF.with_(OF.POLY) + """
SELECT osm_id, bool_and(x0 = xl AND y0 = yl) AS closed, CAST(sum(n) AS INTEGER) AS nv
FROM (SELECT osm_id, ring, arg_min(x, seq) AS x0, arg_min(y, seq) AS y0, arg_max(x, seq) AS xl,
             arg_max(y, seq) AS yl, count(*) AS n
      FROM poly_verts GROUP BY osm_id, ring)
GROUP BY osm_id""")
def q_is_closed(spark, d):
    p = FX.polygons(Tables(spark, d))
    return p.select("osm_id", G.is_closed("geom").alias("closed"), G.num_vertices("geom").cast("int").alias("nv"))


# ---------------------------------------------------------------- C1: clustering

# Radius and filter of every clustering rung
_CLUSTER_RUNGS = {
    # rung: (eps, filter) -- the POI ladder
    "cluster_gen11": (300, "subclass IN ('station', 'halt') AND subway = 0"),
    "cluster_gen12": (160, "subclass IN ('station', 'halt', 'alpine_hut', 'hotel', 'peak', 'pub', 'fast_food', "
                           "'restaurant', 'biergarten', 'hospital', 'shelter', 'camp_site', 'caravan_site')"),
    "cluster_gen13": (160, "subclass IN ('station', 'halt', 'alpine_hut', 'hotel', 'peak', 'pub', 'fast_food', "
                           "'restaurant', 'biergarten', 'hospital', 'shelter', 'camp_site', 'caravan_site', "
                           "'bicycle')"),
    "cluster_gen14": (120, "subclass NOT IN ('playground', 'viewpoint', 'information')"),
    "cluster_gen15": (80, None),
    "cluster_gen16": (40, None),
    "cluster_gen17": (20, None),
    "cluster_300": (300, None),
}


def _cluster_sql(eps: float, cond: str | None) -> str:
    where = f"WHERE {cond}" if cond else ""
    return "WITH RECURSIVE " + OF.POI.strip() + f""",
pts AS (SELECT * FROM poi {where}),
dedges AS (SELECT a.osm_id AS u, b.osm_id AS v FROM pts a JOIN pts b
           ON a.osm_id <> b.osm_id AND (a.x - b.x)*(a.x - b.x) + (a.y - b.y)*(a.y - b.y) <= {eps * eps}),
reach(node, r) AS (
  SELECT osm_id, osm_id FROM pts
  UNION
  SELECT d.v, reach.r FROM reach JOIN dedges d ON d.u = reach.node),
cl AS (SELECT node, min(r) AS cid FROM reach GROUP BY node),
c AS (SELECT pts.*, cl.cid FROM pts JOIN cl ON cl.node = pts.osm_id),
pos AS (SELECT class, subclass, cid, avg(x) AS ax, avg(y) AS ay
        FROM (SELECT DISTINCT class, subclass, cid, x, y FROM c) GROUP BY class, subclass, cid)
SELECT min(osm_id) AS id, count(osm_id) AS count, c.class, c.subclass,
       arg_min_null(name, osm_id) FILTER (WHERE name IS NULL OR name <> '') AS name,
       arg_min_null(ele, osm_id) AS ele, arg_min_null(access, osm_id) AS access,
       arg_min_null(religion, osm_id) AS religion, arg_min_null(parking, osm_id) AS parking,
       arg_min_null(subway, osm_id) AS subway,
       round(any_value(pos.ax), 4) AS x, round(any_value(pos.ay), 4) AS y
FROM c JOIN pos ON c.class = pos.class AND c.subclass = pos.subclass AND c.cid = pos.cid
GROUP BY c.class, c.subclass, c.cid"""


def cluster_ctes(eps: float, cond: str | None, sfx: str) -> str:
    """CTEs ending in ``clus{sfx}`` (the cluster summary of the poi CTE)."""
    where = f"WHERE {cond}" if cond else ""
    return f"""
pts{sfx} AS (SELECT * FROM poi {where}),
de{sfx} AS (SELECT a.osm_id AS u, b.osm_id AS v FROM pts{sfx} a JOIN pts{sfx} b
           ON a.osm_id <> b.osm_id AND (a.x - b.x)*(a.x - b.x) + (a.y - b.y)*(a.y - b.y) <= {eps * eps}),
reach{sfx}(node, r) AS (
  SELECT osm_id, osm_id FROM pts{sfx}
  UNION
  SELECT d.v, reach{sfx}.r FROM reach{sfx} JOIN de{sfx} d ON d.u = reach{sfx}.node),
cl{sfx} AS (SELECT node, min(r) AS cid FROM reach{sfx} GROUP BY node),
c{sfx} AS (SELECT pts{sfx}.*, cl{sfx}.cid FROM pts{sfx} JOIN cl{sfx} ON cl{sfx}.node = pts{sfx}.osm_id),
pos{sfx} AS (SELECT class, subclass, cid, avg(x) AS ax, avg(y) AS ay
        FROM (SELECT DISTINCT class, subclass, cid, x, y FROM c{sfx}) GROUP BY class, subclass, cid),
clus{sfx} AS (
  SELECT min(osm_id) AS id, count(osm_id) AS count, c.class, c.subclass,
         any_value(pos{sfx}.ax) AS x, any_value(pos{sfx}.ay) AS y
  FROM c{sfx} c JOIN pos{sfx} ON c.class = pos{sfx}.class AND c.subclass = pos{sfx}.subclass
                AND c.cid = pos{sfx}.cid
  GROUP BY c.class, c.subclass, c.cid)"""


def _cluster_query(eps: float, cond: str | None) -> QueryFn:
    def run(spark, d):
        p = FX.poi_points(Tables(spark, d))
        out = cluster_points(p, eps, F.expr(cond) if cond else None)
        return out.select("id", "count", "class", "subclass", "name", "ele", "access", "religion", "parking",
                          "subway", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))
    return run


for _name, (_eps, _cond) in _CLUSTER_RUNGS.items():
    query(_name, _cluster_sql(_eps, _cond))(_cluster_query(_eps, _cond))


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load_plans() -> None:
    """Plan modules register their queries on import."""
    from gridloom.plans import q_areas, q_borders, q_closing, q_coarse, q_generalize, q_io, q_layers, q_lines, q_mapping, q_points, q_quality, q_serve, q_store, q_tiles, q_world  # noqa: F401,E501


_load_plans()
