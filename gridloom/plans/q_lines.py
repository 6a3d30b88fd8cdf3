"""Queries for C4 line merge and the cycleroute layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators.assemble import relation_members
from gridloom.operators.labels import global_row_number
from gridloom.functions import geometry as G
from gridloom.operators.linemerge import merge_chains, merge_lines, merge_rows
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import lines, query
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

MEMBERS_SQL = """
rel AS (SELECT o_custkey AS relation_id, o_orderkey AS member_ref,
               CASE WHEN o_custkey % 4 = 0 THEN 'multipolygon' ELSE 'route' END AS type,
               CASE WHEN o_custkey % 3 = 1 THEN 'hiking' ELSE 'bicycle' END AS route,
               CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'C' || CAST(o_custkey % 17 AS VARCHAR) END AS ref,
               'Route ' || CAST(o_custkey % 23 AS VARCHAR) AS name
        FROM orders),
mem AS (SELECT r.ref, r.name, r.member_ref AS fid FROM rel r
        WHERE r.type = 'route' AND r.route = 'bicycle' AND r.member_ref IN (SELECT fid FROM line_verts)),
ends AS (SELECT fid, arg_min(x, seq) AS ex0, arg_min(y, seq) AS ey0, arg_max(x, seq) AS ex1, arg_max(y, seq) AS ey1,
                sum(CASE WHEN nx IS NULL THEN 0 ELSE sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y)) END) AS len
         FROM (SELECT *, lead(x) OVER (PARTITION BY fid ORDER BY seq) AS nx,
                         lead(y) OVER (PARTITION BY fid ORDER BY seq) AS ny FROM line_verts) GROUP BY fid),
me AS (SELECT m.ref, m.name, m.fid, e.* EXCLUDE (fid) FROM mem m JOIN ends e USING (fid)),
pts AS (SELECT ref, name, fid, ex0 AS x, ey0 AS y FROM me UNION ALL SELECT ref, name, fid, ex1, ey1 FROM me),
deg AS (SELECT ref, name, x, y, count(*) AS deg, min(fid) AS u, max(fid) AS v FROM pts GROUP BY ref, name, x, y),
de AS (SELECT ref, name, u, v FROM deg WHERE deg = 2 AND u <> v
       UNION ALL SELECT ref, name, v, u FROM deg WHERE deg = 2 AND u <> v),
reach(ref, name, node, r) AS (
  SELECT ref, name, fid, fid FROM me
  UNION
  SELECT reach.ref, reach.name, de.v, reach.r FROM reach JOIN de
    ON de.ref IS NOT DISTINCT FROM reach.ref AND de.name = reach.name AND de.u = reach.node),
cl AS (SELECT ref, name, node, min(r) AS chain FROM reach GROUP BY ref, name, node),
chains AS (SELECT me.ref, me.name, cl.chain, count(*) AS n_lines, sum(me.len) AS length
           FROM me JOIN cl ON cl.ref IS NOT DISTINCT FROM me.ref AND cl.name = me.name AND cl.node = me.fid
           GROUP BY me.ref, me.name, cl.chain)"""


@query("line_merge", "WITH RECURSIVE " + OF.WAY_NODES.strip() + "," + MEMBERS_SQL + """
SELECT ref, name, chain, n_lines, round(length, 3) AS length FROM chains""")
def q_line_merge(spark, d):
    """C4 + A6: bicycle-route member lines merged per (ref, name)."""
    t = Tables(spark, d)
    m = relation_members(FX.route_relations(t), lines(t)).where(F.col("route") == "bicycle")
    m = m.where(F.col("geom.type") == "LineString").select("ref", F.col("rname").alias("name"), "fid", "geom")
    out = merge_chains(m, ["ref", "name"])
    return out.select("ref", "name", "chain", "n_lines", F.round("length", 3).alias("length"))


@query("cycleroute_merge", "WITH RECURSIVE " + OF.WAY_NODES.strip() + "," + MEMBERS_SQL + """
SELECT row_number() OVER (ORDER BY ref DESC NULLS LAST, name DESC NULLS LAST, chain) AS gid,
       ref, name, chain, n_lines, round(length, 3) AS length FROM chains""")
def q_cycleroute(spark, d):
    """The cycleroute layer: merged chains numbered by ref desc, name desc
    (nulls last), chain -- W1 with an explicit order, without one task."""
    merged = q_line_merge(spark, d)
    return global_row_number(merged, [F.col("ref").desc_nulls_last(), F.col("name").desc_nulls_last(),
                                      F.col("chain")]).select("gid", "ref", "name", "chain", "n_lines", "length")


@query("line_merge_geom", "WITH RECURSIVE " + OF.WAY_NODES.strip() + "," + MEMBERS_SQL + """,
mem_nv AS (SELECT fid, count(*) AS nv FROM line_verts GROUP BY fid),
eps_ AS (SELECT ref, name, fid, 0 AS e, ex0 AS x, ey0 AS y FROM me UNION ALL SELECT ref, name, fid, 1, ex1, ey1 FROM me),
term AS (SELECT p.ref, p.name, p.fid, p.e, p.x, p.y FROM eps_ p JOIN deg d
           ON d.ref IS NOT DISTINCT FROM p.ref AND d.name = p.name AND d.x = p.x AND d.y = p.y
         WHERE d.deg <> 2 OR d.u = d.v),
tc AS (SELECT t.*, cl.chain FROM term t JOIN cl ON cl.ref IS NOT DISTINCT FROM t.ref AND cl.name = t.name
         AND cl.node = t.fid),
ends2 AS (SELECT ref, name, chain, arg_min(x, (fid, e)) AS x0, arg_min(y, (fid, e)) AS y0,
                 arg_max(x, (fid, e)) AS x1, arg_max(y, (fid, e)) AS y1 FROM tc GROUP BY ref, name, chain),
cyc AS (SELECT c.ref, c.name, c.chain, m.ex0 AS x0, m.ey0 AS y0, m.ex0 AS x1, m.ey0 AS y1
        FROM chains c JOIN me m ON m.ref IS NOT DISTINCT FROM c.ref AND m.name = c.name AND m.fid = c.chain
        WHERE NOT EXISTS (SELECT 1 FROM tc WHERE tc.ref IS NOT DISTINCT FROM c.ref AND tc.name = c.name
                          AND tc.chain = c.chain)),
se AS (SELECT * FROM ends2 UNION ALL SELECT * FROM cyc),
nvs AS (SELECT me.ref, me.name, cl.chain, sum(n.nv) AS snv FROM me
        JOIN cl ON cl.ref IS NOT DISTINCT FROM me.ref AND cl.name = me.name AND cl.node = me.fid
        JOIN mem_nv n ON n.fid = me.fid GROUP BY me.ref, me.name, cl.chain)
SELECT c.ref, c.name, c.chain, c.n_lines, CAST(v.snv - (c.n_lines - 1) AS INTEGER) AS nv,
       se.x0, se.y0, se.x1, se.y1, round(c.length, 3) AS length
FROM chains c
JOIN nvs v ON v.ref IS NOT DISTINCT FROM c.ref AND v.name = c.name AND v.chain = c.chain
JOIN se ON se.ref IS NOT DISTINCT FROM c.ref AND se.name = c.name AND se.chain = c.chain""")
def q_line_merge_geom(spark, d):
    """C4 with geometry: bicycle-route member lines merged per (ref, name)
    into one ordered LineString per chain (members oriented, junctions once)."""
    t = Tables(spark, d)
    m = relation_members(FX.route_relations(t), lines(t)).where(F.col("route") == "bicycle")
    m = m.where(F.col("geom.type") == "LineString").select("ref", F.col("rname").alias("name"), "fid", "geom")
    out = merge_lines(m, ["ref", "name"])
    v = F.element_at(F.element_at("geom.parts", 1), 1)
    return out.select("ref", "name", "chain", "n_lines", F.size(v).cast("int").alias("nv"),
                      F.element_at(v, 1)["x"].alias("x0"), F.element_at(v, 1)["y"].alias("y0"),
                      F.element_at(v, -1)["x"].alias("x1"), F.element_at(v, -1)["y"].alias("y1"),
                      F.round(G.length("geom"), 3).alias("length"))


MOST = 5  # vertices of a row, few here so that chains have several
_GLOBAL_SQL = MEMBERS_SQL.replace("CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'C' || CAST(o_custkey % 17 AS VARCHAR) END AS ref", "0 AS ref").replace(
    "'Route ' || CAST(o_custkey % 23 AS VARCHAR) AS name", "0 AS name")


@query("merge_global", "WITH RECURSIVE " + OF.WAY_NODES.strip() + "," + _GLOBAL_SQL + f""",
nv AS (SELECT cl.chain, sum(n.nv) - (any_value(c.n_lines) - 1) AS nv, any_value(c.length) AS length
       FROM cl JOIN chains c ON c.chain = cl.chain JOIN (SELECT fid, count(*) AS nv FROM line_verts GROUP BY fid) n ON n.fid = cl.node GROUP BY cl.chain)
SELECT chain, CAST(greatest(1, ceil((nv - 1) / {float(MOST - 1)})) AS BIGINT) AS n_rows, CAST(nv AS BIGINT) AS n_vertices, round(length, 3) AS length, TRUE AS bounded FROM nv""")
def q_merge_global(spark, d):
    """All bicycle-route members merged as one group, in rows of at most MOST vertices."""
    t = Tables(spark, d)
    m = relation_members(FX.route_relations(t), lines(t)).where(F.col("route") == "bicycle")
    rows = merge_rows(m.where(F.col("geom.type") == "LineString").select("fid", "geom"), [], most=MOST)
    n = G.num_vertices("geom")
    out = rows.groupBy("chain").agg(F.count(F.lit(1)).alias("n_rows"), (F.sum(n) - F.count(F.lit(1)) + 1).alias("n_vertices"),
                                    F.round(F.sum(G.length("geom")), 3).alias("length"), F.max(n).alias("most"))
    return out.select("chain", "n_rows", "n_vertices", "length", (F.col("most") <= MOST).alias("bounded"))
