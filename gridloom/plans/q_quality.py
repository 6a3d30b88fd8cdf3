"""G14 validity report query."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators.validity import repair, validity_report
from gridloom.plans.catalog import query
from gridloom.plans.oracle_fixtures import _OCT
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

_V = ", ".join(f"{{'x': CAST({x} AS DOUBLE), 'y': CAST({y} AS DOUBLE)}}" for x, y in _OCT)

VALIDITY_SQL = f"""
WITH base AS (
  SELECT p_partkey AS osm_id, p_partkey AS k, (p_partkey*7919) % 20011 AS cx, (p_partkey*104729) % 20011 AS cy,
         p_size*10 AS r, p_size*3 AS c FROM part),
l0 AS (SELECT osm_id, k, [{_V}] AS s FROM base),
l1 AS (SELECT osm_id, k, CASE WHEN k % 11 = 0 THEN [s[1], s[3], s[2]] || s[4:9] ELSE s END AS s FROM l0),
l2 AS (SELECT osm_id, k, CASE WHEN k % 13 = 0 THEN s[1:4] || s[4:len(s)] ELSE s END AS s FROM l1),
l3 AS (SELECT osm_id, CASE WHEN k % 17 = 0 THEN s[1:len(s) - 1] ELSE s END AS s FROM l2),
v AS (SELECT osm_id, generate_subscripts(s, 1) - 1 AS seq, unnest(s) AS p FROM l3),
vv AS (SELECT osm_id, seq, p.x AS x, p.y AS y FROM v),
st AS (SELECT osm_id,
              CAST(sum(CASE WHEN x = px AND y = py THEN 1 ELSE 0 END) AS INTEGER) AS n_repeated,
              CAST(max(CASE WHEN seq = 0 THEN 0 END) AS INTEGER) AS z0, count(*) AS nv,
              arg_min(x, seq) AS x0, arg_min(y, seq) AS y0, arg_max(x, seq) AS x1, arg_max(y, seq) AS y1
       FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM vv
             WINDOW w AS (PARTITION BY osm_id ORDER BY seq)) GROUP BY osm_id),
e AS (SELECT osm_id, seq AS i, x AS ax, y AS ay, nx AS bx, ny AS by_, count(*) OVER (PARTITION BY osm_id) AS m
      FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM vv
            WINDOW w AS (PARTITION BY osm_id ORDER BY seq)) WHERE nx IS NOT NULL),
pr AS (SELECT a.osm_id, a.i, b.i AS j, a.ax, a.ay, a.bx, a.by_, b.ax AS cx, b.ay AS cy, b.bx AS dx, b.by_ AS dy
       FROM e a JOIN e b ON a.osm_id = b.osm_id AND a.i < b.i
       WHERE NOT (b.i - a.i = 1 OR (a.i = 0 AND b.i = a.m - 1))),
o AS (SELECT *, sign((bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax)) AS o1,
                sign((bx - ax) * (dy - ay) - (by_ - ay) * (dx - ax)) AS o2,
                sign((dx - cx) * (ay - cy) - (dy - cy) * (ax - cx)) AS o3,
                sign((dx - cx) * (by_ - cy) - (dy - cy) * (bx - cx)) AS o4 FROM pr),
cr AS (SELECT osm_id, CAST(count(*) AS INTEGER) AS n_crossings FROM o
       WHERE (o1 <> o2 AND o3 <> o4)
          OR (o1 = 0 AND least(ax, bx) <= cx AND cx <= greatest(ax, bx) AND least(ay, by_) <= cy
              AND cy <= greatest(ay, by_))
          OR (o2 = 0 AND least(ax, bx) <= dx AND dx <= greatest(ax, bx) AND least(ay, by_) <= dy
              AND dy <= greatest(ay, by_))
          OR (o3 = 0 AND least(cx, dx) <= ax AND ax <= greatest(cx, dx) AND least(cy, dy) <= ay
              AND ay <= greatest(cy, dy))
          OR (o4 = 0 AND least(cx, dx) <= bx AND bx <= greatest(cx, dx) AND least(cy, dy) <= by_
              AND by_ <= greatest(cy, dy))
       GROUP BY osm_id)
SELECT st.osm_id AS fid, st.n_repeated,
       CAST(CASE WHEN x0 = x1 AND y0 = y1 THEN 0 ELSE 1 END AS INTEGER) AS n_unclosed,
       CAST(CASE WHEN nv < 4 THEN 1 ELSE 0 END AS INTEGER) AS n_short,
       coalesce(cr.n_crossings, 0) AS n_crossings,
       (st.n_repeated = 0 AND x0 = x1 AND y0 = y1 AND nv >= 4 AND coalesce(cr.n_crossings, 0) = 0) AS valid
FROM st LEFT JOIN cr USING (osm_id)"""


@query("validity_report", VALIDITY_SQL)
def q_validity(spark, d):
    """Faults per polygon (repeated vertices, open / short rings, edge crossings)."""
    g = FX.faulty_polygons(Tables(spark, d)).select(F.col("osm_id").alias("fid"), "geom")
    return validity_report(g).select("fid", "n_repeated", "n_unclosed", "n_short", "n_crossings", "valid")


@query("validity_repair", VALIDITY_SQL[:VALIDITY_SQL.index("st AS (SELECT")] + """
steps AS (SELECT osm_id, seq, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py FROM vv WINDOW w AS (PARTITION BY osm_id ORDER BY seq)),
kept AS (SELECT osm_id, seq, x, y FROM steps WHERE px IS NULL OR NOT (x = px AND y = py)),
ends AS (SELECT osm_id, count(*) AS n, arg_min(x, seq) AS x0, arg_min(y, seq) AS y0, arg_max(x, seq) AS x1, arg_max(y, seq) AS y1 FROM kept GROUP BY osm_id)
SELECT osm_id AS fid, CAST(n + CASE WHEN x0 = x1 AND y0 = y1 THEN 0 ELSE 1 END AS INTEGER) AS n_vertices
FROM ends WHERE n + CASE WHEN x0 = x1 AND y0 = y1 THEN 0 ELSE 1 END >= 4""")
def q_validity_repair(spark, d):
    """The faulty polygons with repeated vertices dropped, open rings closed and short rings left out."""
    g = FX.faulty_polygons(Tables(spark, d)).select(F.col("osm_id").alias("fid"), repair("geom").alias("geom"))
    return g.where(F.size("geom.parts") > 0).select("fid", G.num_vertices("geom").alias("n_vertices"))
