"""Queries for G9 point on surface, C5/C6 (to points), label_waterarea ladder,
A10/A11 tracks, G17 reprojection, G18 box clip."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators import attributes as A
from gridloom.operators.ladder import Rung, rung_membership
from gridloom.operators.topoint import merge_to_point, reduce_to_point
from gridloom.operators.tracks import track_bounds, track_length
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import NAME_SQL, query
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

# DuckDB scanline: widest gap between distinct vertex heights, crossings,
# widest inside run (leftmost on ties). Input poly_verts(osm_id, ring, seq, x, y).
POS_SQL = """
ys AS (SELECT DISTINCT osm_id, y FROM poly_verts),
gaps AS (SELECT osm_id, y AS a, lead(y) OVER (PARTITION BY osm_id ORDER BY y) AS b FROM ys),
scan AS (SELECT osm_id, arg_max((a + b) / 2.0, (b - a, -a)) AS y0 FROM gaps WHERE b IS NOT NULL GROUP BY osm_id),
edges AS (SELECT v.osm_id, v.x, v.y, lead(v.x) OVER w AS nx, lead(v.y) OVER w AS ny
          FROM poly_verts v WINDOW w AS (PARTITION BY v.osm_id, v.ring ORDER BY v.seq)),
xs AS (SELECT e.osm_id, e.x + (s.y0 - e.y) * (e.nx - e.x) / (e.ny - e.y) AS cx, s.y0
       FROM edges e JOIN scan s USING (osm_id)
       WHERE e.nx IS NOT NULL AND ((e.y > s.y0) <> (e.ny > s.y0))),
xr AS (SELECT osm_id, cx, y0, (row_number() OVER (PARTITION BY osm_id ORDER BY cx) - 1) // 2 AS run FROM xs),
runs AS (SELECT osm_id, run, min(cx) AS l, max(cx) AS r, any_value(y0) AS y0 FROM xr GROUP BY osm_id, run),
pos AS (SELECT osm_id, arg_max((l + r) / 2.0, (r - l, -l)) AS px, any_value(y0) AS py FROM runs GROUP BY osm_id)"""


@query("point_on_surface", OF.with_(OF.POLY, POS_SQL) + """
SELECT osm_id, round(px, 4) AS px, round(py, 4) AS py FROM pos""")
def q_point_on_surface(spark, d):
    p = FX.polygons(Tables(spark, d))
    p = G.with_point_on_surface(p, "geom", "px", "py")
    return p.select("osm_id", F.round("px", 4).alias("px"), F.round("py", 4).alias("py"))


@query("merge_to_point", OF.with_(OF.POLY, POS_SQL, OF.POI) + f"""
SELECT 'polygon' AS src, b.osm_id, round(px, 4) AS x, round(py, 4) AS y, b.class, b.subclass, {NAME_SQL} AS name
FROM poly_base b JOIN pos USING (osm_id) WHERE (name <> '') IS NOT FALSE
UNION ALL
SELECT 'point', osm_id, round(x, 4), round(y, 4), class, subclass, {NAME_SQL} FROM poi
WHERE (name <> '') IS NOT FALSE""")
def q_merge_to_point(spark, d):
    """C5 + U1: POI polygons to points, union all POI points, one filter."""
    t = Tables(spark, d)
    polys = FX.polygons(t).withColumn("src", F.lit("polygon"))
    pts = FX.poi_points(t).withColumn("src", F.lit("point"))
    cols = ["src", "osm_id", "class", "subclass", A.name_fallback().alias("name")]
    cond = A.is_not_false(F.col("name") != "")
    out = merge_to_point(polys, pts, cols, cond)
    return out.select("src", "osm_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), "class", "subclass",
                      "name")


# Rung and filter
WATERLABEL_RUNGS = [(14, "area > 100000"), (12, "area > 1000000"), (10, "area > 10000000"), (8, "area > 100000000")]
_WL_COND = ("water_subclass NOT IN ('riverbank', 'swimming_pool') AND ((name_de <> '') IS NOT FALSE "
            "OR (name_en <> '') IS NOT FALSE OR (name <> '') IS NOT FALSE)")

_AREA_SQL = """
ring_area AS (
  SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
  FROM (SELECT osm_id, ring, seq, x, y,
               lead(x) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS ny FROM poly_verts)
  WHERE nx IS NOT NULL GROUP BY osm_id, ring),
parea AS (SELECT osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM ring_area GROUP BY osm_id)"""


@query("reduce_to_point", OF.with_(OF.POLY, POS_SQL, _AREA_SQL, f"""
lw AS (SELECT b.osm_id, round(px, 4) AS x, round(py, 4) AS y, water_subclass AS subclass, round(area, 3) AS area,
              ele, {NAME_SQL} AS name, area AS a_raw
       FROM poly_base b JOIN pos USING (osm_id) JOIN parea USING (osm_id) WHERE {_WL_COND})""") + """
SELECT 16 AS gen, osm_id, x, y, subclass, area, ele, name FROM lw
""" + "".join(f"UNION ALL SELECT {g}, osm_id, x, y, subclass, area, ele, name FROM lw WHERE a_raw > {c.split('>')[1]}\n"
              for g, c in WATERLABEL_RUNGS))
def q_reduce_to_point(spark, d):
    """C6 label_waterarea + its filter ladder (gen 16 = the base table)."""
    p = FX.polygons(Tables(spark, d)).withColumn("area", G.area("geom"))
    lw = reduce_to_point(p, ["osm_id", F.col("water_subclass").alias("subclass"), "area", "ele",
                             A.name_fallback().alias("name")], F.expr(_WL_COND))
    rungs = [Rung(16, 0.0)] + [Rung(g, 0.0, F.expr(c)) for g, c in WATERLABEL_RUNGS]
    m = rung_membership(lw, rungs, fid="osm_id")
    out = lw.join(m, "osm_id")
    return out.select(F.col("gen").cast("int").alias("gen"), "osm_id", F.round("x", 4).alias("x"),
                      F.round("y", 4).alias("y"), "subclass", F.round("area", 3).alias("area"), "ele", "name")


_HAV = ("2 * 6371.0088 * atan2(sqrt(a), sqrt(1 - a))")


@query("track_length", OF.with_(OF.TRACK, f"""
lg AS (SELECT track_id, lon, lat,
              lag(lon) OVER (PARTITION BY track_id ORDER BY time, point_id) AS plon,
              lag(lat) OVER (PARTITION BY track_id ORDER BY time, point_id) AS plat FROM track_pts),
hv AS (SELECT track_id, CASE WHEN plon IS NULL THEN 0.0 ELSE {_HAV} END AS leg
       FROM (SELECT *, sin(((lat - plat) * {math.pi / 180.0!r}) / 2) ** 2
                       + cos(plat * {math.pi / 180.0!r}) * cos(lat * {math.pi / 180.0!r})
                         * sin(((lon - plon) * {math.pi / 180.0!r}) / 2) ** 2 AS a FROM lg))""") + """
SELECT track_id, round(sum(leg), 2) AS km, count(*) AS n_points FROM hv GROUP BY track_id""")
def q_track_length(spark, d):
    return track_length(FX.track_points(Tables(spark, d)))


@query("track_bounds", OF.with_(OF.TRACK) + """
SELECT track_id, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat
FROM track_pts GROUP BY track_id""")
def q_track_bounds(spark, d):
    return track_bounds(FX.track_points(Tables(spark, d)))


@query("reproject_3857", OF.with_(OF.TRACK) + f"""
SELECT point_id, round(lon * {math.pi / 180.0!r} * 6378137.0, 3) AS x,
       round(ln(tan({math.pi / 4.0!r} + lat * {math.pi / 360.0!r})) * 6378137.0, 3) AS y FROM track_pts""")
def q_reproject(spark, d):
    p = FX.track_points(Tables(spark, d))
    x, y = G.lonlat_to_mercator("lon", "lat")
    return p.select("point_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


CLIP = (5000.0, 5000.0, 15000.0, 15000.0)


@query("clip_box", OF.with_(OF.POI) + f"""
SELECT osm_id, x, y FROM poi WHERE x >= {CLIP[0]} AND x <= {CLIP[2]} AND y >= {CLIP[1]} AND y <= {CLIP[3]}""")
def q_clip_box(spark, d):
    """G18 for points (exact filter); polygons use ``clip_polygon_to_box``."""
    p = FX.poi_points(Tables(spark, d))
    return p.where(G.point_in_box("x", "y", *CLIP)).select("osm_id", "x", "y")
