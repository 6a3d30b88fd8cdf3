"""Served layers of the world map and the plain table layers: places, urban areas, admin bands, large buildings, admin lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators import attributes as A
from gridloom.operators.ladder import Rung, ladder_rings
from gridloom.operators.serve import tile_rows
from gridloom.operators.tiles import features_at_zooms, zoom_rungs
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import NAME_SQL, lines, query
from gridloom.plans.q_borders import BORDER_RUNGS
from gridloom.plans.q_generalize import dp_sql
from gridloom.plans.q_tiles import BUF, cover_sql
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

# Zoom bands of the admin layer (zoom from, zoom below, rung) and the area of a large building
ADMIN_BANDS = [(0, 6, 4), (6, 8, 6), (8, 10, 8), (10, 12, 10), (12, 14, 12), (14, 99, 14)]
LARGE_BUILDING = 10000
# The layers' own gates, up to the highest zoom that is seeded
WORLD_ZOOMS, LARGE_ZOOMS, ADMIN_ZOOMS = (0, 16), (13, 15), (6, 16)

_RING_AREA = """ring_area AS (
  SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
  FROM (SELECT osm_id, ring, seq, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM poly_verts
        WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq)) WHERE nx IS NOT NULL GROUP BY osm_id, ring),
parea AS (SELECT osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM ring_area GROUP BY osm_id),
pbox AS (SELECT osm_id, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM poly_verts GROUP BY osm_id)"""


def _zs(zooms: tuple[int, int]) -> str:
    return f"(SELECT unnest(range({zooms[0]}, {zooms[1] + 1})) AS z) zs"


def _box(geom="geom"):
    return [v.alias(k) for k, v in G.bbox(geom).items()]


def _gated(features, min_zoom, zooms):
    """A row for each zoom from the feature's own smallest on."""
    z = features.withColumn("z", F.explode(F.sequence(F.lit(zooms[0]), F.lit(zooms[1]))))
    return z.where(min_zoom <= F.col("z"))


@query("world_places", OF.with_(OF.LABEL, f"""
feats AS (SELECT 'places' AS layer, osm_id AS fid, z, x AS minx, y AS miny, x AS maxx, y AS maxy, {NAME_SQL} AS name, subclass,
                 osm_id % 11 AS scalerank FROM label_pts, {_zs(WORLD_ZOOMS)} WHERE osm_id % 8 <= z)""", cover_sql("feats", BUF)) + """
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid, name, subclass, scalerank FROM hits""")
def q_places(spark, d, zooms=WORLD_ZOOMS):
    """world.places: names by min_zoom; O3: scalerank is the draw order in the tile (a column, so no tile is sorted alone)."""
    p = FX.label_points(Tables(spark, d))
    p = p.select(F.col("osm_id").alias("gid"), A.name_fallback().alias("name"), "subclass", (F.col("osm_id") % 11).alias("scalerank"),
                 F.col("x").alias("minx"), F.col("y").alias("miny"), F.col("x").alias("maxx"), F.col("y").alias("maxy"))
    return tile_rows(_gated(p, F.col("gid") % 8, zooms), None, BUF).select("z", "x", "y", "gid", "name", "subclass", "scalerank")


@query("world_urban_areas", OF.with_(OF.POLY, _RING_AREA, f"""
feats AS (SELECT 'urban' AS layer, osm_id AS fid, z, minx, miny, maxx, maxy FROM pbox, {_zs(WORLD_ZOOMS)} WHERE osm_id % 9 <= z)""", cover_sql("feats", BUF)) + """
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid FROM hits""")
def q_urban_areas(spark, d, zooms=WORLD_ZOOMS):
    """world.urban_areas: areas by min_zoom."""
    p = FX.polygons(Tables(spark, d)).select(F.col("osm_id").alias("gid"), *_box())
    return tile_rows(_gated(p, F.col("gid") % 9, zooms), None, BUF).select("z", "x", "y", "gid")


@query("buildings_large", OF.with_(OF.POLY, _RING_AREA, f"""
feats AS (SELECT 'large' AS layer, osm_id AS fid, z, minx, miny, maxx, maxy FROM pbox JOIN parea USING (osm_id), {_zs(LARGE_ZOOMS)}
          WHERE area > {LARGE_BUILDING})""", cover_sql("feats", BUF)) + """
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid FROM hits""")
def q_buildings_large(spark, d, zooms=LARGE_ZOOMS):
    """osm.buildings-large: buildings of more than 10,000 square metres."""
    p = FX.polygons(Tables(spark, d)).where(G.area("geom") > LARGE_BUILDING).select(F.col("osm_id").alias("gid"), *_box())
    p = features_at_zooms(p, [(z, 0) for z in range(zooms[0], zooms[1] + 1)], None)
    return tile_rows(p, None, BUF).select("z", "x", "y", "gid")


@query("osm_admin", OF.with_(OF.WAY_NODES, f"""
feats AS (SELECT 'admin' AS layer, fid, z, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM line_verts, {_zs(ADMIN_ZOOMS)} GROUP BY fid, z)""",
    cover_sql("feats", BUF)) + """
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid, 'A' || (fid % 17) AS ref, CAST(fid % 10 + 1 AS INTEGER) AS level FROM hits""")
def q_osm_admin(spark, d, zooms=ADMIN_ZOOMS):
    """S15 osm.admin: a layer that is a table as it stands (id, geometry, ref, level)."""
    ln = lines(Tables(spark, d)).select(F.col("fid").alias("gid"), F.concat(F.lit("A"), (F.col("fid") % 17).cast("string")).alias("ref"),
                                        (F.col("fid") % 10 + 1).cast("int").alias("level"), *_box())
    ln = features_at_zooms(ln, [(z, 0) for z in range(zooms[0], zooms[1] + 1)], None)
    return tile_rows(ln, None, BUF).select("z", "x", "y", "gid", "ref", "level")


@query("world_admin_bands", "WITH RECURSIVE " + OF.WAY_NODES.strip() + """,
dp_in AS (SELECT fid AS gid, seq, x, y FROM line_verts),""" + dp_sql("dp_in") + """,
base AS (SELECT DISTINCT fid, CAST(fid % 10 + 1 AS INTEGER) AS admin_level, (fid % 5 = 0) AS maritime FROM line_verts),
rungs AS (""" + "\n  UNION ALL ".join(
    f"SELECT {g} AS gen, CAST({tol} AS DOUBLE) AS tol, fid, admin_level, maritime FROM base WHERE {c}" for g, tol, c in BORDER_RUNGS) + f"""),
zg AS (SELECT unnest({[z for z, _ in zoom_rungs(*WORLD_ZOOMS, ADMIN_BANDS)]}) AS z, unnest({[g for _, g in zoom_rungs(*WORLD_ZOOMS, ADMIN_BANDS)]}) AS gen),
feats AS (SELECT 'admin' AS layer, r.fid, zg.z, min(v.x) AS minx, min(v.y) AS miny, max(v.x) AS maxx, max(v.y) AS maxy,
                 any_value(r.admin_level) AS admin_level, any_value(r.maritime) AS maritime
          FROM rungs r JOIN zg ON zg.gen = r.gen JOIN line_verts v ON v.fid = r.fid JOIN dp_sig s ON s.gid = v.fid AND s.seq = v.seq
          WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect GROUP BY r.fid, zg.z),""" + cover_sql("feats", BUF) + """
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid, admin_level, maritime FROM hits""")
def q_admin_bands(spark, d, zooms=WORLD_ZOOMS):
    """world.admin: each zoom serves its rung of the border ladder."""
    ln = lines(Tables(spark, d)).withColumns({"admin_level": (F.col("fid") % 10 + 1).cast("int"), "maritime": F.col("fid") % 5 == 0})
    lr = ladder_rings(ln, [Rung(g, tol, F.expr(c)) for g, tol, c in BORDER_RUNGS])
    rb = lr.select("gen", F.col("fid").alias("gid"), *_box(G.line_geom(F.col("verts"))))
    rb = features_at_zooms(rb, zoom_rungs(*zooms, ADMIN_BANDS)).withColumns(
        {"admin_level": (F.col("gid") % 10 + 1).cast("int"), "maritime": F.col("gid") % 5 == 0})
    return tile_rows(rb, None, BUF).select("z", "x", "y", "gid", "admin_level", "maritime")
