"""Areas of served layers in their tiles' own coordinates: the rung of every zoom, cut down the pyramid."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.functions.geometry import WORLD_EDGE
from gridloom.operators.areaclip import tile_areas, to_tile_units, twice_area
from gridloom.operators.ladder import Rung, ladder_rings
from gridloom.operators.attributes import name_fallback
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans import q_serve as S
from gridloom.plans.catalog import NAME_SQL, query
from gridloom.plans.clip_sql import clip_rings_sql
from gridloom.plans.q_closing import _rings_sql, closed_rungs, closing_tasks, gen13
from gridloom.plans.q_generalize import dp_sql, waterarea_rungs
from gridloom.plans.q_tiles import BUF, cover_sql
from gridloom.session import cut_lineage
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

E = repr(WORLD_EDGE)
WATERAREA_SERVED = (7, 16)


def _geometry_sql(bands: str, rung: str, zooms: str) -> str:
    """The bands' SQL up to its tile hits, then every ring cut at every tile it meets.

    ``rung`` is the column of ``kept`` that names the rung, ``zooms`` a CTE body (z, rung). Vertices are told
    of areas without holes, whose pieces have the same ones however they are cut.
    """
    body, _, _ = bands.rpartition("SELECT CAST(z AS INTEGER) AS z")
    for own in "rv":
        body = body.replace(f"SELECT r.{rung}, {own}.osm_id, v.x, v.y FROM", f"SELECT r.{rung}, v.osm_id, v.ring, v.seq, v.x, v.y FROM")
    return body.rstrip() + f""",
served AS ({zooms}),
pieces AS (SELECT row_number() OVER () AS k, * FROM (SELECT DISTINCT z, x, y, fid, s FROM hits)),
cut_in AS (
  SELECT p.k, v.ring, v.seq, v.x, v.y, -{E} + p.x * p.s - p.s * {BUF!r} AS x0, -{E} + (p.x + 1) * p.s + p.s * {BUF!r} AS x1,
         {E} - (p.y + 1) * p.s - p.s * {BUF!r} AS y0, {E} - p.y * p.s + p.s * {BUF!r} AS y1
  FROM pieces p JOIN served g ON g.z = p.z JOIN kept v ON v.osm_id = p.fid AND v.{rung} = g.rung
  -- the closing vertex is the first one
  WHERE v.seq > 0),""" + clip_rings_sql("cut_in") + f""",
units AS (
  SELECT p.*, c.ring, c.seq AS place, CAST(floor((c.x + {E} - p.x * p.s) / p.s * 4096 + 0.5) AS BIGINT) AS ux, CAST(floor(({E} - p.y * p.s - c.y) / p.s * 4096 + 0.5) AS BIGINT) AS uy,
         CAST(floor((c.nx + {E} - p.x * p.s) / p.s * 4096 + 0.5) AS BIGINT) AS wx, CAST(floor(({E} - p.y * p.s - c.ny) / p.s * 4096 + 0.5) AS BIGINT) AS wy
  FROM clipped c JOIN pieces p USING (k)),
told AS (SELECT k, string_agg(ux || ' ' || uy, ',' ORDER BY ux, uy) AS vertices FROM (SELECT DISTINCT k, ux, uy FROM units) GROUP BY k)
SELECT CAST(u.z AS INTEGER) AS z, u.x, u.y, u.fid AS gid, CAST(sum(ux * wy - wx * uy) AS BIGINT) AS area2,
       CASE WHEN u.fid % 7 <> 0 THEN any_value(t.vertices) END AS vertices
FROM units u JOIN told t USING (k) GROUP BY u.z, u.x, u.y, u.fid HAVING sum(ux * wy - wx * uy) <> 0"""


def _polygons(rings):
    """(gen, fid, part, ring, verts) -> (gen, fid, parts)."""
    parts = rings.groupBy("gen", "fid", "part").agg(F.sort_array(F.collect_list(F.struct("ring", "verts"))).alias("rs"))
    geoms = parts.groupBy("gen", "fid").agg(F.sort_array(F.collect_list(F.struct("part", F.transform("rs", lambda r: r["verts"]).alias("p")))).alias("ps"))
    return geoms.select("gen", "fid", F.transform("ps", lambda p: p["p"]).alias("parts"))


def area_tiles(rings, zooms: list[tuple[int, int]]):
    """:func:`served_tiles` of the rungs of a ladder (gen, fid, part, ring, verts)."""
    return served_tiles(_polygons(rings), zooms)


def served_tiles(areas, zooms: list[tuple[int, int]]):
    """(z, x, y, fid, parts) in tile coordinates: rungs (gen, fid, parts) by the (zoom, gen) that they serve.

    Zooms that follow each other with one rung are one descent.
    """
    runs: list[list[int]] = []
    for z, gen in sorted(zooms):
        if runs and runs[-1][2] == gen and runs[-1][1] == z - 1:
            runs[-1][1] = z
        else:
            runs.append([z, z, gen])
    out = None
    for low, high, gen in runs:
        made = tile_areas(areas.where(F.col("gen") == gen).select("fid", "parts"), low, high, BUF)
        out = made if out is None else out.unionByName(made)
    return out.withColumn("parts", to_tile_units()).where(F.size("parts") > 0)


def _told(tiles):
    rings = F.flatten("parts")
    area2 = F.aggregate(F.transform(rings, twice_area), F.lit(0).cast("bigint"), lambda s, v: s + v)
    points = F.array_sort(F.array_distinct(F.flatten(rings)))
    text = F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p["x"], p["y"])), ",")
    return tiles.select("z", "x", "y", F.col("fid").alias("gid"), area2.alias("area2"), F.when(F.col("fid") % 7 != 0, text).alias("vertices")).where("area2 <> 0")


@query("tile_landuse_geometry", _geometry_sql(S._landuse_sql(), "z", " UNION ALL ".join(f"SELECT {z} AS z, {z} AS rung" for z, *_ in S.LANDUSE_SERVED)))
def q_tile_landuse_geometry(spark, d):
    """osm.landuse at zooms 13-16 with geometry: each zoom's rung, cut at the buffered tile, in the tile's integer coordinates."""
    p = FX.polygons(Tables(spark, d)).select(F.col("osm_id").alias("fid"), "geom").withColumn("area", G.area("geom"))
    # a rung of the ladder may serve several zooms: the full detail from 15 on is one descent
    gens = {gen: Rung(gen, tol if tol > 0 else -1.0, F.expr(c) if c else None) for _, gen, tol, c in S.LANDUSE_SERVED}
    return _told(area_tiles(ladder_rings(p, list(gens.values())), [(z, gen) for z, gen, *_ in S.LANDUSE_SERVED]))


@query("tile_water_geometry", _geometry_sql(S.waterarea_sql(WATERAREA_SERVED), "gen", " UNION ALL ".join(
    f"SELECT {z} AS z, {g} AS rung" for z, g in S.zoom_rungs(*WATERAREA_SERVED, S.WATERAREA_BANDS))))
def q_tile_water_geometry(spark, d):
    """osm.waterarea at zooms 7-16 with geometry, from the cascaded ladder."""
    return _told(area_tiles(waterarea_rungs(spark, d), S.zoom_rungs(*WATERAREA_SERVED, S.WATERAREA_BANDS)))


# ---------------------------------------------------------------- osm.landuse and osm.landcover, zooms 7 to 16

# Zoom bands (zoom from, zoom below, rung) and the closed rungs (tolerance, smallest gen13 area) of both layers
LAND_BANDS = [(0, 9, 8), (9, 10, 9), (10, 11, 10), (11, 12, 11), (12, 13, 12), (13, 14, 13), (14, 15, 14), (15, 99, 0)]
LAND_CLOSED = {12: (20.0, 5000.0), 11: (50.0, 50000.0), 10: (100.0, 200000.0), 9: (150.0, 2000000.0)}
LAND_LAYERS = {"landuse": {**LAND_CLOSED, 8: (200.0, 4000000.0)}, "landcover": {**LAND_CLOSED, 8: (200.0, 5000000.0)}}
LAND_DETAIL = [(13, 10.0, "area > 2000"), (14, 5.0, "area > 1000"), (0, -1.0, None)]
LAND_ZOOMS = (7, 16)
LAND_ROWS = {"landuse": 0, "landcover": 1}  # stand-in: polygons by the remainder of their id by 2


def _land_sql(layer: str) -> str:
    zooms, only = S.zoom_rungs(*LAND_ZOOMS, LAND_BANDS), f"osm_id % 2 = {LAND_ROWS[layer]}"
    detail = " UNION ALL ".join(f"SELECT {g} AS gen, CAST({tol} AS DOUBLE) AS tol, osm_id FROM own" + (f" WHERE {c}" if c else "") for g, tol, c in LAND_DETAIL)
    closed = ",\n".join(f"closed_{g} AS MATERIALIZED (\n{_rings_sql(tol, area, 1.0, only)}\nSELECT a.key AS osm_id, l.ring, l.seq, l.x, l.y FROM left_over l JOIN ring_areas a USING (ring))"
                        for g, (tol, area) in LAND_LAYERS[layer].items())
    return "WITH RECURSIVE " + OF.POLY.strip() + """,
dp_in AS (SELECT osm_id * 10 + ring AS gid, seq, x, y FROM poly_verts),""" + dp_sql("dp_in") + f""",
ring_area AS (
  SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
  FROM (SELECT osm_id, ring, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM poly_verts WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq))
  WHERE nx IS NOT NULL GROUP BY osm_id, ring),
own AS (SELECT b.osm_id, b.subclass, b.surface, {NAME_SQL} AS name, a.area FROM poly_base b
        JOIN (SELECT osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM ring_area GROUP BY osm_id) a USING (osm_id) WHERE {only}),
rungs AS ({detail}),
{closed},
kept AS (
  SELECT r.gen, v.osm_id, v.ring, v.seq, v.x, v.y FROM rungs r JOIN poly_verts v ON v.osm_id = r.osm_id
  JOIN dp_sig s ON s.gid = v.osm_id * 10 + v.ring AND s.seq = v.seq WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect
""" + "\n".join(f"  UNION ALL SELECT {g}, osm_id, ring, seq, x, y FROM closed_{g} WHERE osm_id IN (SELECT osm_id FROM own)" for g in LAND_LAYERS[layer]) + f"""),
served AS ({" UNION ALL ".join(f"SELECT {z} AS z, {g} AS gen" for z, g in zooms)}),
feats AS (SELECT '{layer}' AS layer, k.osm_id AS fid, g.z, g.gen, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy
          FROM kept k JOIN served g ON g.gen = k.gen GROUP BY k.osm_id, g.z, g.gen),""" + cover_sql("feats", BUF) + f""",
pieces AS (SELECT row_number() OVER () AS k, * FROM (SELECT DISTINCT z, gen, x, y, fid, s FROM hits)),
cut_in AS (
  SELECT p.k, v.ring, v.seq, v.x, v.y, -{E} + p.x * p.s - p.s * {BUF!r} AS x0, -{E} + (p.x + 1) * p.s + p.s * {BUF!r} AS x1,
         {E} - (p.y + 1) * p.s - p.s * {BUF!r} AS y0, {E} - p.y * p.s + p.s * {BUF!r} AS y1
  FROM pieces p JOIN kept v ON v.osm_id = p.fid AND v.gen = p.gen WHERE v.seq > 0),""" + clip_rings_sql("cut_in") + f""",
units AS (
  SELECT p.k, p.z, p.x, p.y, p.fid, CAST(floor((c.x + {E} - p.x * p.s) / p.s * 4096 + 0.5) AS BIGINT) AS ux, CAST(floor(({E} - p.y * p.s - c.y) / p.s * 4096 + 0.5) AS BIGINT) AS uy,
         CAST(floor((c.nx + {E} - p.x * p.s) / p.s * 4096 + 0.5) AS BIGINT) AS wx, CAST(floor(({E} - p.y * p.s - c.ny) / p.s * 4096 + 0.5) AS BIGINT) AS wy
  FROM clipped c JOIN pieces p USING (k))
SELECT CAST(u.z AS INTEGER) AS z, u.x, u.y, u.fid AS gid, any_value(o.subclass) AS subclass, {"any_value(o.surface) AS surface, " if layer == "landcover" else ""}any_value(o.name) AS name,
       any_value(o.area) AS area, CAST(sum(ux * wy - wx * uy) AS BIGINT) AS area2
FROM units u JOIN own o ON o.osm_id = u.fid GROUP BY u.z, u.x, u.y, u.fid HAVING sum(ux * wy - wx * uy) <> 0"""


def _land(layer: str):
    def run(spark, d):
        p = FX.polygons(Tables(spark, d)).where(F.col("osm_id") % 2 == LAND_ROWS[layer])
        own = p.select(F.col("osm_id").alias("fid"), "geom", G.area("geom").alias("area"))
        fine = _polygons(ladder_rings(own, [Rung(g, tol, F.expr(c) if c else None) for g, tol, c in LAND_DETAIL]))
        coarse = closed_rungs(gen13(own.select("fid", "geom")), LAND_LAYERS[layer], closing_tasks(Tables(spark, d)))
        areas = cut_lineage(fine.select("gen", "fid", "parts").unionByName(coarse))
        tiles = served_tiles(areas, S.zoom_rungs(*LAND_ZOOMS, LAND_BANDS))
        told = _told(tiles).drop("vertices")
        attrs = p.select(F.col("osm_id").alias("gid"), "subclass", *(["surface"] if layer == "landcover" else []), name_fallback().alias("name"), G.area("geom").alias("area"))
        return told.join(attrs, "gid")

    run.__doc__ = f"osm.{layer} at zooms 7-16 with geometry and attributes: closed outlines up to 12, then simplified areas, then full detail."
    return run


for _layer in LAND_LAYERS:
    query(f"tile_{_layer}_layer", _land_sql(_layer))(_land(_layer))
