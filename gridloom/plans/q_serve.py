"""Served layers into the tile cache: roads + label."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators import attributes as A
from gridloom.operators.ladder import Rung, ladder_rings
from gridloom.operators.serve import read_store, read_tile, tile_rows, write_seed
from gridloom.operators.tiles import features_at_zooms, zoom_rungs
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import NAME_SQL, cluster_ctes, query
from gridloom.plans.q_generalize import ROAD_RUNGS, dp_sql, roads_base
from gridloom.plans.q_io import _scratch
from gridloom.plans.q_points import POS_SQL
from gridloom.operators.labels import first_labels
from gridloom.plans.q_tiles import BUF, LABEL_ONE, ROAD_BANDS, cover_sql
from gridloom.sources import fixtures as FX
from gridloom.session import cut_lineage
from gridloom.sources.tables import Tables

SERVE_ZOOMS = (7, 16)
ROAD_GATE = 8  # Fixed value: labels are served from 7 on, roads from here


TILE_COLUMNS = ["z", "x", "y", "layer", "gid", "ord", "layer_num", "ref_prefix", "ref_num", "name"]
TILE_SCHEMA = ("x bigint, y bigint, layer string, gid bigint, ord bigint, layer_num int, ref_prefix string, "
               "ref_num string, name string")


def served_features(spark, d, zooms: tuple[int, int] = SERVE_ZOOMS):
    """osm.roads (rung per zoom; name only from zoom 16, the base table) and
    osm.label features with their served attributes."""
    t = Tables(spark, d)
    base = roads_base(t)
    rungs = [Rung(g, tol, F.expr(c)) for g, tol, c in ROAD_RUNGS] + [Rung(0, -1.0)]
    lr = ladder_rings(base, rungs)  # one line per way
    rb = lr.select("gen", "fid", *[v.alias(k) for k, v in G.bbox(G.line_geom(F.col("verts"))).items()])
    attrs = base.select("fid", "rank", "ref", "layer", "name_de", "name_en", "name")
    rb = rb.join(attrs, "fid")
    roads = features_at_zooms(rb, zoom_rungs(max(zooms[0], ROAD_GATE), zooms[1], ROAD_BANDS))
    roads = roads.select(
        "z", F.lit("roads").alias("layer"), F.col("fid").alias("gid"), "minx", "miny", "maxx", "maxy",
        (-F.col("rank")).cast("long").alias("ord"),
        A.null_default("layer").cast("int").alias("layer_num"),
        A.ref_prefix().alias("ref_prefix"), A.ref_number().alias("ref_num"),
        F.when(F.col("gen") == 0, A.name_fallback()).otherwise(F.lit(None).cast("string")).alias("name"))
    lab = first_labels(FX.label_points(t).select("osm_id", "x", "y", "pop", A.name_fallback().alias("name")))
    lab = lab.select(F.lit("label").alias("layer"), F.col("osm_id").alias("gid"), F.col("x").alias("minx"),
                     F.col("y").alias("miny"), F.col("x").alias("maxx"), F.col("y").alias("maxy"),
                     (-F.coalesce(F.col("pop"), F.lit(-1))).cast("long").alias("ord"),
                     F.lit(None).cast("int").alias("layer_num"), F.lit(None).cast("string").alias("ref_prefix"),
                     F.lit(None).cast("string").alias("ref_num"), "name")
    lab = features_at_zooms(lab, [(z, 0) for z in range(zooms[0], zooms[1] + 1)], None)
    return roads.unionByName(lab)


_SERVE_SQL = "WITH RECURSIVE " + ",\n".join([OF.LABEL.strip(), OF.WAY_NODES.strip(), OF.WAY_ATTRS.strip(), LABEL_ONE]) + """,
dp_in AS (SELECT fid AS gid, seq, x, y FROM line_verts),""" + dp_sql("dp_in") + """,
base AS (SELECT a.*, l.length FROM way_attrs_r a JOIN (
  SELECT fid, sum(CASE WHEN nx IS NULL THEN 0 ELSE sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y)) END) AS length
  FROM (SELECT fid, x, y, lead(x) OVER (PARTITION BY fid ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY fid ORDER BY seq) AS ny FROM line_verts) GROUP BY fid) l USING (fid)),
rungs AS (""" + "\n  UNION ALL ".join(
    [f"SELECT {g} AS gen, CAST({tol} AS DOUBLE) AS tol, fid FROM base WHERE {cond}" for g, tol, cond in ROAD_RUNGS]
    + ["SELECT 0, CAST(-1.0 AS DOUBLE), fid FROM base"]) + """),
kept AS (SELECT r.gen, r.fid, v.x, v.y FROM rungs r JOIN line_verts v ON v.fid = r.fid
         JOIN dp_sig s ON s.gid = v.fid AND s.seq = v.seq WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect),
zg AS (SELECT unnest(""" + str([z for z, _ in zoom_rungs(ROAD_GATE, SERVE_ZOOMS[1], ROAD_BANDS)]) + """) AS z,
              unnest(""" + str([g for _, g in zoom_rungs(ROAD_GATE, SERVE_ZOOMS[1], ROAD_BANDS)]) + """) AS gen),
feats AS (
  SELECT 'roads' AS layer, k.fid, zg.z, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy,
         any_value(zg.gen) AS gen
  FROM kept k JOIN zg ON zg.gen = k.gen GROUP BY k.fid, zg.z
  UNION ALL
  SELECT 'label', osm_id, z, x, y, x, y, NULL FROM label_one, (SELECT unnest(range(7, 17)) AS z) zs),""" + \
    cover_sql("feats", BUF) + f""",
rows_ AS (
  SELECT h.z, h.x, h.y, h.layer, h.fid AS gid, -b.rank AS ord,
         CAST(CASE WHEN b.layer IS NULL THEN 0 ELSE b.layer END AS INTEGER) AS layer_num,
         nullif(regexp_extract(b.ref, '\\w+'), '') AS ref_prefix, nullif(regexp_extract(b.ref, '\\d+'), '') AS ref_num,
         CASE WHEN h.gen = 0 THEN CASE WHEN (b.name_de <> '') IS NOT FALSE THEN b.name_de
              WHEN (b.name_en <> '') IS NOT FALSE THEN b.name_en ELSE b.name END END AS name
  FROM hits h JOIN base b ON h.layer = 'roads' AND b.fid = h.fid
  UNION ALL
  SELECT h.z, h.x, h.y, h.layer, h.fid, -coalesce(l.pop, -1), NULL, NULL, NULL, {NAME_SQL.replace('name_de', 'l.name_de').replace('name_en', 'l.name_en').replace('ELSE name', 'ELSE l.name')}
  FROM hits h JOIN label_pts l ON h.layer = 'label' AND l.osm_id = h.fid)"""


@query("tile_materialize", _SERVE_SQL + """
SELECT CAST(z AS INTEGER) AS z, x, y, layer, gid, CAST(ord AS BIGINT) AS ord, layer_num, ref_prefix, ref_num, name
FROM rows_""")
def q_tile_materialize(spark, d):
    """T6 + S20: roads (from zoom 8) and labels (from 7) up to zoom 16 written to the tile
    store (Parquet by map, seed and zoom, range-sorted) and read back."""
    path = _scratch(spark, "tiles")
    rows = tile_rows(served_features(spark, d), None, BUF).select(*TILE_COLUMNS)
    write_seed(rows, path, [F.col("ord"), F.col("gid")], zooms=list(range(SERVE_ZOOMS[0], SERVE_ZOOMS[1] + 1)))
    return read_store(spark, path, TILE_SCHEMA).select(*TILE_COLUMNS)


@query("tile_one", _SERVE_SQL + """,
pick AS (SELECT 14 AS z, CAST(floor((x + 20037508.342789244) / (40075016.68557849 / pow(2.0, 14))) AS BIGINT) AS x,
                CAST(floor((20037508.342789244 - y) / (40075016.68557849 / pow(2.0, 14))) AS BIGINT) AS y
         FROM label_pts WHERE osm_id = (SELECT min(osm_id) FROM label_pts))
SELECT CAST(r.z AS INTEGER) AS z, r.x, r.y, layer, gid, CAST(ord AS BIGINT) AS ord, layer_num, ref_prefix, ref_num,
       name
FROM rows_ r JOIN pick p ON r.z = p.z AND r.x = p.x AND r.y = p.y""")
def q_tile_one(spark, d):
    """One tile (zoom 14, under the label with the smallest id) made and
    served alone: only the features that meet it are joined, and the store is read for it."""
    lab = FX.label_points(Tables(spark, d))
    first = lab.orderBy("osm_id").limit(1)
    size = F.lit(40075016.68557849) / F.pow(F.lit(2.0), F.lit(14))
    tile = cut_lineage(first.select(F.lit(14).alias("z"),
                                    F.floor((F.col("x") + F.lit(20037508.342789244)) / size).alias("x"),
                                    F.floor((F.lit(20037508.342789244) - F.col("y")) / size).alias("y")))
    path = _scratch(spark, "tiles")
    rows = tile_rows(served_features(spark, d, (14, 14)), tile, BUF).select(*TILE_COLUMNS)
    write_seed(rows, path, [F.col("ord"), F.col("gid")], tiles=tile)
    return read_tile(spark, path, TILE_SCHEMA, tile).select(*TILE_COLUMNS)


# cluster.poi: zoom z in 11..17 serves rung gen z, zoom 18 and above the raw points
POI_ZOOMS = list(range(11, 19))


def _poi_rungs():
    from gridloom.plans.catalog import _CLUSTER_RUNGS
    return {int(k[len("cluster_gen"):]): v for k, v in _CLUSTER_RUNGS.items() if k.startswith("cluster_gen")}


_POI_SQL = "WITH RECURSIVE " + OF.POI.strip() + "," + ",".join(
    cluster_ctes(eps, cond, f"_{g}") for g, (eps, cond) in sorted(_poi_rungs().items())) + ",\nfeats AS (" + \
    "\n  UNION ALL ".join(
        f"SELECT 'poi' AS layer, id AS fid, {g} AS z, x AS minx, y AS miny, x AS maxx, y AS maxy, count, subclass "
        f"FROM clus_{g}" for g in sorted(_poi_rungs())) + \
    "\n  UNION ALL SELECT 'poi', osm_id, 18, x, y, x, y, 1, subclass FROM poi)," + cover_sql("feats", BUF) + """
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid, count, subclass FROM hits"""


@query("tile_poi_clusters", _POI_SQL)
def q_tile_poi_clusters(spark, d):
    """cluster.poi layer: each zoom 11-17 serves its clustering rung (C1 +
    A1-A5), zoom 18 the raw points; features joined to their tiles (J1)."""
    from gridloom.operators.cluster import cluster_rungs
    p = FX.poi_points(Tables(spark, d))
    c = cluster_rungs(p, [(g, eps, cond) for g, (eps, cond) in sorted(_poi_rungs().items())])
    u = c.select(F.col("gen").alias("z"), F.col("id").alias("gid"), "count", "subclass", "x", "y")
    u = u.unionByName(p.select(F.lit(18).alias("z"), F.col("osm_id").alias("gid"), F.lit(1).cast("long").alias("count"),
                               "subclass", "x", "y"))
    u = u.select("*", F.col("x").alias("minx"), F.col("y").alias("miny"), F.col("x").alias("maxx"),
                 F.col("y").alias("maxy"))
    hits = tile_rows(u, None, BUF)
    return hits.select(F.col("z").cast("int").alias("z"), hits["x"], hits["y"], "gid", "count", "subclass")


# osm.landuse at zooms 13-16: 13 -> gen13 (DP 10, area > 2000), 14 -> gen14 (DP 5, area > 1000), >= 15 -> base
LANDUSE_SERVED = [(13, 13, 10.0, "area > 2000"), (14, 14, 5.0, "area > 1000"), (15, 0, 0.0, None),
                  (16, 0, 0.0, None)]


def _landuse_sql() -> str:
    from gridloom.plans.q_generalize import dp_sql
    rung_sql = "\n  UNION ALL ".join(
        f"SELECT {z} AS z, CAST({tol} AS DOUBLE) AS tol, osm_id FROM parea" + (f" WHERE {cond}" if cond else "")
        for z, _, tol, cond in LANDUSE_SERVED)
    return "WITH RECURSIVE " + OF.POLY.strip() + """,
dp_in AS (SELECT osm_id * 10 + ring AS gid, seq, x, y FROM poly_verts),""" + dp_sql("dp_in") + """,
ring_area AS (
  SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
  FROM (SELECT osm_id, ring, seq, x, y,
               lead(x) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY osm_id, ring ORDER BY seq) AS ny FROM poly_verts)
  WHERE nx IS NOT NULL GROUP BY osm_id, ring),
parea AS (SELECT osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM ring_area GROUP BY osm_id),
rz AS (""" + rung_sql + """),
kept AS (SELECT r.z, v.osm_id, v.x, v.y FROM rz r JOIN poly_verts v ON v.osm_id = r.osm_id
         JOIN dp_sig s ON s.gid = v.osm_id * 10 + v.ring AND s.seq = v.seq
         WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect OR r.tol = 0),
feats AS (SELECT 'landuse' AS layer, osm_id AS fid, z, min(x) AS minx, min(y) AS miny, max(x) AS maxx,
                 max(y) AS maxy FROM kept GROUP BY z, osm_id),""" + cover_sql("feats", BUF) + """
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid FROM hits"""


@query("tile_landuse_bands", _landuse_sql())
def q_tile_landuse_bands(spark, d):
    """osm.landuse served at zooms 13-16: the rung of each zoom (P8, J2) from one
    in-row ladder (C2/C8), joined to tiles by its simplified bbox (J1)."""
    p = FX.polygons(Tables(spark, d)).select(F.col("osm_id").alias("fid"), "geom")
    p = p.withColumn("area", G.area("geom"))
    rungs = [Rung(z, tol if tol > 0 else -1.0, F.expr(c) if c else None) for z, _, tol, c in LANDUSE_SERVED]
    lr = ladder_rings(p, rungs)
    verts = lr.select(F.col("gen").alias("z"), "fid", F.explode("verts").alias("_v"))
    bb = verts.groupBy("z", "fid").agg(F.min("_v.x").alias("minx"), F.min("_v.y").alias("miny"),
                                       F.max("_v.x").alias("maxx"), F.max("_v.y").alias("maxy"))
    hits = tile_rows(bb, None, BUF)
    return hits.select(F.col("z").cast("int").alias("z"), "x", "y", F.col("fid").alias("gid"))


# osm.waterway: <10 -> gen8, 10-11 -> gen10, 12-13 -> gen12, >= 14 -> base (ladder filters on the base line)
# Rung, tolerance and filter; zoom bands
WATERWAY_RUNGS = [(12, 20.0, "length > 50"), (10, 50.0, "subclass IN ('river', 'canal', 'stream') AND length > 200"),
                  (8, 100.0, "subclass IN ('river', 'canal') AND length > 400"), (0, -1.0, None)]
WATERWAY_BANDS = [(0, 10, 8), (10, 12, 10), (12, 14, 12), (14, 99, 0)]
WATERWAY_ZOOMS = (7, 16)


def _waterway_sql() -> str:
    from gridloom.plans.q_generalize import dp_sql
    from gridloom.operators.tiles import zoom_rungs
    zg = zoom_rungs(WATERWAY_ZOOMS[0], WATERWAY_ZOOMS[1], WATERWAY_BANDS)
    rung_sql = "\n  UNION ALL ".join(
        f"SELECT {g} AS gen, CAST({tol} AS DOUBLE) AS tol, fid FROM base" + (f" WHERE {c}" if c else "")
        for g, tol, c in WATERWAY_RUNGS)
    zsql = " UNION ALL ".join(f"SELECT {z} AS z, {g} AS gen" for z, g in zg)
    return "WITH RECURSIVE " + ",\n".join([OF.WAY_NODES.strip(), OF.WAY_ATTRS.strip()]) + """,
dp_in AS (SELECT fid AS gid, seq, x, y FROM line_verts),""" + dp_sql("dp_in") + """,
base AS (SELECT a.fid, a.water_subclass AS subclass, l.length FROM way_attrs_r a JOIN (
  SELECT fid, sum(CASE WHEN nx IS NULL THEN 0 ELSE sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y)) END) AS length
  FROM (SELECT fid, x, y, lead(x) OVER (PARTITION BY fid ORDER BY seq) AS nx,
               lead(y) OVER (PARTITION BY fid ORDER BY seq) AS ny FROM line_verts) GROUP BY fid) l USING (fid)),
rungs AS (""" + rung_sql + """),
zg AS (""" + zsql + """),
kept AS (SELECT r.gen, r.fid, v.x, v.y FROM rungs r JOIN line_verts v ON v.fid = r.fid
         JOIN dp_sig s ON s.gid = v.fid AND s.seq = v.seq WHERE s.sig IS NULL OR s.sig > r.tol),
feats AS (SELECT 'waterway' AS layer, k.fid, zg.z, min(x) AS minx, min(y) AS miny, max(x) AS maxx,
                 max(y) AS maxy, any_value(b.subclass) AS subclass
          FROM kept k JOIN zg ON zg.gen = k.gen JOIN base b ON b.fid = k.fid GROUP BY k.fid, zg.z),""" + \
        cover_sql("feats", BUF) + """
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid, subclass FROM hits"""


@query("tile_waterway_bands", _waterway_sql())
def q_tile_waterway_bands(spark, d):
    """osm.waterway at zooms 7-16: ladder rungs gen8/10/12 (subclass and
    length filters on the base line, P4/P7) and the base table, by zoom band."""
    from gridloom.operators.tiles import features_at_zooms, zoom_rungs
    from gridloom.plans.catalog import lines
    t = Tables(spark, d)
    ln = lines(t).withColumn("length", G.length("geom"))
    base = ln.join(FX.way_attrs(t).select("fid", F.col("water_subclass").alias("subclass")), "fid")
    rungs = [Rung(g, tol, F.expr(c) if c else None) for g, tol, c in WATERWAY_RUNGS]
    lr = ladder_rings(base, rungs)
    bb = lr.select("gen", "fid", *[v.alias(k) for k, v in G.bbox(G.line_geom(F.col("verts"))).items()])
    bb = bb.join(base.select("fid", "subclass"), "fid")
    feats = features_at_zooms(bb, zoom_rungs(WATERWAY_ZOOMS[0], WATERWAY_ZOOMS[1], WATERWAY_BANDS))
    hits = tile_rows(feats, None, BUF)
    return hits.select(F.col("z").cast("int").alias("z"), "x", "y", F.col("fid").alias("gid"), "subclass")


# osm.manmade at zooms 13-14: lines (gen13 rung = DP 10 of taxiways and runways below 14, base from 14),
# polygons with their perimeter, points with constant columns
def _manmade_sql() -> str:
    from gridloom.plans.q_generalize import dp_sql
    return "WITH RECURSIVE " + ",\n".join([OF.WAY_NODES.strip(), OF.WAY_ATTRS.strip(), OF.POLY.strip(),
                                           OF.POI.strip()]) + """,
dp_in AS (SELECT fid AS gid, seq, x, y FROM line_verts),""" + dp_sql("dp_in") + """,
mm AS (SELECT fid FROM way_attrs),
k13 AS (SELECT v.fid, v.seq, v.x, v.y FROM line_verts v JOIN dp_sig s ON s.gid = v.fid AND s.seq = v.seq
        JOIN way_attrs a ON a.fid = v.fid
        WHERE v.fid IN (SELECT fid FROM mm) AND a.fid % 4 < 2
          AND (s.sig IS NULL OR s.sig > 10 OR s.protect)),
kb AS (SELECT fid, seq, x, y FROM line_verts WHERE fid IN (SELECT fid FROM mm)),
len_ AS (SELECT src, fid, sum(CASE WHEN nx IS NULL THEN 0 ELSE sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y)) END) AS l,
                bool_and(CASE WHEN seq0 THEN x = lx AND y = ly ELSE TRUE END) AS closed
         FROM (SELECT src, fid, seq, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny,
                      seq = min(seq) OVER w2 AS seq0, last_value(x) OVER w2 AS lx, last_value(y) OVER w2 AS ly
               FROM (SELECT 13 AS src, * FROM k13 UNION ALL SELECT 14, * FROM kb)
               WINDOW w AS (PARTITION BY src, fid ORDER BY seq),
                      w2 AS (PARTITION BY src, fid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING
                             AND UNBOUNDED FOLLOWING))
         GROUP BY src, fid),
pp AS (SELECT osm_id, sum(sqrt((nx - x)*(nx - x) + (ny - y)*(ny - y))) AS per
       FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM poly_verts
             WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq)) WHERE nx IS NOT NULL
       GROUP BY osm_id)
SELECT src AS z, fid AS gid, 'line' AS kind, CAST(round_even(l, 0) AS INTEGER) AS length, closed AS polygon
FROM len_
UNION ALL SELECT z, osm_id, 'polygon', CAST(round_even(per, 0) AS INTEGER), TRUE
FROM pp, (SELECT unnest([13, 14]) AS z) zs
UNION ALL SELECT z, osm_id, 'point', 0, FALSE FROM poi, (SELECT unnest([13, 14]) AS z) zs"""


@query("manmade_layer", _manmade_sql())
def q_manmade_layer(spark, d):
    """osm.manmade at zooms 13 and 14: lines from the gen13 rung (DP 10 with a
    subclass filter) below 14 and the base from 14, each with
    ``length::integer`` and ``ST_IsClosed AS polygon``; polygons with
    ``ST_Perimeter::integer`` and TRUE; points with 0 and FALSE (union by name)."""
    from gridloom.operators.attributes import as_pg_int
    from gridloom.plans.catalog import lines
    t = Tables(spark, d)
    # stand-in: the man-made subclass of a way
    kind = F.element_at(F.array(*[F.lit(k) for k in ("taxiway", "runway", "pier", "breakwater")]), (F.col("fid") % 4 + 1).cast("int"))
    ln = lines(t).join(FX.way_attrs(t).select("fid"), "fid").withColumn("subclass", kind)
    lr = ladder_rings(ln, [Rung(13, 10.0, F.col("subclass").isin("taxiway", "runway")), Rung(14, -1.0)])
    g = G.line_geom(F.col("verts"))
    lines_out = lr.select(F.col("gen").alias("z"), F.col("fid").alias("gid"), F.lit("line").alias("kind"),
                          as_pg_int(G.length(g)).alias("length"), G.is_closed(g).alias("polygon"))
    polys = FX.polygons(t)
    zs = F.explode(F.array(F.lit(13), F.lit(14))).alias("z")
    poly_out = polys.select(zs, F.col("osm_id").alias("gid"), F.lit("polygon").alias("kind"),
                            as_pg_int(G.perimeter("geom")).alias("length"), F.lit(True).alias("polygon"))
    pts = FX.poi_points(t)
    pt_out = pts.select(zs, F.col("osm_id").alias("gid"), F.lit("point").alias("kind"),
                        F.lit(0).alias("length"), F.lit(False).alias("polygon"))
    return lines_out.unionByName(poly_out).unionByName(pt_out).select(
        F.col("z").cast("int").alias("z"), "gid", "kind", "length", "polygon")


@query("transportation_layer", "WITH " + ",\n".join([OF.WAY_NODES.strip(), OF.WAY_ATTRS.strip()]) + f""",
ends AS (SELECT fid, arg_min(x, seq) AS x0, arg_min(y, seq) AS y0, arg_max(x, seq) AS x1, arg_max(y, seq) AS y1
         FROM line_verts GROUP BY fid)
SELECT a.fid AS gid, a.class, a.subclass, {NAME_SQL.replace('name_de', 'a.name_de').replace('name_en', 'a.name_en').replace('ELSE name', 'ELSE a.name')} AS name
FROM way_attrs a JOIN ends e USING (fid) WHERE NOT (e.x0 = e.x1 AND e.y0 = e.y1)""")
def q_transportation_layer(spark, d):
    """osm.transportation: open lines only (``NOT ST_IsClosed``, P11), name by
    the three-valued fallback (P3)."""
    from gridloom.plans.catalog import lines
    t = Tables(spark, d)
    ln = lines(t).where(~G.is_closed("geom")).join(FX.way_attrs(t), "fid")
    return ln.select(F.col("fid").alias("gid"), "class", "subclass", A.name_fallback().alias("name"))


def housenumber_points(t: Tables):
    """Entrance points with a house number (from customers)."""
    k = F.col("c_custkey")
    num = F.when(k % 4 == 0, F.lit("")).when(k % 9 == 0, F.lit(None).cast("string")).otherwise(
        (k % 300 + 1).cast("string"))
    return FX.poi_points(t).select("osm_id", "x", "y", "name_de", "name_en", "name").join(
        t.customer.select(k.alias("osm_id"), num.alias("number")), "osm_id")


@query("housenumbers_layer", OF.with_(OF.POLY, OF.POI) + ",\n" + POS_SQL.strip() + f""",
hn AS (SELECT p.osm_id, p.x, p.y, p.name_de, p.name_en, p.name,
              CASE WHEN c.c_custkey % 4 = 0 THEN '' WHEN c.c_custkey % 9 = 0 THEN NULL
                   ELSE CAST(c.c_custkey % 300 + 1 AS VARCHAR) END AS number
       FROM poi p JOIN customer c ON c.c_custkey = p.osm_id),
bld AS (SELECT b.osm_id, round(px, 4) AS x, round(py, 4) AS y, b.name_de, b.name_en, b.name,
               CASE WHEN b.osm_id % 5 = 0 THEN '' ELSE CAST(b.osm_id % 120 + 1 AS VARCHAR) END AS number
        FROM poly_base b JOIN pos USING (osm_id))
SELECT 'building' AS src, osm_id AS gid, x, y, number, {NAME_SQL} AS name FROM bld
WHERE (number <> '') IS NOT FALSE
UNION ALL
SELECT 'entrance', osm_id, round(x, 4), round(y, 4), number, {NAME_SQL} FROM hn WHERE (number <> '') IS NOT FALSE""")
def q_housenumbers_layer(spark, d):
    """osm.housenumbers: buildings reduced to points (C5) UNION ALL entrance
    points, the same ``(number <> '') IS NOT FALSE`` filter on both sides."""
    from gridloom.operators.topoint import merge_to_point
    t = Tables(spark, d)
    k = F.col("osm_id")
    bld = FX.polygons(t).withColumn("number", F.when(k % 5 == 0, F.lit("")).otherwise(
        (k % 120 + 1).cast("string"))).withColumn("src", F.lit("building"))
    pts = housenumber_points(t).withColumn("src", F.lit("entrance"))
    cond = A.is_not_false(F.col("number") != "")
    out = merge_to_point(bld, pts, ["src", F.col("osm_id").alias("gid"), "number", A.name_fallback().alias("name")],
                         cond)
    return out.select("src", "gid", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), "number", "name")


# osm.waterarea: <9 gen8, 9..14 gen z, >= 15 base
# Zoom bands
WATERAREA_BANDS = [(0, 9, 8)] + [(z, z + 1, z) for z in range(9, 15)] + [(15, 99, 0)]
WATERAREA_ZOOMS = (7, 16)


def waterarea_sql(zooms: tuple[int, int]) -> str:
    from gridloom.plans.q_generalize import WATERAREA_BASE_RUNGS, WATERAREA_CASCADE
    zg = zoom_rungs(*zooms, WATERAREA_BANDS)
    rung_sql = "\n  UNION ALL ".join(
        [f"SELECT {g} AS gen, CAST({tol} AS DOUBLE) AS tol, osm_id FROM base WHERE {c}"
         for g, tol, c in WATERAREA_BASE_RUNGS + WATERAREA_CASCADE] + ["SELECT 0, -1.0, osm_id FROM base"])
    zsql = " UNION ALL ".join(f"SELECT {z} AS z, {g} AS gen" for z, g in zg)
    return "WITH RECURSIVE " + OF.POLY.strip() + """,
dp_in AS (SELECT osm_id * 10 + ring AS gid, seq, x, y FROM poly_verts),""" + dp_sql("dp_in") + """,
k13 AS (SELECT v.osm_id, v.ring, v.seq, v.x, v.y FROM poly_verts v
        JOIN dp_sig s ON s.gid = v.osm_id * 10 + v.ring AND s.seq = v.seq
        WHERE s.sig IS NULL OR s.sig > 10 OR s.protect),
ra13 AS (SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
         FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM k13
               WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq)) WHERE nx IS NOT NULL GROUP BY osm_id, ring),
a13 AS (SELECT osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area13 FROM ra13 GROUP BY osm_id),
ra AS (SELECT osm_id, ring, abs(sum(x * ny - nx * y)) / 2.0 AS a
       FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM poly_verts
             WINDOW w AS (PARTITION BY osm_id, ring ORDER BY seq)) WHERE nx IS NOT NULL GROUP BY osm_id, ring),
base AS (SELECT b.osm_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area, any_value(a13.area13) AS area13
         FROM ra b JOIN a13 USING (osm_id) GROUP BY b.osm_id),
rungs AS (""" + rung_sql + """),
zg AS (""" + zsql + """),
kept AS (SELECT r.gen, r.osm_id, v.x, v.y FROM rungs r JOIN poly_verts v ON v.osm_id = r.osm_id
         JOIN dp_sig s ON s.gid = v.osm_id * 10 + v.ring AND s.seq = v.seq
         WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect),
feats AS (SELECT 'waterarea' AS layer, k.osm_id AS fid, zg.z, min(x) AS minx, min(y) AS miny, max(x) AS maxx,
                 max(y) AS maxy FROM kept k JOIN zg ON zg.gen = k.gen GROUP BY k.osm_id, zg.z),""" + \
        cover_sql("feats", BUF) + """
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid FROM hits"""


@query("tile_waterarea_bands", waterarea_sql(WATERAREA_ZOOMS))
def q_tile_waterarea_bands(spark, d):
    """osm.waterarea at zooms 7-16: each zoom's rung of the cascaded ladder
    (gen8..14, base from 15), joined to tiles by the rung's bbox."""
    from gridloom.plans.q_generalize import waterarea_rungs
    lr = waterarea_rungs(spark, d)
    v = lr.select("gen", "fid", F.explode("verts").alias("_v"))
    bb = v.groupBy("gen", "fid").agg(F.min("_v.x").alias("minx"), F.min("_v.y").alias("miny"),
                                     F.max("_v.x").alias("maxx"), F.max("_v.y").alias("maxy"))
    feats = features_at_zooms(bb, zoom_rungs(WATERAREA_ZOOMS[0], WATERAREA_ZOOMS[1], WATERAREA_BANDS))
    hits = tile_rows(feats, None, BUF)
    return hits.select(F.col("z").cast("int").alias("z"), "x", "y", F.col("fid").alias("gid"))


@query("piste_layer", "WITH " + OF.WAY_NODES.strip() + """,
ends AS (SELECT fid, arg_min(x, seq) AS x0, arg_min(y, seq) AS y0, arg_max(x, seq) AS x1, arg_max(y, seq) AS y1
         FROM line_verts GROUP BY fid)
SELECT fid AS gid, CAST(coalesce(list_position(""" + "['novice', 'easy', 'intermediate', 'advanced', 'expert', " \
    "'freeride', 'extreme']" + """, ['novice', 'easy', 'intermediate', 'advanced', 'expert', 'freeride', 'extreme',
       'unknown'][(fid % 8) + 1]), 0) AS INTEGER) AS difficulty
FROM ends WHERE NOT (x0 = x1 AND y0 = y1)""")
def q_piste_layer(spark, d):
    """osm.piste: open lines only (P11) with ``difficulty`` as an enumeration
    (M8: 1-based position, 0 for a value outside the list)."""
    from gridloom.functions.rules import ENUMS
    from gridloom.plans.catalog import lines
    ln = lines(Tables(spark, d)).where(~G.is_closed("geom"))
    tag = F.element_at(F.array(*[F.lit(v) for v in ENUMS["difficulty"] + ["unknown"]]), (F.col("fid") % 8 + 1)
                       .cast("int"))
    diff = F.coalesce(F.array_position(F.array(*[F.lit(v) for v in ENUMS["difficulty"]]), tag).cast("int"),
                      F.lit(0))
    return ln.select(F.col("fid").alias("gid"), diff.alias("difficulty"))


# ---------------------------------------------------------------- tile-local geometry

_SEG_ZOOMS = zoom_rungs(ROAD_GATE, SERVE_ZOOMS[1], ROAD_BANDS)
_SEG_SQL = _SERVE_SQL.split("kept AS (")[0] + f"""kept AS (
  SELECT r.gen, r.fid, v.x, v.y, row_number() OVER (PARTITION BY r.gen, r.fid ORDER BY v.seq) - 1 AS seq FROM rungs r JOIN line_verts v ON v.fid = r.fid
  JOIN dp_sig s ON s.gid = v.fid AND s.seq = v.seq WHERE s.sig IS NULL OR s.sig > r.tol OR s.protect),
zg AS (SELECT unnest({[z for z, _ in _SEG_ZOOMS]}) AS z, unnest({[g for _, g in _SEG_ZOOMS]}) AS gen),
feats AS (SELECT 'roads' AS layer, k.fid, zg.z, zg.gen, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy
          FROM kept k JOIN zg ON zg.gen = k.gen GROUP BY k.fid, zg.z, zg.gen),""" + cover_sql("feats", BUF) + f""",
pairs AS (SELECT gen, fid, seq, x AS ax, y AS ay, lead(x) OVER w AS ex, lead(y) OVER w AS ey
          FROM kept WINDOW w AS (PARTITION BY gen, fid ORDER BY seq)),
boxed AS (SELECT h.z, h.x, h.y, p.*, -20037508.342789244 + h.x * h.s AS tx, 20037508.342789244 - h.y * h.s AS ty, h.s,
                 ex - ax AS dx, ey - ay AS dy FROM hits h JOIN pairs p ON p.fid = h.fid AND p.gen = h.gen WHERE p.ex IS NOT NULL),
edges AS (SELECT *, tx - s * {BUF!r} AS x0, tx + s + s * {BUF!r} AS x1, ty - s - s * {BUF!r} AS y0, ty + s * {BUF!r} AS y1
          FROM boxed),
cut AS (SELECT *,
  greatest(0.0, CASE WHEN dx > 0 THEN (x0 - ax) / dx WHEN dx < 0 THEN (x1 - ax) / dx WHEN ax < x0 OR ax > x1 THEN 2.0 ELSE 0.0 END,
                CASE WHEN dy > 0 THEN (y0 - ay) / dy WHEN dy < 0 THEN (y1 - ay) / dy WHEN ay < y0 OR ay > y1 THEN 2.0 ELSE 0.0 END) AS t0,
  least(1.0, CASE WHEN dx > 0 THEN (x1 - ax) / dx WHEN dx < 0 THEN (x0 - ax) / dx ELSE 1.0 END,
             CASE WHEN dy > 0 THEN (y1 - ay) / dy WHEN dy < 0 THEN (y0 - ay) / dy ELSE 1.0 END) AS t1 FROM edges)
SELECT CAST(z AS INTEGER) AS z, x, y, fid AS gid, CAST(0 AS INTEGER) AS part, CAST(seq AS INTEGER) AS seq,
       CAST(floor((ax + t0 * dx - tx) / s * 4096 + 0.5) AS INTEGER) AS x1,
       CAST(floor((ty - (ay + t0 * dy)) / s * 4096 + 0.5) AS INTEGER) AS y1,
       CAST(floor((ax + t1 * dx - tx) / s * 4096 + 0.5) AS INTEGER) AS x2,
       CAST(floor((ty - (ay + t1 * dy)) / s * 4096 + 0.5) AS INTEGER) AS y2
FROM cut WHERE t0 <= t1"""


def road_segments(base, rungs, zooms):
    """(z, x, y, fid, part, seq, x1, y1, x2, y2): every part of every line of ``base``, from the rung of each zoom.

    No line's box is longer than the line: most meet few blocks of tiles, and only long ones (and those whose length
    is null) are dealt out by block. They are told apart below the ladder, which is then built once for each line.
    """
    from gridloom.functions.tiles import BLOCK, explode_blocks, tile_segments, tile_size
    far = F.coalesce(F.col("length") > 6 * BLOCK * tile_size(F.lit(max(z for z, _ in zooms))), F.lit(True))

    def at_zooms(lines):
        return features_at_zooms(ladder_rings(lines, rungs).select("gen", "fid", "part", "verts"), zooms)

    near = at_zooms(base.where(~far)).withColumn("block", F.lit(None).cast("struct<bx: bigint, by: bigint>"))
    long = at_zooms(base.where(far)).withColumns(G.bbox(G.line_geom(F.col("verts"))))
    columns = ["z", "fid", "part", "verts", "block"]
    rows = tile_segments(near.select(*columns).unionByName(explode_blocks(long, F.col("z"), BUF).select(*columns)), BUF, block="block")
    return rows.select("z", "x", "y", "fid", "part", "seq", "x1", "y1", "x2", "y2")


@query("tile_road_geometry", _SEG_SQL)
def q_tile_road_geometry(spark, d):
    """The road lines of each tile at zooms 8-16, each zoom's rung, cut at the buffered tile
    and in the tile's own integer coordinates (segments keep their part and their place in it)."""
    rungs = [Rung(g, tol, F.expr(c)) for g, tol, c in ROAD_RUNGS] + [Rung(0, -1.0)]
    return road_segments(roads_base(Tables(spark, d)), rungs, _SEG_ZOOMS).withColumnRenamed("fid", "gid")
