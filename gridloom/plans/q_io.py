"""Queries for GPX (S8, S13, S14), GeoJSON (S12) and the streaming re-seed.

Files go under the session's checkpoint folder (the shared folder the cluster
names), never under a machine-local temp folder.
"""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import functions as F

from gridloom.functions.tiles import LOCAL_TILE_BUFFER, TILE_EXTENT
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import query
from gridloom.operators.serve import read_store, write_seed
from gridloom.operators.tiles import tile_join
from gridloom.plans.q_tiles import cover_sql
from gridloom.plans.seed import seed_tiles
from gridloom.session import ensure_checkpoint_dir
from gridloom.sources import fixtures as FX
from gridloom.sources.gpx import points_to_geojson, points_to_gpx_rows, read_geojson_points, read_gpx_points, \
    read_gpx_routes, read_gpx_waypoints, tracks_to_gpx_rows, write_geojson_lines, write_gpx, write_gpx_rows
from gridloom.sources.tables import Tables
from gridloom.streaming.reseed import start_reseed


def lonlat_edges(min_lon: float, min_lat: float, max_lon: float, max_lat: float) -> tuple[float, ...]:
    """The box in mercator metres, as constants for SQL."""
    r = math.pi / 180.0
    y = [math.log(math.tan(math.pi / 4.0 + lat * r / 2.0)) * 6378137.0 for lat in (min_lat, max_lat)]
    return (min_lon * r * 6378137.0, y[0], max_lon * r * 6378137.0, y[1])


def _scratch(spark, tag: str) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/io-{tag}-{uuid.uuid4().hex}"


@query("gpx_roundtrip", OF.with_(OF.TRACK) + """
SELECT track_id, 'Track ' || CAST(track_id AS VARCHAR) AS name, count(*) AS n_points,
       round(sum(lat), 6) AS sum_lat, round(sum(lon), 6) AS sum_lon, count(hr) AS n_hr,
       round(sum(ele), 4) AS sum_ele
FROM track_pts GROUP BY track_id HAVING count(*) >= 2""")
def q_gpx_roundtrip(spark, d):
    """Tracks -> GPX files (S13, titles by S14) -> GPX scan (S8) -> per track."""
    path = _scratch(spark, "gpx")
    write_gpx(tracks_to_gpx_rows(FX.track_points(Tables(spark, d))), path)
    pts = read_gpx_points(spark, path)
    return pts.groupBy("track_id", "name").agg(
        F.count("*").alias("n_points"), F.round(F.sum("lat"), 6).alias("sum_lat"),
        F.round(F.sum("lon"), 6).alias("sum_lon"), F.count("hr").alias("n_hr"),
        F.round(F.sum("ele"), 4).alias("sum_ele"))


@query("gpx_waypoints", OF.with_(OF.POI) + """
SELECT osm_id, x AS lon, y AS lat, CASE WHEN name <> '' THEN name ELSE CAST(osm_id AS VARCHAR) END AS name,
       'id=' || osm_id || CASE WHEN name IS NULL THEN '' ELSE chr(10) || 'name=' || name END AS "desc", 'https://example.org/' || osm_id AS href
FROM poi""")
def q_gpx_waypoints(spark, d):
    """POIs as GPX waypoints with title, description and link, read back."""
    path = _scratch(spark, "wpt")
    p = FX.poi_points(Tables(spark, d))
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (("id", F.col("osm_id").cast("string")), ("name", F.col("name")))])
    props = F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))
    rows = points_to_gpx_rows(p, "x", "y", props, F.concat(F.lit("https://example.org/"), F.col("osm_id").cast("string")))
    write_gpx_rows(rows, path, "wpt")
    w = read_gpx_waypoints(spark, path)
    href = F.col("links")[0]["href"]
    return w.select(F.regexp_extract(href, r"(\d+)$", 1).cast("bigint").alias("osm_id"), "lon", "lat", F.col("properties")["name"].alias("name"),
                    F.col("properties")["desc"].alias("desc"), href.alias("href"))


@query("gpx_routes", OF.with_(OF.TRACK) + """
SELECT track_id AS number, 'Route ' || track_id AS name, CAST(count(*) AS INTEGER) AS n_points, round(sum(lon), 6) AS sum_lon,
       CAST(sum(seq) AS BIGINT) AS sum_seq, round(sum(seq * lat), 6) AS weighed_lat
FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY time, point_id) - 1 AS seq FROM track_pts) GROUP BY track_id""")
def q_gpx_routes(spark, d):
    """Tracks written as GPX routes and scanned back, points in order."""
    path = _scratch(spark, "rte")
    pt = F.struct("time", "point_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), "ele")
    g = FX.track_points(Tables(spark, d)).groupBy("track_id").agg(F.sort_array(F.collect_list(pt)).alias("_p"))
    rte = F.transform("_p", lambda s: F.struct(s["_lat"].alias("_lat"), s["_lon"].alias("_lon"), s["ele"].alias("ele")))
    rows = g.select(F.concat(F.lit("Route "), F.col("track_id").cast("string")).alias("name"), F.col("track_id").cast("bigint").alias("number"), rte.alias("rtept"))
    write_gpx_rows(rows, path, "rte")
    r = read_gpx_routes(spark, path)
    return r.groupBy("number", "name").agg(
        F.count("*").cast("int").alias("n_points"), F.round(F.sum("lon"), 6).alias("sum_lon"), F.sum("seq").cast("bigint").alias("sum_seq"),
        F.round(F.sum(F.col("seq") * F.col("lat")), 6).alias("weighed_lat"))


@query("geojson_roundtrip", OF.with_(OF.POI) + """
SELECT osm_id, x, y, name FROM poi""")
def q_geojson_roundtrip(spark, d):
    """POIs -> GeoJSON feature lines (S12 sink) -> GeoJSON scan."""
    path = _scratch(spark, "geojson")
    write_geojson_lines(points_to_geojson(FX.poi_points(Tables(spark, d)), props=["osm_id", "name"]), path)
    f = read_geojson_points(spark, path)
    return f.select(F.col("properties")["osm_id"].cast("long").alias("osm_id"), "x", "y",
                    F.col("properties")["name"].alias("name"))


@query("geojson_shapes", "WITH " + OF.WAY_NODES.strip() + ",\n" + OF.POLY.strip() + """
SELECT 'LineString' AS type, fid AS id, CAST(1 AS INTEGER) AS n_rings, CAST(count(*) AS INTEGER) AS nv, round(sum(x), 3) AS sum_x,
       round(sum(y), 3) AS sum_y FROM line_verts GROUP BY fid
UNION ALL
SELECT 'Polygon', osm_id, CAST(count(DISTINCT ring) AS INTEGER), CAST(count(*) AS INTEGER), round(sum(x), 3), round(sum(y), 3)
FROM poly_verts GROUP BY osm_id""")
def q_geojson_shapes(spark, d):
    """Way lines written as features, areas as feature collections; both read back with their vertices."""
    from gridloom.functions import geometry as G
    from gridloom.plans.catalog import lines
    from gridloom.sources.geojson import collection_text, feature_text, read_geojson
    t = Tables(spark, d)
    path = _scratch(spark, "shapes")
    ways = lines(t).select(feature_text(F.col("geom"), {"id": F.col("fid")}).alias("value"))
    areas = FX.polygons(t).select(feature_text(F.col("geom"), {"id": F.col("osm_id")}).alias("value"))
    write_geojson_lines(ways, f"{path}/ways")
    write_geojson_lines(collection_text(areas), f"{path}/areas")
    f = read_geojson(spark, [f"{path}/ways", f"{path}/areas"])
    vs = G.all_vertices("geom")
    total = lambda k: F.round(F.aggregate(vs, F.lit(0.0), lambda a, v: a + v[k]), 3)
    rings = F.aggregate("geom.parts", F.lit(0), lambda a, p: a + F.size(p))
    return f.select(F.col("geom.type").alias("type"), F.col("properties")["id"].cast("long").alias("id"), rings.alias("n_rings"),
                    F.size(vs).alias("nv"), total("x").alias("sum_x"), total("y").alias("sum_y"))


_RESEED_ZOOMS = list(range(9, 15))
_BUF = LOCAL_TILE_BUFFER / TILE_EXTENT


def _at_zooms(rows: str, zooms=_RESEED_ZOOMS) -> str:
    return (f"SELECT 'label' AS layer, osm_id AS fid, z, x AS minx, y AS miny, x AS maxx, y AS maxy "
            f"FROM {rows}, (SELECT unnest([{', '.join(map(str, zooms))}]) AS z) zs")


def _hits(rows: str, tag: str, zooms=_RESEED_ZOOMS) -> str:
    """CTEs feats_<tag>, hits_<tag>: label rows joined with their tiles."""
    cte = cover_sql(f"feats_{tag}", _BUF)
    return f"feats_{tag} AS ({_at_zooms(rows, zooms)}),\n" + re.sub(r"\b(cov|rng2?|txy?|hits)\b", rf"\1_{tag}", cte)


def _label_boxes(t):
    return FX.label_points(t).select(
        F.lit("label").alias("layer"), F.col("osm_id").alias("fid"), F.col("x").alias("minx"),
        F.col("y").alias("miny"), F.col("x").alias("maxx"), F.col("y").alias("maxy"))


@query("stream_reseed", OF.with_(OF.LABEL, _hits("label_pts", "all"),
       _hits("(SELECT * FROM label_pts WHERE osm_id % 20 < 2) c", "changed")) + """
SELECT CAST(z AS INTEGER) AS z, x, y, layer, count(*) AS n FROM hits_all h
WHERE EXISTS (SELECT 1 FROM hits_changed c WHERE c.z = h.z AND c.x = h.x AND c.y = h.y)
GROUP BY z, x, y, layer""")
def q_stream_reseed(spark, d):
    """A tenth of the label features land as changed, in two sets of files; a streaming
    query re-seeds the tiles they touch at zooms 9-14 in micro-batches of as many files as the larger set has, each
    tile from all features that meet it."""
    base = _scratch(spark, "reseed")
    src, sink, ck = base + "/changed", base + "/tiles", base + "/_checkpoint"
    boxes = _label_boxes(Tables(spark, d))
    files = [0]
    for part in range(2):
        boxes.where(F.col("fid") % 20 == part).write.mode("append").parquet(src)
        files.append(len(spark.read.schema(boxes.schema).parquet(src).inputFiles()))
    per_batch = max(1, *(b - a for a, b in zip(files, files[1:], strict=False)))
    q = start_reseed(spark, src, boxes.schema, lambda: boxes, sink, ck, _RESEED_ZOOMS, _BUF, files_per_batch=per_batch)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return read_store(spark, sink, "x bigint, y bigint, layer string, n bigint").select("z", "x", "y", "layer", "n")


_PART_ZOOMS = [9, 10, 11]
_PART_BOX = (-20.0, -30.0, 60.0, 40.0)
_PART_EDGES = lonlat_edges(*_PART_BOX)


@query("tile_reseed_partial", OF.with_(OF.LABEL, _hits("label_pts", "old", _PART_ZOOMS),
       _hits("(SELECT * FROM label_pts WHERE osm_id % 3 <> 0) n", "new", _PART_ZOOMS),
       _hits("(SELECT * FROM label_pts WHERE osm_id % 50 = 0) l", "list", [10])) + f""",
tiles AS (SELECT DISTINCT z, x, y FROM hits_old),
edges AS (SELECT z, x, y, -20037508.342789244 + x * s AS x0, 20037508.342789244 - y * s AS y1, s
          FROM (SELECT *, 40075016.68557849 / pow(2.0, z) AS s FROM tiles)),
newest AS (SELECT z, x, y, CASE
  WHEN x0 <= {_PART_EDGES[2]!r} AND x0 + s >= {_PART_EDGES[0]!r} AND y1 - s <= {_PART_EDGES[3]!r} AND y1 >= {_PART_EDGES[1]!r} THEN 2
  WHEN EXISTS (SELECT 1 FROM hits_list l WHERE l.z = edges.z AND l.x = edges.x AND l.y = edges.y) THEN 1
  ELSE 0 END AS seed FROM edges)
SELECT CAST(h.z AS INTEGER) AS z, h.x, h.y, h.fid AS gid, n.seed AS ver
FROM newest n JOIN (SELECT *, 0 AS old FROM hits_new UNION ALL SELECT *, 1 FROM hits_old) h
  ON h.z = n.z AND h.x = n.x AND h.y = n.y AND h.old = CASE WHEN n.seed = 0 THEN 1 ELSE 0 END""")
def q_tile_reseed_partial(spark, d):
    """All tiles seeded, then a list of tiles and then a lon/lat box seeded
    again from changed features (a third gone); all other tiles keep their rows."""
    path = _scratch(spark, "partial")
    old = _label_boxes(Tables(spark, d))
    new = old.where(F.col("fid") % 3 != 0)
    at = F.explode(F.array(*[F.lit(z) for z in _PART_ZOOMS]))
    listed = tile_join(old.where(F.col("fid") % 50 == 0).withColumn("z", F.lit(10)), None, _BUF).select("z", "x", "y")
    boxed = seed_tiles(spark, _PART_ZOOMS[0], _PART_ZOOMS[-1], _PART_BOX)
    for seed, feats, tiles in ((0, old, None), (1, new, listed), (2, new, boxed)):
        rows = tile_join(feats.withColumn("z", at), tiles, _BUF).select(
            "z", "x", "y", "layer", F.col("fid").alias("gid"), F.lit(seed).alias("ver"))
        write_seed(rows, path, [F.col("gid")], seed, tiles, _PART_ZOOMS)
    return read_store(spark, path, "x bigint, y bigint, layer string, gid bigint, ver int").select(
        "z", "x", "y", "gid", "ver")


@query("layer_dir_load", OF.with_(OF.TRACK) + f"""
SELECT 'track_' || CAST(track_id % 3 AS VARCHAR) AS layer, point_id,
       round(lon * {3.141592653589793 / 180.0!r} * 6378137.0, 3) AS x,
       round(ln(tan({3.141592653589793 / 4.0!r} + lat * {3.141592653589793 / 360.0!r})) * 6378137.0, 3) AS y
FROM track_pts WHERE lat BETWEEN -85.06 AND 85.06""")
def q_layer_dir_load(spark, d):
    """Track points written as GeoJSON into one folder per layer
    (plus an empty one), loaded back by folder, clipped and reprojected."""
    from gridloom.sources.gpx import points_to_geojson, write_geojson_lines
    from gridloom.sources.layers_dir import load_geojson_layers
    root = _scratch(spark, "layers")
    pts = FX.track_points(Tables(spark, d))
    for i in range(3):
        part = pts.where(F.col("track_id") % 3 == i)
        write_geojson_lines(points_to_geojson(part, "lon", "lat", ["point_id"]), f"{root}/track_{i}")
    spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{root}/empty_layer")
    out = load_geojson_layers(spark, root)
    return out.select("layer", F.col("properties")["point_id"].cast("long").alias("point_id"),
                      F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))
