"""Queries for tag routing M1-M8 (elements -> typed feature tables)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.functions.rules import ENUMS, FEATURE_TABLES, MINIMAL_TABLES, WAYZORDER_HIGHWAY_RANK, \
    WAYZORDER_RAILWAY
from gridloom.operators.mapping import feature_table, match_rules
from gridloom.plans.catalog import query
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.oracle_fixtures import _lst, pick
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables

ROADS = FEATURE_TABLES["roads_temp"][1][0][2]

ELEM = f"""
WITH elem AS (
 SELECT event_id AS id,
   {pick(['point', 'linestring', 'polygon'], 'event_id')} AS geom_type,
   CASE WHEN event_id % 26 < 22 THEN {pick(FX.ROAD_VALUES, 'event_id % 26')}
        WHEN event_id % 26 = 22 THEN 'bus_stop' END AS t_highway,
   CASE WHEN event_id % 10 = 0 THEN 'designated' WHEN event_id % 10 = 1 THEN 'yes' END AS t_bicycle,
   CASE WHEN event_id % 4 <> 0 THEN 'N' || CAST(event_id % 50 AS VARCHAR) END AS t_name,
   CASE WHEN event_id % 8 = 1 THEN 'ND' || CAST(event_id % 30 AS VARCHAR) END AS t_name_de,
   CASE WHEN event_id % 6 = 0 THEN CAST(event_id % 7 AS VARCHAR)
        WHEN event_id % 6 = 1 THEN 'S' || CAST(event_id % 3 AS VARCHAR) END AS t_mtb,
   CASE WHEN event_id % 9 = 0 THEN 'yes' WHEN event_id % 9 = 1 THEN 'no' END AS t_bridge,
   CASE WHEN event_id % 11 = 0 THEN 'true' END AS t_tunnel,
   CASE WHEN event_id % 7 = 0 THEN '1' WHEN event_id % 7 = 1 THEN '-1' END AS t_oneway,
   CASE WHEN event_id % 17 = 0 THEN 'x' WHEN event_id % 3 = 0 THEN CAST(event_id % 5 - 2 AS VARCHAR) END AS t_layer,
   CASE WHEN event_id % 5 = 0 THEN 'grade' || CAST(event_id % 7 AS VARCHAR) END AS t_tracktype,
   CASE WHEN event_id % 13 = 0 THEN 'driveway' WHEN event_id % 13 = 1 THEN 'alley' END AS t_service,
   CASE WHEN event_id % 14 = 0 THEN 'military' WHEN event_id % 14 = 1 THEN 'residential'
        WHEN event_id % 14 = 2 THEN 'forest' END AS t_landuse,
   CASE WHEN event_id % 21 = 0 THEN 'danger_area' END AS t_military,
   CASE WHEN event_id % 19 = 0 THEN 'nature_reserve' WHEN event_id % 19 = 1 THEN 'park' END AS t_leisure,
   CASE WHEN event_id % 16 = 0 THEN 'yes' WHEN event_id % 16 = 1 THEN 'house' END AS t_building,
   CASE WHEN event_id % 18 = 0 THEN 'main' END AS t_entrance,
   CASE WHEN event_id % 12 = 0 THEN 'pub' WHEN event_id % 12 = 1 THEN 'bench' END AS t_amenity,
   CASE WHEN event_id % 29 < 5 THEN {pick(['rail', 'tram', 'subway', 'funicular', 'light_rail'], 'event_id % 29')}
        END AS t_railway,
   CASE WHEN event_id % 31 = 0 THEN 'summer_toboggan' WHEN event_id % 31 = 1 THEN '' END AS t_attraction,
   CASE WHEN event_id % 37 = 0 THEN 'main' WHEN event_id % 37 = 1 THEN 'tourism' END AS t_usage
 FROM events)"""


def _enum(name: str, col: str) -> str:
    return f"CAST(coalesce(list_position({_lst(ENUMS[name])}, {col}), 0) AS INTEGER)"


def _bool(col: str) -> str:
    return f"coalesce(lower({col}) IN ('yes', 'true', '1'), FALSE)"


REGISTRY_SQL_ROADS = ELEM + f"""
SELECT id AS osm_id,
  CASE WHEN list_contains({_lst(ROADS)}, t_highway) THEN 'highway' ELSE 'bicycle' END AS class,
  CASE WHEN list_contains({_lst(ROADS)}, t_highway) THEN t_highway ELSE 'designated' END AS subclass,
  coalesce(t_name_de, '') AS name_de, '' AS name_en, coalesce(t_name, '') AS name, '' AS ref,
  {_bool('t_oneway')} AS oneway, {_enum('tracktype', 't_tracktype')} AS tracktype,
  {_enum('service', 't_service')} AS service, {_enum('bicycle', 't_bicycle')} AS bicycle,
  TRY_CAST(t_mtb AS INTEGER) AS scale, {_bool('t_tunnel')} AS tunnel, {_bool('t_bridge')} AS bridge,
  TRY_CAST(t_layer AS INTEGER) AS layer, {_enum('rank', 't_highway')} AS rank
FROM elem
WHERE geom_type = 'linestring' AND (list_contains({_lst(ROADS)}, t_highway) OR t_bicycle = 'designated')
  AND NOT coalesce(regexp_matches(t_mtb, '^\\D+.*$'), FALSE)"""


@query("map_features_roads", REGISTRY_SQL_ROADS)
def q_map_roads(spark, d):
    el = FX.elements(Tables(spark, d))
    m = match_rules(el)
    return feature_table(m, "roads_temp").drop("submap")


@query("map_features_roads_shared_ids", REGISTRY_SQL_ROADS.replace("SELECT id AS osm_id", "SELECT id // 3 AS osm_id"))
def q_map_roads_shared_ids(spark, d):
    """M1/M4 on ids that a node, a way and an area share."""
    el = FX.elements(Tables(spark, d)).withColumn("id", F.floor(F.col("id") / 3))
    return feature_table(match_rules(el), "roads_temp").drop("submap")


_COVER = ("CASE WHEN t_landuse IN ('forest', 'recreation_ground', 'grass', 'cemetery') THEN {0} "
          "WHEN t_leisure IN ('park', 'playground', 'pitch', 'golf_course') THEN {1} END")


@query("map_features_landcover", ELEM + f"""
SELECT id AS osm_id, 'landuse' AS submap, {_COVER.format("'landuse'", "'leisure'")} AS class,
       {_COVER.format("t_landuse", "t_leisure")} AS subclass, CAST(NULL AS DOUBLE) AS area, '' AS surface,
       coalesce(t_name_de, '') AS name_de, '' AS name_en, coalesce(t_name, '') AS name
FROM elem WHERE geom_type = 'polygon' AND {_COVER.format("TRUE", "TRUE")}""")
def q_map_landcover(spark, d):
    """M3/M7: landcover areas with their typed columns."""
    return feature_table(match_rules(FX.elements(Tables(spark, d))), "landcover_import")


@query("map_features_buildings", ELEM + """
SELECT id AS osm_id, 'building' AS class, t_building AS subclass, '' AS number,
       coalesce(t_name_de, '') AS name_de, '' AS name_en, coalesce(t_name, '') AS name
FROM elem WHERE geom_type = 'polygon' AND t_building IS NOT NULL""")
def q_map_buildings(spark, d):
    """M2/M7: any building, with number and names."""
    return feature_table(match_rules(FX.elements(Tables(spark, d))), "buildings_temp").drop("submap")


@query("map_features_any", ELEM + """
SELECT id AS osm_id, 'housenumbers_temp' AS "table", 'entrance' AS class, t_entrance AS subclass
FROM elem WHERE geom_type = 'point' AND t_entrance IS NOT NULL
UNION ALL
SELECT id, 'buildings_temp', 'building', t_building FROM elem WHERE geom_type = 'polygon' AND t_building IS NOT NULL""")
def q_map_any(spark, d):
    el = FX.elements(Tables(spark, d))
    m = match_rules(el)
    return m.where(F.col("table").isin("housenumbers_temp", "buildings_temp")).select(
        F.col("id").alias("osm_id"), "table", "class", "subclass")


@query("map_features_submap", ELEM + """
SELECT id AS osm_id, submap, class, subclass FROM (
  SELECT id, 'landuse' AS submap, 'landuse' AS class, t_landuse AS subclass FROM elem
  WHERE geom_type = 'polygon' AND t_landuse IN ('residential', 'commercial', 'retail', 'industrial')
  UNION ALL
  SELECT id, 'military', CASE WHEN t_landuse = 'military' THEN 'landuse' ELSE 'military' END,
         CASE WHEN t_landuse = 'military' THEN 'military' ELSE t_military END FROM elem
  WHERE geom_type = 'polygon' AND (t_landuse = 'military' OR t_military = 'danger_area')
  UNION ALL
  SELECT id, 'leisure', 'leisure', t_leisure FROM elem WHERE geom_type = 'polygon' AND t_leisure = 'nature_reserve')""")
def q_map_submap(spark, d):
    el = FX.elements(Tables(spark, d))
    m = match_rules(el)
    return feature_table(m, "landuse_import", columns=[]).select("osm_id", "submap", "class", "subclass")


@query("map_features_minimal", ELEM + """
SELECT id AS osm_id, 'roads' AS "table", 'highway' AS class, t_highway AS subclass FROM elem
WHERE geom_type = 'linestring' AND t_highway IS NOT NULL
UNION ALL SELECT id, 'buildings', 'building', t_building FROM elem WHERE geom_type = 'polygon' AND t_building IS NOT NULL
UNION ALL SELECT id, 'amenities', 'amenity', t_amenity FROM elem WHERE geom_type = 'point' AND t_amenity IS NOT NULL""")
def q_map_minimal(spark, d):
    """The minimal variant mapping (roads, buildings, admin, amenities)
    through the same routing operator."""
    el = FX.elements(Tables(spark, d))
    m = match_rules(el, MINIMAL_TABLES)
    return m.select(F.col("id").alias("osm_id"), "table", "class", "subclass")


_RAIL = FEATURE_TABLES["railway"][1][0][2]
_ZR = "CASE t_highway " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WAYZORDER_HIGHWAY_RANK.items()) + " ELSE 0 END"


@query("railway_layer", ELEM + f"""
SELECT id AS gid, 'railway' AS class, t_railway AS subclass,
  CAST({_ZR} + CASE WHEN t_railway IS NOT NULL THEN {WAYZORDER_RAILWAY} ELSE 0 END
       + coalesce(TRY_CAST(t_layer AS INTEGER), 0) * 10
       + CASE WHEN lower(t_tunnel) IN ('yes', 'true', '1') THEN -10 ELSE 0 END
       + CASE WHEN lower(t_bridge) IN ('yes', 'true', '1') THEN 10 ELSE 0 END AS INTEGER) AS zorder,
  {_bool('t_bridge')} AS bridge, {_bool('t_tunnel')} AS tunnel, coalesce(t_service, '') AS service,
  {_enum('usage', 't_usage')} AS usage
FROM elem
WHERE geom_type = 'linestring' AND list_contains({_lst(_RAIL)}, t_railway)
  AND t_railway NOT IN ('subway', 'tram') AND (coalesce(t_attraction, '') <> '') IS NOT TRUE""")
def q_railway_layer(spark, d):
    """M9 wayzorder + the osm.railway layer filter."""
    from gridloom.operators.attributes import is_not_true
    el = FX.elements(Tables(spark, d))
    m = match_rules(el)
    rw = feature_table(m, "railway")
    rw = rw.where(~F.col("subclass").isin("subway", "tram") & is_not_true(F.col("attraction") != ""))
    return rw.select(F.col("osm_id").alias("gid"), "class", "subclass", "zorder", "bridge", "tunnel", "service",
                     "usage")


@query("osm_xml_scan", REGISTRY_SQL_ROADS)
def q_osm_xml_scan(spark, d):
    """Elements written as OSM XML, scanned back with Spark's XML source,
    then routed into roads_temp (same answer as map_features_roads)."""
    from gridloom.plans.q_io import _scratch
    from gridloom.sources.osm import elements_to_xml_rows, read_osm_elements, write_osm_xml
    path = _scratch(spark, "osm")
    write_osm_xml(elements_to_xml_rows(FX.elements(Tables(spark, d))), path)
    el = read_osm_elements(spark, path)
    m = match_rules(el)
    return feature_table(m, "roads_temp").drop("submap")


@query("osm_plain_xml", "WITH " + OF.WAY_NODES.strip() + """
SELECT fid, CASE WHEN fid % 5 = 0 AND count(*) >= 3 THEN 'Polygon' ELSE 'LineString' END AS type,
       CAST(count(*) + CASE WHEN fid % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS nv,
       round(sum(x) + CASE WHEN fid % 5 = 0 THEN arg_min(x, seq) ELSE 0 END, 3) AS sum_x,
       round(sum(seq * y) + CASE WHEN fid % 5 = 0 THEN count(*) * arg_min(y, seq) ELSE 0 END, 3) AS weighed_y
FROM line_verts GROUP BY fid""")
def q_osm_plain_xml(spark, d):
    """Nodes and ways written as plain OSM XML (nd references), read back, references joined, ways
    assembled; every fifth way is closed by its first node."""
    from gridloom.plans.q_io import _scratch
    from gridloom.sources.osm import read_osm, way_geometries, write_osm_xml
    w = Window.partitionBy("fid").orderBy("k1", "k2", "k3")
    n = FX.way_nodes(Tables(spark, d)).withColumn("seq", F.row_number().over(w) - 1)
    none = F.lit(None).cast("array<struct<_k:string,_v:string>>").alias("tag")
    node_id = F.col("fid") * 100 + F.col("seq")
    path = _scratch(spark, "osm-plain")
    write_osm_xml(n.select(node_id.alias("_id"), F.col("y").alias("_lat"), F.col("x").alias("_lon"), none), f"{path}/nodes", "node")
    refs = F.transform(F.sort_array(F.collect_list("seq")), lambda s: F.struct((F.col("fid") * 100 + s).alias("_ref")))
    ways = n.groupBy("fid").agg(refs.alias("nd")).select(
        F.col("fid").alias("_id"), F.when(F.col("fid") % 5 == 0, F.concat("nd", F.slice("nd", 1, 1))).otherwise(F.col("nd")).alias("nd"), none)
    write_osm_xml(ways.where(F.size("nd") > 1), f"{path}/ways", "way")
    nodes, way_rows, _ = read_osm(spark, f"{path}/*")
    out = way_geometries(nodes, way_rows)
    vs = F.flatten(F.flatten("geom.parts"))
    return out.where((F.col("fid") % 5 != 0) | (F.col("nv") > 2)).select(
        "fid", F.col("geom.type").alias("type"), F.col("nv").cast("int").alias("nv"),
        F.round(F.aggregate(vs, F.lit(0.0), lambda a, v: a + v["x"]), 3).alias("sum_x"),
        F.round(F.aggregate(F.transform(vs, lambda v, i: i * v["y"]), F.lit(0.0), lambda a, v: a + v), 3).alias("weighed_y"))
