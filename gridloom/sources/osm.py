"""S1 OSM element scan from OSM XML (Spark's XML source, one file per partition).

``<node id=".." lat=".." lon=".."><tag k=".." v=".."/>...</node>`` rows are read
with an explicit schema (a lone <tag> would otherwise infer as a struct) and
turned into (id, geom_type, tags MAP) rows for the mapping operator. Ways and
relations use the same tag layout with rowTag ``way`` / ``relation``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAG = T.StructType([T.StructField("_k", T.StringType()), T.StructField("_v", T.StringType())])
ELEMENT_SCHEMA = T.StructType([
    T.StructField("_id", T.LongType()), T.StructField("_geom_type", T.StringType()),
    T.StructField("_lat", T.DoubleType()), T.StructField("_lon", T.DoubleType()),
    T.StructField("tag", T.ArrayType(TAG)),
])


def elements_to_xml_rows(elements: DataFrame) -> DataFrame:
    """(id, geom_type, tags) -> rows shaped like OSM XML elements."""
    tags = F.transform(F.array_sort(F.map_entries("tags")),
                       lambda e: F.struct(e["key"].alias("_k"), e["value"].alias("_v")))
    return elements.select(F.col("id").alias("_id"), F.col("geom_type").alias("_geom_type"),
                           F.lit(None).cast("double").alias("_lat"), F.lit(None).cast("double").alias("_lon"),
                           tags.alias("tag"))


def write_osm_xml(rows: DataFrame, path: str, row_tag: str = "node") -> None:
    rows.write.mode("overwrite").format("xml").option("rootTag", "osm").option("rowTag", row_tag).save(path)


def read_osm_elements(spark: SparkSession, path: str, row_tag: str = "node") -> DataFrame:
    """OSM XML -> (id, geom_type, tags MAP<STRING,STRING>)."""
    x = spark.read.format("xml").option("rowTag", row_tag).schema(ELEMENT_SCHEMA).load(path)
    tags = F.map_from_entries(F.transform(F.coalesce("tag", F.array().cast(T.ArrayType(TAG))),
                                          lambda t: F.struct(t["_k"], t["_v"])))
    return x.select(F.col("_id").alias("id"), F.col("_geom_type").alias("geom_type"), tags.alias("tags"))


# ---------------------------------------------------------------- plain OSM XML files

_TAGS = "tag array<struct<_k:string,_v:string>>"
NODE_SCHEMA = f"_id bigint, _lat double, _lon double, {_TAGS}"
WAY_SCHEMA = f"_id bigint, nd array<struct<_ref:bigint>>, {_TAGS}"
RELATION_SCHEMA = f"_id bigint, member array<struct<_type:string,_ref:bigint,_role:string>>, {_TAGS}"


def _tag_map():
    pairs = F.filter(F.coalesce("tag", F.array().cast("array<struct<_k:string,_v:string>>")), lambda t: t["_k"].isNotNull())
    return F.map_from_entries(F.transform(pairs, lambda t: F.struct(t["_k"], t["_v"])))


def read_osm(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Plain OSM XML -> nodes (id, lon, lat, tags), ways (id, refs, tags), relations (id, members, tags)."""
    def rows(tag, schema):
        return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)

    nodes = rows("node", NODE_SCHEMA).select(F.col("_id").alias("id"), F.col("_lon").alias("lon"), F.col("_lat").alias("lat"), _tag_map().alias("tags"))
    ways = rows("way", WAY_SCHEMA).select(F.col("_id").alias("id"), F.coalesce(F.col("nd._ref"), F.array().cast("array<bigint>")).alias("refs"), _tag_map().alias("tags"))
    members = F.transform(F.coalesce("member", F.array().cast("array<struct<_type:string,_ref:bigint,_role:string>>")), lambda m: F.struct(
        m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role")))
    relations = rows("relation", RELATION_SCHEMA).select(F.col("_id").alias("id"), members.alias("members"), _tag_map().alias("tags"))
    return nodes, ways, relations


def way_geometries(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """(fid, geom, nv) of each way, its refs joined with the nodes; a closed way of four refs or more is an area.

    Refs to nodes that are not in the extract are left out.
    """
    from gridloom.operators.assemble import assemble_lines
    refs = ways.select(F.col("id").alias("fid"), F.posexplode("refs").alias("seq", "_ref"))
    placed = refs.join(nodes.select(F.col("id").alias("_ref"), F.col("lon").alias("x"), F.col("lat").alias("y")), "_ref")
    return assemble_lines(placed, "fid", ("seq",), closed_as_polygon=True)


def tagged_elements(nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> DataFrame:
    """(id, geom_type, tags) for the mapping: tagged nodes, ways, and the way members of relations.

    A closed way is a line as well as an area; the tag area=yes or area=no leaves one of them.
    A member row has the member's id and the relation's tags.
    """
    points = nodes.where(F.size(F.map_keys("tags")) > 0).select("id", F.lit("point").alias("geom_type"), "tags")
    closed = (F.size("refs") >= 4) & (F.element_at("refs", 1) == F.element_at("refs", -1))
    area = F.col("tags")["area"]
    kinds = F.filter(F.array(
        F.when(~closed | ~F.coalesce(area == "yes", F.lit(False)), F.lit("linestring")),
        F.when(closed & ~F.coalesce(area == "no", F.lit(False)), F.lit("polygon"))), lambda k: k.isNotNull())
    lines = ways.where(F.size("refs") >= 2).select("id", F.explode(kinds).alias("geom_type"), "tags")
    members = relations.select("tags", F.explode("members").alias("_m")).where(F.col("_m.type") == "way").select(
        F.col("_m.ref").alias("id"), F.lit("relation_member").alias("geom_type"), "tags")
    return points.unionByName(lines).unionByName(members)
