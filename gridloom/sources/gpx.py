"""S8/S9/S13/S14 GPX tracks, routes and waypoints, on Spark's own XML source (one
file per partition, read back in parallel); points as GeoJSON lines (S12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# GPX read schema (explicit: a lone <trkseg> would otherwise infer as a struct)
TRKPT = T.StructType([
    T.StructField("_lat", T.DoubleType()), T.StructField("_lon", T.DoubleType()),
    T.StructField("ele", T.DoubleType()), T.StructField("time", T.StringType()),
    T.StructField("hr", T.DoubleType()),
])
TRK_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("desc", T.StringType()),
    T.StructField("cmt", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("number", T.LongType()),
    T.StructField("trkseg", T.ArrayType(T.StructType([T.StructField("trkpt", T.ArrayType(TRKPT))]))),
])
TIME_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def feature_title(props: Column, keys=("name", "ref", "id")) -> Column:
    """First non-empty of name, ref, id (from a MAP of properties/tags)."""
    return F.coalesce(*[F.nullif(props[k], F.lit("")) for k in keys], F.lit(""))


def feature_description(props: Column) -> Column:
    """``k=v`` lines of all properties, keys in sorted order."""
    entries = F.array_sort(F.map_entries(props))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "\n")


def tracks_to_gpx_rows(points: DataFrame, track: str = "track_id", order=("time", "point_id")) -> DataFrame:
    """Track points -> one <trk> row per track (S13): name/desc from the
    track's properties, one segment, points in order with ele, time, hr.
    A track is one output element, so its points meet in one row; the order
    comes from sorting the collected structs (no window)."""
    pt = F.struct(*[F.col(o).alias(f"_k{i}") for i, o in enumerate(order)], F.col("lat").alias("_lat"),
                  F.col("lon").alias("_lon"), F.col("ele"), F.date_format("time", TIME_FMT).alias("time"),
                  F.col("hr"))
    g = points.groupBy(track).agg(F.sort_array(F.collect_list(pt)).alias("_pts"))
    props = F.create_map(F.lit("id"), F.col(track).cast("string"), F.lit("name"),
                         F.concat(F.lit("Track "), F.col(track).cast("string")))
    pts = F.transform("_pts", lambda s: F.struct(s["_lat"], s["_lon"], s["ele"], s["time"], s["hr"]))
    return g.select(
        feature_title(props).alias("name"), feature_description(props).alias("desc"),
        F.col(track).cast("long").alias("number"),
        F.array(F.struct(pts.alias("trkpt"))).alias("trkseg"),
    )


def write_gpx(trk_rows: DataFrame, path: str) -> None:
    """S13 sink: GPX files (rootTag gpx, rowTag trk)."""
    (trk_rows.write.mode("overwrite").format("xml").option("rootTag", "gpx").option("rowTag", "trk")
     .save(path))


def read_gpx_points(spark: SparkSession, path: str) -> DataFrame:
    """S8 scan: <trk> -> track points (track, seg, seq, lon, lat, ele, time, hr).

    Segments with fewer than 2 points are dropped; missing heart rates stay NULL.
    """
    trk = spark.read.format("xml").option("rowTag", "trk").schema(TRK_SCHEMA).load(path)
    seg = trk.select("name", "number", F.posexplode("trkseg").alias("seg", "_s"))
    seg = seg.where(F.size("_s.trkpt") >= 2)
    pt = seg.select("name", "number", "seg", F.posexplode("_s.trkpt").alias("seq", "_p"))
    return pt.select(
        F.col("number").alias("track_id"), "name", "seg", "seq",
        F.col("_p._lon").alias("lon"), F.col("_p._lat").alias("lat"), F.col("_p.ele").alias("ele"),
        F.to_timestamp(F.col("_p.time"), TIME_FMT).alias("time"), F.col("_p.hr").alias("hr"),
    )


# ---------------------------------------------------------------- waypoints and routes

_LINKS = "link array<struct<_href:string,text:string>>"
_POINT = f"_lat double, _lon double, ele double, time string, name string, cmt string, desc string, sym string, type string, {_LINKS}"
_POINT_TYPE = ("struct<_lat:double,_lon:double,ele:double,time:string,name:string,cmt:string,desc:string,sym:string,type:string,"
               "link:array<struct<_href:string,text:string>>>")
_ROUTE = f"name string, cmt string, desc string, type string, number bigint, {_LINKS}, rtept array<{_POINT_TYPE}>"


def _properties(keys: tuple[str, ...]) -> Column:
    """These child elements as a MAP, those that are there."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in keys])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def _links(col: str = "link") -> Column:
    return F.transform(F.coalesce(col, F.array().cast("array<struct<_href:string,text:string>>")), lambda x: F.struct(
        x["_href"].alias("href"), x["text"].alias("text")))


def read_gpx_waypoints(spark: SparkSession, path: str) -> DataFrame:
    """S8/S9 scan: <wpt> -> (lon, lat, ele, time, properties, links)."""
    w = spark.read.format("xml").option("rowTag", "wpt").schema(_POINT).load(path)
    return w.select(F.col("_lon").alias("lon"), F.col("_lat").alias("lat"), "ele", F.try_to_timestamp("time").alias("time"),
                    _properties(("name", "cmt", "desc", "sym", "type", "time")).alias("properties"), _links().alias("links"))


def read_gpx_routes(spark: SparkSession, path: str) -> DataFrame:
    """S8/S9 scan: <rte> -> its points (number, name, properties, links, seq, lon, lat, ele)."""
    r = spark.read.format("xml").option("rowTag", "rte").schema(_ROUTE).load(path)
    props = _properties(("name", "cmt", "desc", "type"))
    p = r.select("number", "name", props.alias("properties"), _links().alias("links"), F.posexplode("rtept").alias("seq", "_p"))
    return p.select("number", "name", "properties", "links", "seq", F.col("_p._lon").alias("lon"), F.col("_p._lat").alias("lat"), F.col("_p.ele").alias("ele"))


def points_to_gpx_rows(points: DataFrame, lon: str, lat: str, props: Column, link: Column | None = None, ele: str | None = None) -> DataFrame:
    """One <wpt> row for each point, titled and described by its properties."""
    links = F.array().cast("array<struct<_href:string,text:string>>") if link is None else F.array(F.struct(link.alias("_href"), feature_title(props).alias("text")))
    return points.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), (F.col(ele) if ele else F.lit(None).cast("double")).alias("ele"),
                         feature_title(props).alias("name"), feature_description(props).alias("desc"), links.alias("link"))


def write_gpx_rows(rows: DataFrame, path: str, row_tag: str) -> None:
    """S13 sink: GPX files of <wpt>, <rte> or <trk> elements."""
    rows.write.mode("overwrite").format("xml").option("rootTag", "gpx").option("rowTag", row_tag).save(path)


def gpx_line_width_px(width_mm: Column) -> Column:
    """S9 line style width: millimetres -> pixels at 96 dpi."""
    return width_mm * 96.0 / 25.4


# ---------------------------------------------------------------- GeoJSON

def points_to_geojson(df: DataFrame, x: str = "x", y: str = "y", props: list[str] | None = None) -> DataFrame:
    """S12 sink side: one GeoJSON Feature (text) per row."""
    props = props or []
    pm = F.create_map(*[e for c in props for e in (F.lit(c), F.col(c).cast("string"))]) if props else \
        F.create_map().cast("map<string,string>")
    feat = F.struct(F.lit("Feature").alias("type"),
                    F.struct(F.lit("Point").alias("type"), F.array(F.col(x), F.col(y)).alias("coordinates"))
                    .alias("geometry"),
                    pm.alias("properties"))
    return df.select(F.to_json(feat).alias("value"))


def write_geojson_lines(text: DataFrame, path: str) -> None:
    text.write.mode("overwrite").text(path)


def read_geojson_points(spark: SparkSession, path: str) -> DataFrame:
    """S12 scan: the point features of GeoJSON lines or collections -> (x, y, properties)."""
    from gridloom.sources.geojson import read_geojson
    f = read_geojson(spark, path).where(F.col("geom.type") == "Point")
    at = F.element_at(F.element_at(F.element_at("geom.parts", 1), 1), 1)
    return f.select(at["x"].alias("x"), at["y"].alias("y"), "properties")
