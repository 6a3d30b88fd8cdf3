"""S12 GeoJSON: features of every geometry type, one a line or in feature collections.

Coordinates are nested to a depth that depends on the geometry type, so the scan
reads them as text and each type parses its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import geometry as G

_GEOMETRY = "struct<type:string,coordinates:string>"
_FEATURE = f"struct<type:string,geometry:{_GEOMETRY},properties:map<string,string>>"
SCHEMA = f"type string, geometry {_GEOMETRY}, properties map<string,string>, features array<{_FEATURE}>"
# nesting of the coordinates, positions not counted
DEPTH = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}


def _positions(text: Column, depth: int) -> Column:
    return F.from_json(text, "array<" * (depth + 1) + "double" + ">" * (depth + 1))


def _vertex(p: Column) -> Column:
    return G.vertex(p[0], p[1])


def parts(kind: Column, text: Column) -> Column:
    """parts -> rings -> vertices of a geometry, as the library's geometry column has them; NULL for other types."""
    ring = lambda r: F.transform(r, _vertex)
    shapes = {
        "Point": F.array(F.array(F.array(_vertex(_positions(text, 0))))),
        "MultiPoint": F.transform(_positions(text, 1), lambda p: F.array(F.array(_vertex(p)))),
        "LineString": F.array(F.array(ring(_positions(text, 1)))),
        "MultiLineString": F.transform(_positions(text, 2), lambda r: F.array(ring(r))),
        "Polygon": F.array(F.transform(_positions(text, 2), ring)),
        "MultiPolygon": F.transform(_positions(text, 3), lambda p: F.transform(p, ring)),
    }
    out = None
    for name, shape in shapes.items():
        out = F.when(kind == name, shape) if out is None else out.when(kind == name, shape)
    return out


def read_geojson(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """(file, geom, properties) of every feature below ``path``.

    Each line is a feature or a whole feature collection; with ``multi_line`` each file is
    one JSON text. Features without a geometry are left out.
    """
    rows = spark.read.schema(SCHEMA).option("multiLine", multi_line).json(path)
    one = F.array(F.struct("type", "geometry", "properties").cast(_FEATURE))
    rows = rows.select(F.input_file_name().alias("file"), F.explode(
        F.when(F.col("type") == "FeatureCollection", F.col("features")).otherwise(one)).alias("_f"))
    kind, text = F.col("_f.geometry.type"), F.col("_f.geometry.coordinates")
    rows = rows.where((F.col("_f.type") == "Feature") & kind.isin(*DEPTH) & text.isNotNull())
    return rows.select("file", G.make_geom(kind, parts(kind, text)).alias("geom"), F.col("_f.properties").alias("properties"))


def feature_text(geom: Column, props: dict[str, Column]) -> Column:
    """One GeoJSON Feature (text) of a geometry column and named properties."""
    position = lambda p: F.array(p["x"], p["y"])
    ring = lambda r: F.transform(r, position)
    part = geom["parts"]
    first = F.element_at(part, 1)
    shapes = {
        "Point": position(F.element_at(F.element_at(first, 1), 1)), "LineString": ring(F.element_at(first, 1)),
        "Polygon": F.transform(first, ring), "MultiPoint": F.transform(part, lambda p: position(F.element_at(F.element_at(p, 1), 1))),
        "MultiLineString": F.transform(part, lambda p: ring(F.element_at(p, 1))), "MultiPolygon": F.transform(part, lambda p: F.transform(p, ring)),
    }
    text = None
    for name, shape in shapes.items():
        own = F.to_json(shape)
        text = F.when(geom["type"] == name, own) if text is None else text.when(geom["type"] == name, own)
    values = F.create_map(*[x for k, v in props.items() for x in (F.lit(k), v.cast("string"))]) if props else F.create_map().cast("map<string,string>")
    return F.concat(F.lit('{"type":"Feature","geometry":{"type":"'), geom["type"], F.lit('","coordinates":'), text,
                    F.lit('},"properties":'), F.to_json(values), F.lit("}"))


def collection_text(features: DataFrame, col: str = "value", per_line: int = 1000) -> DataFrame:
    """Features (text rows) as feature collections of about ``per_line`` each, one collection a line."""
    n = F.monotonically_increasing_id()
    chunk = features.select(F.spark_partition_id().alias("_p"), F.floor(n % (1 << 33) / per_line).alias("_c"), col)
    return chunk.groupBy("_p", "_c").agg(F.collect_list(col).alias("_f")).select(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("_f", ","), F.lit("]}")).alias(col))

