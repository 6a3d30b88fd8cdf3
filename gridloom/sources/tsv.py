"""S7 tab-separated border dump with a declared schema.

Fields: osm_id, admin_level, dividing_line, disputed, maritime, geometry.
The geometry field is coordinate text ``x y,x y,...`` (EPSG:3857); the
hex-EWKB form of the original dump is not decoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import geometry as G

BORDER_SCHEMA = T.StructType([
    T.StructField("osm_id", T.LongType()), T.StructField("admin_level", T.IntegerType()),
    T.StructField("dividing_line", T.BooleanType()), T.StructField("disputed", T.BooleanType()),
    T.StructField("maritime", T.BooleanType()), T.StructField("geometry", T.StringType()),
])


def coords_text(g) -> F.Column:
    """LineString -> ``x y,x y,...``"""
    return F.array_join(F.transform(F.element_at(F.element_at(G._c(g)["parts"], 1), 1),
                                    lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ",")


def parse_coords(text) -> F.Column:
    """``x y,x y,...`` -> LineString geometry."""
    pts = F.transform(F.split(G._c(text), ","), lambda s: F.split(F.trim(s), " "))
    return G.line_geom(F.transform(pts, lambda a: G.vertex(F.element_at(a, 1).cast("double"),
                                                           F.element_at(a, 2).cast("double"))))


def write_borders(df: DataFrame, path: str) -> None:
    df.select(*[c.name for c in BORDER_SCHEMA.fields]).write.mode("overwrite").option("sep", "\t").csv(path)


def read_borders(spark: SparkSession, path: str) -> DataFrame:
    """Read with the declared schema (no inference), geometry parsed."""
    df = spark.read.schema(BORDER_SCHEMA).option("sep", "\t").csv(path)
    return df.withColumn("geom", parse_coords("geometry")).drop("geometry")
