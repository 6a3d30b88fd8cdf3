"""S4 directory load of layers, S6 clip on load, S5 reproject on load.

Every sub-folder of a root holds one layer of GeoJSON features of any type, one a line or
in collections; the layer is named after its folder. A folder without content is reported
and skipped. Features are clipped to the web-mercator latitude band (S6) and
projected lon/lat -> EPSG:3857 (S5). All layers are read by one Spark scan
over the whole tree, with the folder name taken from the file path.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators.areaclip import clip_to_box
from gridloom.sources.geojson import read_geojson

log = logging.getLogger(__name__)

# The lon/lat box every source is clipped to on load.
CLIP_BOX = (-180.0, -85.06, 180.0, 85.06)


def layer_names(spark: SparkSession, root: str) -> tuple[list[str], list[str]]:
    """(non-empty layer folders, empty ones) under ``root``: folders with a file, and those whose files are all empty."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    sizes = found.groupBy(F.element_at(F.split("path", "/"), -2).alias("layer")).agg(F.sum("length").alias("n")).collect()  # a row a layer
    return sorted(r.layer for r in sizes if r.n), sorted(r.layer for r in sizes if not r.n)


def load_geojson_layers(spark: SparkSession, root: str) -> DataFrame:
    """(layer, geom, x, y, properties) for every feature of every layer folder; x, y: of points.

    Everything is cut at the clip box, in lon/lat: points outside are left out, lines are cut into the parts inside,
    areas are closed along the box, and what lies outside altogether is left out.
    """
    _, empty = layer_names(spark, root)
    for name in empty:
        log.warning("layer folder %s is empty, skipped", name)
    f = read_geojson(spark, f"{root.rstrip('/')}/*")
    f = f.withColumn("layer", F.element_at(F.split("file", "/"), -2))
    f = clip_to_box(f.select("layer", "geom", "properties"), CLIP_BOX)
    out = f.select("layer", G.reproject_geom("geom").alias("geom"), "properties", (F.col("geom.type") == "Point").alias("_point"))
    first = F.element_at(F.element_at(F.element_at("geom.parts", 1), 1), 1)
    return out.select("layer", "geom", F.when(F.col("_point"), first["x"]).alias("x"), F.when(F.col("_point"), first["y"]).alias("y"), "properties")
