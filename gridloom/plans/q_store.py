"""Stored feature tables: S17 clustered by place and replaced, U2 appended once, S21 sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.functions.geometry import WORLD_EDGE
from gridloom.functions.tiles import bbox_meets_tile
from gridloom.operators import tablestore
from gridloom.plans import oracle_fixtures as OF
from gridloom.plans.catalog import lines, query
from gridloom.plans.q_io import _scratch
from gridloom.plans.q_tiles import BUF, E, W
from gridloom.plans.q_world import BATHYMETRY_SOURCES, bathymetry_sources
from gridloom.sources.fixtures import GRID
from gridloom.sources.tables import Tables

TILE_ZOOM, TILE_AT = 13, 10000.0  # the tile over this place of the fixture square


@query("table_one_tile", OF.with_(OF.WAY_NODES) + f""",
feats AS (SELECT fid, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM line_verts GROUP BY fid),
tile AS (SELECT s, -{E} + floor(({TILE_AT} + {E}) / s) * s AS x0, {E} - floor(({E} - {TILE_AT}) / s) * s AS y1 FROM (SELECT {W} / pow(2.0, {TILE_ZOOM}) AS s))
SELECT fid FROM feats, tile
WHERE maxx >= x0 - s * {BUF!r} AND minx <= x0 + s + s * {BUF!r} AND maxy >= y1 - s - s * {BUF!r} AND miny <= y1 + s * {BUF!r}""")
def q_table_one_tile(spark, d):
    """The road table stored by place, then asked for one tile, for which only the files that meet it are read."""
    feats = lines(Tables(spark, d)).select("fid", *[v.alias(k) for k, v in G.bbox("geom").items()])
    path = _scratch(spark, "table-roads")
    tablestore.replace(feats, path, "roads")
    at = 2.0 * WORLD_EDGE / 2 ** TILE_ZOOM
    tile = spark.range(1).select(F.lit(TILE_ZOOM).alias("z"), F.lit(int((TILE_AT + WORLD_EDGE) // at)).alias("x"), F.lit(int((WORLD_EDGE - TILE_AT) // at)).alias("y"))
    rows = tablestore.read(spark, path, feats.schema, tile, BUF)
    z, x, y = tile.first()
    return rows.withColumns({"z": F.lit(z), "x": F.lit(x), "y": F.lit(y)}).where(bbox_meets_tile(BUF)).select("fid")


@query("append_bathymetry", "\nUNION ALL ".join(
    f"SELECT 'ne_{name}' AS load, s_suppkey AS src_key, CAST({depth} AS INTEGER) AS depth FROM supplier WHERE s_suppkey % {len(BATHYMETRY_SOURCES)} = {i}"
    for i, (name, depth) in enumerate(BATHYMETRY_SOURCES)))
def q_append_bathymetry(spark, d):
    """Every bathymetry source appended to one table, the whole job run twice; each load counts once."""
    path = _scratch(spark, "table-bathymetry")
    x, y = (F.col("src_key") * 7919 % GRID).cast("double"), (F.col("src_key") * 104729 % GRID).cast("double")
    for _ in range(2):
        for (name, _depth), rows in zip(BATHYMETRY_SOURCES, bathymetry_sources(Tables(spark, d)), strict=True):
            own = rows.select(F.lit(f"ne_{name}").alias("load"), "src_key", F.col("depth").cast("int").alias("depth"), x.alias("minx"), y.alias("miny"), x.alias("maxx"), y.alias("maxy"))
            tablestore.append(own, path, f"ne_{name}", partitions=1)
    return tablestore.read(spark, path, own.schema).select("load", "src_key", "depth")
