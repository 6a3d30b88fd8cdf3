"""C5 merge_to_point / C6 reduce_to_point (point on surface of polygons)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import geometry as G


def reduce_to_point(polys: DataFrame, columns: list, condition: Column | None = None) -> DataFrame:
    """``ST_PointOnSurface(geometry)`` of each polygon passing the filter."""
    if condition is not None:
        polys = polys.where(condition)
    p = G.with_point_on_surface(polys, "geom", "_px", "_py")
    return p.select(F.col("_px").alias("x"), F.col("_py").alias("y"), *columns)


def merge_to_point(polys: DataFrame, points: DataFrame, columns: list, condition: Column | None = None) -> DataFrame:
    """Polygons reduced to points UNION ALL the points, same filter and
    columns on both sides (union by name, so no positional swap)."""
    a = reduce_to_point(polys, columns, condition)
    b = points.where(condition) if condition is not None else points
    b = b.select("x", "y", *columns)
    return a.unionByName(b)
