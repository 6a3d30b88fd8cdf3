"""Track tools: A10 length, A11 bounds, W3 legs (GPS points -> per track)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.geometry import haversine_km
from gridloom.operators.labels import global_row_number


def legs(points: DataFrame, track: str = "track_id", order=("time", "point_id")) -> DataFrame:
    """Each point with the previous one of its track and the leg length (km).

    No window per track (a track holding a third of all points would be one
    task): points are numbered globally in (track, order) by range
    partitioning + partition offsets, and each point is equi-joined with the
    point numbered one less in the same track.
    """
    num = global_row_number(points, [F.col(track), *[F.col(o) for o in order]], "_g")
    prev = num.select(F.col(track).alias("_pt"), (F.col("_g") + 1).alias("_pg"), F.col("lon").alias("plon"),
                      F.col("lat").alias("plat"))
    p = num.join(prev, (num["_g"] == prev["_pg"]) & (num[track] == prev["_pt"]), "left").drop("_pt", "_pg", "_g")
    return p.withColumn("leg_km", F.when(F.col("plon").isNotNull(),
                                         haversine_km("plon", "plat", "lon", "lat")).otherwise(F.lit(0.0)))


def track_length(points: DataFrame, track: str = "track_id") -> DataFrame:
    """A10: sum of leg lengths, km, rounded to 2 decimals like the viewer."""
    return legs(points, track).groupBy(track).agg(
        F.round(F.sum("leg_km"), 2).alias("km"), F.count("*").alias("n_points"))


def track_bounds(points: DataFrame, track: str = "track_id") -> DataFrame:
    """Min / max of lon and lat per track (partial aggregation)."""
    return points.groupBy(track).agg(
        F.min("lon").alias("min_lon"), F.min("lat").alias("min_lat"),
        F.max("lon").alias("max_lon"), F.max("lat").alias("max_lat"))
