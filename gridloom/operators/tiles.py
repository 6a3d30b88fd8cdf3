"""Features x tiles as an equi-join on exploded tile keys.

No spatial index and no theta join: each feature's bbox is expanded into the
tiles it covers at the zoom of its rung (explode), the join with the wanted
tile set is a hash/sort-merge equi-join on (z, x, y), and the exact bbox test
(touching counts, tile buffer included) runs after the join. The zoom band
(J2) is an equi-join on z, the layer gate (J3) a filter on a config row.
Features are expected with bbox columns (minx, miny, maxx, maxy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.tiles import bbox_meets_tile, explode_cover


def zoom_rungs(zmin: int, zmax: int, band: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(z, gen) for each zoom, from bands (zlo, zhi_exclusive, gen)."""
    out = []
    for z in range(zmin, zmax + 1):
        for lo, hi, gen in band:
            if lo <= z < hi:
                out.append((z, gen))
    return out


def features_at_zooms(features: DataFrame, z_gen: list[tuple[int, int]], gen_col: str | None = "gen") -> DataFrame:
    """Pair each zoom with the rung valid there (equi-join on gen; the
    zoom table is a handful of literal rows)."""
    zt = F.array(*[F.struct(F.lit(z).alias("z"), F.lit(g).alias("_g")) for z, g in z_gen])
    if gen_col is None:
        return features.select("*", F.explode(F.array_distinct(F.transform(zt, lambda s: s["z"]))).alias("z"))
    zdf = features.sparkSession.range(1).select(F.explode(zt).alias("_zg")).select("_zg.z", "_zg._g")
    return features.join(F.broadcast(zdf), features[gen_col] == zdf._g).drop("_g")


def tile_join(features: DataFrame, tiles: DataFrame | None, buffer_frac: float = 0.0) -> DataFrame:
    """(feature rows with z and bbox) x tiles -> rows with (z, x, y).

    ``tiles`` restricts the output to a seed set: features meet the blocks of tiles
    that hold a wanted one before single tiles are exploded and semi-joined.
    None keeps every tile a feature meets.
    """
    if tiles is not None:
        tiles = tiles.select("z", "x", "y").distinct()
    cov = explode_cover(features, F.col("z"), buffer_frac, tiles)
    if tiles is not None:
        cov = cov.join(tiles, ["z", "x", "y"], "left_semi")
    return cov.where(bbox_meets_tile(buffer_frac))


def layer_counts(hits: DataFrame) -> DataFrame:
    """T6 summary: features per (z, x, y, layer)."""
    return hits.groupBy("z", "x", "y", "layer").agg(F.count("*").alias("n"))


def top_k_per_tile(hits: DataFrame, k: int, order: list, key: list[str] | None = None,
                   salt_buckets: int = 16, id_col: str = "osm_id") -> DataFrame:
    """O4 top-k per tile in two stages so a crowded tile is not one sort.

    Stage 1 keeps the best k inside (tile, hash(id) % salt_buckets); stage 2
    ranks the at most k * salt_buckets survivors of each tile.
    """
    key = key or ["z", "x", "y"]
    salted = hits.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*key, "_salt").orderBy(*order)
    s1 = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*key).orderBy(*order)
    return s1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)
