"""T6 tile materialization and the S20 tile store.

Tile contents are written as *rows* (one per feature in a tile), not as one
array per tile, so a crowded tile never becomes one giant row or one task: the
rows are range-partitioned on (z, x, y, layer, draw order) -- a hot tile
spreads over consecutive partitions -- and sorted within partitions.

The store only grows. Each seed run writes its rows under ``rows/map=/seed=/z=``
and then, as its last step, the tiles that it covered under ``seeded/map=/seed=``:
a list of tiles, or whole zooms. A tile shows the rows of the newest seed
that covered it, so a seed of a box, a list or one tile leaves all other tiles alone, a
tile that became empty is empty, a reader never sees half a seed, and a run that
is repeated with its number replaces only itself. ``compact`` folds a store into one seed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.tiles import tile_join

SEEDED = "map string, seed bigint, z int, x bigint, y bigint"


def tile_rows(features: DataFrame, tiles: DataFrame | None, buffer_frac: float) -> DataFrame:
    """Feature rows (with z and bbox) -> rows keyed by (z, x, y)."""
    return tile_join(features, tiles, buffer_frac)


def write_seed(rows: DataFrame, path: str, order: list, seed: int = 0, tiles: DataFrame | None = None,
               zooms: list[int] | None = None, map_name: str = "local") -> None:
    """Write ``rows`` as what seed run ``seed`` has for ``tiles`` (z, x, y), or for all tiles of ``zooms``."""
    spark = rows.sparkSession
    keys = [F.col("z"), F.col("x"), F.col("y"), F.col("layer"), *order]
    at = f"map={map_name}/seed={seed}"
    (rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").partitionBy("z").parquet(f"{path}/rows/{at}"))
    if tiles is None:
        if zooms is None:
            raise ValueError("a seed covers a list of tiles or whole zooms")
        covered = spark.createDataFrame([(z, None, None) for z in zooms], "z int, x bigint, y bigint")
    else:
        covered = tiles.select(F.col("z").cast("int").alias("z"), F.col("x").cast("bigint").alias("x"),
                               F.col("y").cast("bigint").alias("y")).distinct()
    covered.write.mode("overwrite").parquet(f"{path}/seeded/{at}")  # from here on it counts


def read_store(spark: SparkSession, path: str, schema: str, tiles: DataFrame | None = None,
               map_name: str = "local") -> DataFrame:
    """Current rows of the store (``schema``: their columns but z), of all tiles or of ``tiles``."""
    seeded = spark.read.schema(SEEDED).parquet(f"{path}/seeded").where(F.col("map") == map_name)
    rows = spark.read.schema(f"{schema}, map string, seed bigint, z int").parquet(f"{path}/rows")
    rows = rows.where(F.col("map") == map_name)
    if tiles is not None:
        wanted = tiles.select(F.col("z").cast("int").alias("z"), F.col("x").cast("bigint").alias("x"),
                              F.col("y").cast("bigint").alias("y")).distinct()
        rows = rows.join(wanted, ["z", "x", "y"], "left_semi")
        seeded = seeded.where("x is null").unionByName(
            seeded.where("x is not null").join(wanted, ["z", "x", "y"], "left_semi"))
    whole = seeded.where("x is null").groupBy("z").agg(F.max("seed").alias("_whole"))  # a row a zoom
    single = seeded.where("x is not null").groupBy("z", "x", "y").agg(F.max("seed").alias("_single"))
    newest = F.greatest("_whole", "_single")  # NULLs don't count
    out = rows.join(whole, "z", "left").join(single, ["z", "x", "y"], "left").where(F.col("seed") == newest)
    return out.drop("map", "seed", "_whole", "_single")


def compact(spark: SparkSession, path: str, schema: str, target: str, order: list, map_name: str = "local") -> None:
    """Fold the current rows into a new store with one seed (number 0) that covers all zooms of the old."""
    zooms = spark.read.schema(SEEDED).parquet(f"{path}/seeded").where(F.col("map") == map_name).select("z").distinct()
    write_seed(read_store(spark, path, schema, map_name=map_name), target, order, 0, None,
               sorted(r.z for r in zooms.collect()), map_name)  # a row a zoom


def read_tile(spark: SparkSession, path: str, schema: str, tiles: DataFrame, map_name: str = "local") -> DataFrame:
    """T10 one tile (or a few)."""
    return read_store(spark, path, schema, tiles, map_name)
