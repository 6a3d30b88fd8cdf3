"""T9 re-seed of changed tiles as Structured Streaming.

Changed features arrive as files (any file source). A micro-batch gives the
tiles that they meet (explode cover + exact recheck, the same J1 as the batch
path); the new contents of these tiles are computed from *all* current features
that meet them and written as one more seed of the tile store, which
leaves every other tile as it is. The seed's number is the batch's, so a
replayed batch replaces only itself. A feature that moved or went is
given with its old place, so that its old tiles are seeded again as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.serve import write_seed
from gridloom.operators.tiles import layer_counts, tile_join


def reseed_batch(changed: DataFrame, current: DataFrame, zooms: list[int], buffer_frac: float, sink: str,
                 seed: int) -> None:
    at = F.explode(F.array(*[F.lit(z) for z in zooms]))
    tiles = tile_join(changed.withColumn("z", at), None, buffer_frac).select("z", "x", "y").distinct()
    counts = layer_counts(tile_join(current.withColumn("z", at), tiles, buffer_frac))
    write_seed(counts, sink, [F.col("n")], seed, tiles)


def start_reseed(spark: SparkSession, source: str, schema: T.StructType, current: Callable[[], DataFrame], sink: str,
                 checkpoint: str, zooms: list[int], buffer_frac: float = 0.0, files_per_batch: int | None = None):
    """Run until the files present now are processed (availableNow).

    ``current`` returns all features as they are when a batch runs. Batch n is
    written as seed n + 1; seed 0 is left to the full seed.
    """
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return (stream.parquet(source).writeStream
            .foreachBatch(lambda df, n: reseed_batch(df, current(), zooms, buffer_frac, sink, n + 1))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
