"""Seed job: materialize served layers for a zoom range into the tile cache.

    python -m gridloom.plans.seed <sf_dir> <out_path> [zmin zmax] [min_lon min_lat max_lon max_lat]

T5 (tiles of a lon/lat box, or every tile the data meets) -> T6 (feature x
tile join) -> S20 (one more seed of the tile store; tiles outside the box stay as they are).
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.tiles import lonlat_box
from gridloom.operators.serve import tile_rows, write_seed
from gridloom.operators.tiles import tile_join


def seed_tiles(spark: SparkSession, zmin: int, zmax: int, box: tuple[float, float, float, float]) -> DataFrame:
    """T5 by bounds: every tile of zooms zmin..zmax meeting the lon/lat box."""
    b = spark.range(1).select(*[v.alias(k) for k, v in lonlat_box(*box).items()])
    b = b.withColumn("z", F.explode(F.sequence(F.lit(zmin), F.lit(zmax))))
    return tile_join(b, None, 0.0).select("z", "x", "y")


def seed(spark: SparkSession, sf_dir: str, out: str, zmin: int = 12, zmax: int = 16,
         box: tuple[float, float, float, float] | None = None, number: int | None = None) -> None:
    """Seed run ``number`` (default: the time in milliseconds, so later runs are newer)."""
    import gridloom.plans.catalog  # noqa: F401  (registers plan modules)
    from gridloom.plans import q_serve
    from gridloom.plans.q_tiles import BUF

    feats = q_serve.served_features(spark, sf_dir, (zmin, zmax))
    tiles = seed_tiles(spark, zmin, zmax, box) if box else None
    rows = tile_rows(feats, tiles, BUF).select(*q_serve.TILE_COLUMNS)
    number = int(time.time() * 1000) if number is None else number
    write_seed(rows, out, [F.col("ord"), F.col("gid")], number, tiles, list(range(zmin, zmax + 1)))


def main(argv: list[str]) -> None:
    from gridloom.session import local_session
    sf_dir, out = argv[0], argv[1]
    zmin, zmax = (int(argv[2]), int(argv[3])) if len(argv) > 3 else (12, 16)
    box = tuple(float(v) for v in argv[4:8]) if len(argv) > 7 else None
    spark = local_session()
    seed(spark, sf_dir, out, zmin, zmax, box)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
