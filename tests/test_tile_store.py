"""The tile store: a seed of some tiles leaves all others alone."""

from pyspark.sql import functions as F

from gridloom.operators.serve import compact, read_store, read_tile, write_seed
from gridloom.operators.tiles import tile_join
from gridloom.session import ensure_checkpoint_dir

SCHEMA = "x bigint, y bigint, layer string, gid bigint"


def rows(spark, *data):
    return spark.createDataFrame(list(data), "z int, x bigint, y bigint, layer string, gid bigint")


def tiles(spark, *data):
    return spark.createDataFrame(list(data), "z int, x bigint, y bigint")


def seen(spark, path, **options):
    return sorted((r.z, r.x, r.y, r.gid) for r in read_store(spark, path, SCHEMA, **options).collect())


def test_partial_seeds(spark, tmp_path):
    path, order = str(tmp_path / "store"), [F.col("gid")]
    write_seed(rows(spark, (12, 1, 1, "a", 1), (12, 2, 1, "a", 2), (13, 5, 5, "a", 3)), path, order, 0, zooms=[12, 13])
    write_seed(rows(spark, (12, 2, 1, "a", 20)), path, order, 1, tiles(spark, (12, 2, 1), (12, 3, 1)))
    assert seen(spark, path) == [(12, 1, 1, 1), (12, 2, 1, 20), (13, 5, 5, 3)]
    # a tile that became empty is empty, one that was empty is filled; a repeated run replaces only itself
    for _ in range(2):
        write_seed(rows(spark, (12, 3, 1, "a", 30)), path, order, 2, tiles(spark, (12, 1, 1), (12, 3, 1)))
    assert seen(spark, path) == [(12, 2, 1, 20), (12, 3, 1, 30), (13, 5, 5, 3)]
    # another map, and one whole zoom again
    write_seed(rows(spark, (12, 1, 1, "a", 99)), path, order, 7, zooms=[12], map_name="global")
    write_seed(rows(spark, (13, 6, 6, "a", 4)), path, order, 3, zooms=[13])
    assert seen(spark, path) == [(12, 2, 1, 20), (12, 3, 1, 30), (13, 6, 6, 4)]
    assert seen(spark, path, map_name="global") == [(12, 1, 1, 99)]
    one = read_tile(spark, path, SCHEMA, tiles(spark, (12, 3, 1)))
    assert [(r.x, r.gid) for r in one.collect()] == [(3, 30)]
    compact(spark, path, SCHEMA, str(tmp_path / "folded"), order)
    assert seen(spark, str(tmp_path / "folded")) == seen(spark, path)


def test_rows_without_their_list_do_not_count(spark, tmp_path):
    path, order = str(tmp_path / "store"), [F.col("gid")]
    write_seed(rows(spark, (12, 1, 1, "a", 1)), path, order, 0, zooms=[12])
    rows(spark, (12, 1, 1, "a", 2)).write.partitionBy("z").parquet(f"{path}/rows/map=local/seed=5")  # a run that died
    assert seen(spark, path) == [(12, 1, 1, 1)]


def test_two_micro_batches_count_all_features(spark):
    from gridloom.streaming.reseed import reseed_batch
    sink = f"{ensure_checkpoint_dir(spark)}/two-batches"
    schema = "layer string, fid long, minx double, miny double, maxx double, maxy double"
    feats = spark.createDataFrame([("l", i, x, 10.0, x, 10.0) for i, x in enumerate([10.0, 20.0, 5e6, -5e6])], schema)
    for n, fid in enumerate([0, 2]):
        reseed_batch(feats.where(F.col("fid") == fid), feats, [9], 0.0, sink, n + 1)
    got = sorted(r.n for r in read_store(spark, sink, "x bigint, y bigint, layer string, n bigint").collect())
    assert got == [1, 2]


def test_world_wide_box_for_one_tile_and_for_all(spark):
    box = spark.createDataFrame([(1, -2e7, -2e7, 2e7, 2e7)], "fid long, minx double, miny double, maxx double, maxy double")
    one = tile_join(box.withColumn("z", F.lit(16)), tiles(spark, (16, 40_000, 30_000), (16, 5, 70_000)))
    assert [(r.x, r.y) for r in one.collect()] == [(40_000, 30_000)]
    whole = tile_join(box.withColumn("z", F.lit(10)), None)
    assert whole.select("x", "y").distinct().count() == whole.count() == 1024 * 1024
    assert whole.rdd.getNumPartitions() > 1
