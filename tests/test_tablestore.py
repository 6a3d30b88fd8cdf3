"""Stored tables: files that lie together, whole replacement, loads that count once."""

import random

from pyspark.sql import functions as F

from gridloom.functions.geometry import WORLD_EDGE
from gridloom.operators import tablestore as S

SCHEMA = "fid long, minx double, miny double, maxx double, maxy double"


def rows(spark, n=4000, seed=1, first=0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        x, y = r.uniform(-WORLD_EDGE, WORLD_EDGE), r.uniform(-WORLD_EDGE, WORLD_EDGE)
        out.append((first + i, x, y, x + r.uniform(0, 5e4), y + r.uniform(0, 5e4)))
    return out, spark.createDataFrame(out, SCHEMA).repartition(6)


def test_one_tile_reads_few_files(spark, tmp_path):
    own, df = rows(spark)
    path = str(tmp_path / "t")
    S.replace(df, path, "a", partitions=64)
    tile = spark.createDataFrame([(5, 9, 21)], "z int, x long, y long")
    some = S.read(spark, path, SCHEMA, tile)
    every = S.read(spark, path, SCHEMA)
    assert len(every.inputFiles()) > 40 and len(some.inputFiles()) <= len(every.inputFiles()) / 8
    s = 2 * WORLD_EDGE / 32
    x0, y1 = -WORLD_EDGE + 9 * s, WORLD_EDGE - 21 * s
    meets = lambda r: r[3] >= x0 and r[1] <= x0 + s and r[4] >= y1 - s and r[2] <= y1
    assert {r.fid for r in some.collect() if meets(tuple(r))} == {r[0] for r in own if meets(r)} != set()
    assert sorted(map(tuple, every.collect())) == sorted(own)
    empty = spark.createDataFrame([], "z int, x long, y long")
    assert S.read(spark, path, SCHEMA, empty).count() == 0


def test_replace_and_append_once(spark, tmp_path):
    path = str(tmp_path / "t")
    a, da = rows(spark, 100, 1)
    b, db = rows(spark, 50, 2, 1000)
    assert S.read(spark, path, SCHEMA).count() == 0
    assert S.append(da, path, "a") and not S.append(da, path, "a")
    assert S.append(db, path, "b") and not S.append(db, path, "b")
    assert sorted(map(tuple, S.read(spark, path, SCHEMA).collect())) == sorted(a + b)
    report = {r["load"]: (r["rows"], r["bytes"] > 0, r["files"] > 0) for r in S.size_report(spark, path).collect()}
    assert report == {"a": (100, True, True), "b": (50, True, True)}
    S.replace(db, path, "c")
    assert sorted(map(tuple, S.read(spark, path, SCHEMA).collect())) == sorted(b)
    assert S.append(da, path, "a")  # the new table hasn't that load
    S.replace(da.limit(0), path, "d")
    assert S.read(spark, path, SCHEMA).count() == 0 and not S.append(da, path, "d")


def test_rows_without_a_manifest_do_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    a, da = rows(spark, 30)
    S.append(da, path, "a")
    da.write.parquet(f"{path}/data/left-over")  # a job that was lost before its manifest
    assert S.read(spark, path, SCHEMA).count() == 30


def test_z_order_keeps_neighbours_together(spark):
    df = spark.createDataFrame([(float(x), float(y)) for x in range(4) for y in range(4)], "x double, y double")
    at = lambda c: (F.col(c) + 0.5) / 4 * 2 * WORLD_EDGE - WORLD_EDGE
    got = {(r.x, r.y): r.z >> 28 for r in df.select("x", "y", S.z_order(at("x"), at("y")).alias("z")).collect()}
    assert [p for p, _ in sorted(got.items(), key=lambda i: i[1])][:4] == [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (1.0, 1.0)]
    assert sorted(got.values()) == list(range(16))
