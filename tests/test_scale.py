"""Plans and tasks that must follow the input."""

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators import linemerge
from gridloom.operators.linemerge import merge_chains, merge_rows
from gridloom.plans import catalog  # noqa: F401  (first: the plans import each other through it)
from gridloom.plans import q_generalize
from gridloom.plans.q_generalize import waterarea_rungs
from gridloom.sources import fixtures as FX
from gridloom.sources.tables import Tables, spread


def test_polygons_are_not_broadcast(spark, sf_dir):
    """The geometries of the cascaded ladder meet the rung's areas in a shuffle, not through the driver."""
    plan = waterarea_rungs(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_features_of_a_small_file_are_spread(spark, tmp_path):
    """A file of many narrow rows is one split; its features are dealt out, all of them once."""
    rows = spark.range(50_000).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey"), F.lit("n").alias("c_name"), F.lit(1.0).alias("c_acctbal"))
    rows.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    for build in (FX.label_points, FX.poi_points):
        made = build(Tables(spark, str(tmp_path)))
        assert made.rdd.getNumPartitions() == 3
        assert made.agg(F.count("*"), F.count_distinct("osm_id"), F.sum("osm_id")).first()[:] == (50_000, 50_000, 50_000 * 49_999 // 2)


def test_spread_by_key(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 100).withColumn("k", F.when(F.col("k") > 0, F.col("k"))).coalesce(1)
    dealt = spread(df, "k", rows=20)
    assert dealt.rdd.getNumPartitions() == 50 and dealt.count() == 1000 and dealt.where("k is null").count() == 10
    assert dealt.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.count_distinct("p").alias("n")).where("n > 1").count() == 0
    assert spread(df, "k", rows=1000).rdd.getNumPartitions() == 1


def test_one_group_of_lines_is_spread(spark):
    """Lines without keys are one group; its rows stay dealt over tasks, since no join goes by the group."""
    rows = [(i, [{"x": float(i), "y": 0.0}, {"x": i + 1.0, "y": 1.0}, {"x": i + 0.5, "y": 2.0}]) for i in range(200)]
    df = spark.createDataFrame(rows, "fid long, v array<struct<x:double,y:double>>").select("fid", G.line_geom("v").alias("geom")).repartition(4)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = merge_rows(df, []).withColumn("p", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(r.chain for r in got) == list(range(200)) and len({r.p for r in got}) > 1


def test_rungs_are_summed_up_by_rows(spark, monkeypatch):
    """A ladder that was written and read back is summed up in tasks that follow its rows, a feature's rings in one sum."""
    monkeypatch.setattr(q_generalize, "SPREAD_ROWS", 10)
    rings = spark.range(2000).select((F.col("id") % 2).cast("int").alias("gen"), F.when(F.col("id") % 1000 > 9, F.floor(F.col("id") / 4)).alias("fid"),
                                     F.array_repeat(F.lit(1), (F.col("id") % 3).cast("int")).alias("verts"))
    got = q_generalize._by_gen(spark, rings, "test")
    assert got.rdd.getNumPartitions() == 40
    want = {}
    for i in range(2000):
        key = (i % 2, i // 4 if i % 1000 > 9 else None)
        want[key] = want.get(key, 0) + i % 3
    assert {(r.gen, r.fid): r.nv for r in got.collect()} == want and got.count() == len(want)


def test_chains_are_joined_by_rows(spark, monkeypatch):
    """Chains are found in tasks that follow the lines, with the same rows: NULL keys, members that repeat, parts and a cycle."""
    def line(*xy):
        return [[{"x": float(x), "y": float(y)} for x, y in xy]]

    rows = []
    for g in [None, *range(60)]:
        rows += [(g, 1, [line((0, 0), (3, 4))]), (g, 2, [line((3, 4), (3, 8))]), (g, 2, [line((3, 4), (3, 8))]), (g, 3, [line((9, 9), (9, 7)), line((20, 0), (20, 5))]),
                 (g, 4, [line((9, 7), (5, 7))]), (g, 5, [line((30, 0), (31, 0), (31, 1))]), (g, 6, [line((31, 1), (30, 0))]), (g, None, [line((50, 0), (50, 1))])]
    df = spark.createDataFrame(rows, "g int, fid long, p array<array<array<struct<x:double,y:double>>>>").select("g", "fid", G.make_geom("MultiLineString", F.col("p")).alias("geom"))
    want = sorted((repr(g), *c) for g in [None, *range(60)] for c in
                  [("1", 2, 9.0), ("3", 2, 6.0), ("3", 1, 5.0), ("5", 2, round(2 + 2 ** 0.5, 6)), ("None", 0, 1.0)])

    def rows_of(got):
        return sorted((repr(r.g), repr(r.chain), r.n_lines, round(r.length, 6)) for r in got.collect())

    assert rows_of(merge_chains(df, ["g"])) == want
    monkeypatch.setattr(linemerge, "SPREAD_ROWS", 5)
    got = merge_chains(df, ["g"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "20), REPARTITION_BY_NUM" in plan  # 488 lines and parts, 25 to a task
    assert rows_of(got) == want
