"""Property and NULL-logic tests."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.functions import tiles as TL
from gridloom.operators.attributes import is_not_true, name_fallback


def test_name_fallback_three_valued(spark):
    rows = [(None, "en", "n"), ("", "en", "n"), ("de", "en", "n"), ("", None, "n"), ("", "", "n"), ("", "", None)]
    df = spark.createDataFrame(rows, "name_de string, name_en string, name string")
    got = [r.v for r in df.select(name_fallback().alias("v")).collect()]
    # NULL is "not false" for (x <> ''), so a NULL name_de / name_en is returned as is
    assert got == [None, "en", "de", None, "n", None]


def test_is_not_true(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "a string")
    got = [r.k for r in df.select(is_not_true(F.col("a") != "").alias("k")).collect()]
    assert got == [True, True, False]


@settings(max_examples=25, deadline=None)
@given(st.integers(-20_000_000, 20_000_000), st.integers(-20_000_000, 20_000_000), st.integers(0, 500_000),
       st.integers(0, 500_000), st.integers(0, 14))
def test_cover_contains_corner_tiles(spark, x, y, w, h, z):
    """Every corner of the box lies in (inclusive bounds of) some covered tile."""
    x1, y1 = min(x + w, 20_000_000), min(y + h, 20_000_000)
    df = spark.createDataFrame([(float(x), float(y), float(x1), float(y1), z)],
                               "minx double, miny double, maxx double, maxy double, z int")
    cov = TL.explode_cover(df, F.col("z")).where(TL.bbox_meets_tile()).withColumns(TL.tile_bounds()).collect()
    assert cov
    for cx, cy in [(x, y), (x1, y1)]:
        assert any(r.tminx <= cx <= r.tmaxx and r.tminy <= cy <= r.tmaxy for r in cov)


def test_descendants_nest_in_parent(spark):
    t = spark.createDataFrame([(3, 4, 2)], "z int, x long, y long")
    kids = TL.descendants(t, 5).withColumns(TL.tile_bounds())
    parent = t.withColumns(TL.tile_bounds()).first()
    for r in kids.collect():
        assert parent.tminx - 1e-6 <= r.tminx and r.tmaxx <= parent.tmaxx + 1e-6
        assert parent.tminy - 1e-6 <= r.tminy and r.tmaxy <= parent.tmaxy + 1e-6
    assert kids.count() == 1 + 4 + 16  # zoom 3 itself, then zooms 4 and 5


def test_cluster_labels_independent_of_partitioning(spark, sf_dir):
    from gridloom.operators.cluster import cluster_ids
    from gridloom.sources import fixtures as FX
    from gridloom.sources.tables import Tables
    p = FX.poi_points(Tables(spark, sf_dir)).select("osm_id", "x", "y")
    a = {r.osm_id: r.cluster_id for r in cluster_ids(p, 300).collect()}
    b = {r.osm_id: r.cluster_id for r in cluster_ids(p.repartition(5, "x"), 300).collect()}
    assert a == b
    # every pair within eps shares a label
    pts = [(r.osm_id, r.x, r.y) for r in p.collect()]
    for i, (ia, xa, ya) in enumerate(pts):
        for ib, xb, yb in pts[i + 1:]:
            if (xa - xb) ** 2 + (ya - yb) ** 2 <= 300 ** 2:
                assert a[ia] == a[ib]


def test_ladder_is_monotone(spark, sf_dir):
    import gridloom.plans.catalog  # noqa: F401  (registers plans)
    from gridloom.operators.ladder import Rung, ladder_rings
    from gridloom.plans.q_generalize import roads_base
    from gridloom.sources.tables import Tables
    base = roads_base(Tables(spark, sf_dir))
    lr = ladder_rings(base, [Rung(1, 5.0), Rung(2, 50.0), Rung(3, 500.0)])
    n = {(r.gen, r.fid): r.n for r in lr.select("gen", "fid", F.size("verts").alias("n")).collect()}
    for (gen, fid), cnt in n.items():
        if gen < 3:
            assert n[(gen + 1, fid)] <= cnt
        assert cnt >= 2


def test_global_row_number_with_a_hot_key(spark):
    """A third of the rows share one key; numbering still equals a plain window."""
    from pyspark.sql import Window
    from gridloom.operators.labels import global_row_number
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 97)
                                     .alias("k"), F.col("id"))
    order = [F.col("k"), F.col("id")]
    a = {r.id: r.gid for r in global_row_number(df, order, "gid", partitions=6).collect()}
    b = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert a == b


def test_two_stage_topk_equals_window_on_a_hot_tile(spark):
    from pyspark.sql import Window
    from gridloom.operators.tiles import top_k_per_tile
    df = spark.range(0, 3000).select(
        F.lit(10).alias("z"), F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 13).alias("x"),
        F.lit(5).alias("y"), F.col("id").alias("osm_id"), (F.col("id") * 7919 % 1000).alias("pop"))
    order = [F.col("pop").desc(), F.col("osm_id")]
    got = {(r.x, r.osm_id): r.rank for r in top_k_per_tile(df, 50, order, salt_buckets=4).collect()}
    w = Window.partitionBy("z", "x", "y").orderBy(*order)
    exp = {(r.x, r.osm_id): r.rn for r in df.withColumn("rn", F.row_number().over(w)).where("rn <= 50").collect()}
    assert got == exp


def test_clustering_with_a_hot_spot_matches_brute_force(spark):
    import random
    from gridloom.operators.cluster import cluster_ids
    rnd = random.Random(3)
    pts = [(i, 500.0, 500.0) for i in range(200)]                      # a third at one position
    pts += [(200 + i, float(rnd.randint(0, 3000)), float(rnd.randint(0, 3000))) for i in range(400)]
    df = spark.createDataFrame(pts, "osm_id long, x double, y double")
    rows = cluster_ids(df, 120.0).collect()
    least = {}
    for r in rows:
        least[r.cluster_id] = min(r.osm_id, least.get(r.cluster_id, r.osm_id))
    got = {r.osm_id: least[r.cluster_id] for r in rows}
    parent = {p[0]: p[0] for p in pts}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for i, (a, xa, ya) in enumerate(pts):
        for b, xb, yb in pts[i + 1:]:
            if (xa - xb) ** 2 + (ya - yb) ** 2 <= 120.0 ** 2:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for p in pts:
        comp.setdefault(find(p[0]), []).append(p[0])
    expect = {m: min(ms) for ms in comp.values() for m in ms}
    assert got == expect
