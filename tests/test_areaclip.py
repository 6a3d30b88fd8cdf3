"""Areas cut down the pyramid against even-odd tests of points, and against areas cut tile by tile."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators import areaclip as A

PARTS = "array<array<array<struct<x:double,y:double>>>>"


def star(cx, cy, r, n, seed):
    q = random.Random(seed)
    pts = [(cx + (d := r * q.uniform(0.3, 1)) * math.cos(t), cy + d * math.sin(t)) for t in (2 * math.pi * i / n for i in range(n))]
    return pts + pts[:1]


def box(a, b, c, d):
    return [(a, b), (c, b), (c, d), (a, d), (a, b)]


def shapes():
    s = 2 * A.WORLD / 2 ** 12
    out = {k: [[star(s * k / 3, s * (k % 4) / 5, s * (1 + k % 3), 9 + 7 * k, k)]] for k in range(10)}
    comb = [(0, 0)] + [p for i in range(12) for p in ((i * s / 4, s * 1.7), (i * s / 4 + s / 8, s * 0.3))] + [(3 * s, 0), (0, 0)]
    out[20] = [[comb]]
    out[21] = [[box(-2 * s, -2 * s, 2 * s, 2 * s), box(-s * 1.5, -s * 1.5, s * 1.5, s * 1.5)[::-1]], [box(-s, -s, s, s), box(-s / 9, -s / 9, s / 9, s / 9)]]
    out[22] = [[box(0, 0, s, s)]]  # edges on tile borders
    out[23] = [[box(s / 8, s / 8, s * 2.9, s * 2.9)] + [box(s * i * 0.37 + s / 5, s * j * 0.37 + s / 5, s * i * 0.37 + s / 3, s * j * 0.37 + s / 3) for i in range(6) for j in range(6)]]
    return out


def inside(rings, x, y):
    hit = False
    for r in rings:
        for (ax, ay), (bx, by) in zip(r, r[1:]):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                hit = not hit
    return hit


def table(spark, own):
    return spark.createDataFrame([(k, [[[{"x": float(x), "y": float(y)} for x, y in r] for r in p] for p in ps]) for k, ps in own.items()], f"fid long, parts {PARTS}").repartition(3)


@pytest.mark.parametrize("buffer", [0.0, 1 / 16])
def test_tiles_hold_what_the_area_has_there(spark, buffer):
    own = shapes()
    rows = A.tile_areas(table(spark, own), 10, 15, buffer).collect()
    assert len({(r.fid, r.z, r.x, r.y) for r in rows}) == len(rows)
    by_tile = {(r.fid, r.z, r.x, r.y): [[(v.x, v.y) for v in ring] for part in r.parts for ring in part] for r in rows}
    r = random.Random(1)
    for fid, parts in own.items():
        rings = [ring for p in parts for ring in p]
        xs, ys = zip(*[v for ring in rings for v in ring])
        for _ in range(60):
            x, y = r.uniform(min(xs), max(xs)), r.uniform(min(ys), max(ys))
            for z in range(10, 16):
                s = 2 * A.WORLD / 2 ** z
                tx, ty = math.floor((x + A.WORLD) / s), math.floor((A.WORLD - y) / s)
                assert inside(by_tile.get((fid, z, tx, ty), []), x, y) == inside(rings, x, y), (fid, z)
    for (fid, z, tx, ty), rings in by_tile.items():
        s = 2 * A.WORLD / 2 ** z
        b = s * buffer + 1e-6
        assert all(ring[0] == ring[-1] and len(ring) > 3 for ring in rings)
        assert all(-A.WORLD + tx * s - b <= x <= -A.WORLD + (tx + 1) * s + b and A.WORLD - (ty + 1) * s - b <= y <= A.WORLD - ty * s + b for ring in rings for x, y in ring)


def test_areas_add_up_and_parts_have_their_holes(spark):
    own = shapes()
    df = table(spark, own)
    whole = {r.fid: r.a for r in df.select("fid", F.abs(G.area(G.make_geom("MultiPolygon", "parts"))).alias("a")).collect()}
    cut = A.tile_areas(df, 11, 15).withColumn("a", G.area(G.make_geom("MultiPolygon", "parts")))
    for r in cut.groupBy("fid", "z").agg(F.sum("a").alias("a")).collect():
        assert r.a == pytest.approx(whole[r.fid], rel=1e-9)
    for r in cut.select(F.explode("parts").alias("p")).select(F.transform("p", G.ring_signed_area).alias("a")).collect():
        assert r.a[0] > 0 and all(x < 0 for x in r.a[1:])


def test_rings_that_fall_apart(spark):
    s = 2 * A.WORLD / 2 ** 12
    out = {(r.x, r.y): r.parts for r in A.cut_down(table(spark, {20: shapes()[20]}), 12, 12).collect()}
    top = out[2048, 2046]  # above the first row of tiles only the comb's teeth are left
    assert len(top) > 1 and all(len(p) == 1 for p in top)
    assert all(v.y >= s - 1e-6 for p in top for v in p[0])


def test_tile_units_and_empty(spark):
    df = A.cut_down(table(spark, {1: [[box(1, 1, 3, 3)]], 2: [], 3: [[[(0, 0), (1, 1), (0, 0)]]]}), 2, 3)
    got = df.withColumn("parts", A.to_tile_units()).collect()
    assert {(r.fid, r.z) for r in got} == {(1, 2), (1, 3)} and all(r.parts == [] for r in got)  # smaller than a unit
    assert A.tile_areas(table(spark, {}), 0, 6).collect() == []
    half = A.cut_down(table(spark, {1: [[box(0, -A.WORLD / 2, A.WORLD, 0)]]}), 1, 1).withColumn("parts", A.to_tile_units()).collect()
    assert [(r.x, r.y) for r in half] == [(1, 1)] and sorted((v.x, v.y) for v in half[0].parts[0][0][:-1]) == [(0, 0), (0, 2048), (4096, 0), (4096, 2048)]


def test_grid_squares(spark):
    own, size = shapes(), 2 * A.WORLD / 2 ** 12 * 0.61
    rows = A.cut_by_grid(table(spark, own).withColumn("side", F.lit(size)), "side")
    whole = {r.fid: r.a for r in table(spark, own).select("fid", G.area(G.make_geom("MultiPolygon", "parts")).alias("a")).collect()}
    for r in rows.groupBy("fid").agg(F.sum(G.area(G.make_geom("MultiPolygon", "parts"))).alias("a")).collect():
        assert r.a == pytest.approx(whole[r.fid], rel=1e-9)
    by = {(r.fid, r.gx, r.gy): [[(v.x, v.y) for v in ring] for part in r.parts for ring in part] for r in rows.collect()}
    assert len(by) == rows.count()
    q = random.Random(2)
    for fid, parts in own.items():
        rings = [ring for p in parts for ring in p]
        xs, ys = zip(*[v for ring in rings for v in ring])
        for _ in range(200):
            x, y = q.uniform(min(xs), max(xs)), q.uniform(min(ys), max(ys))
            assert inside(by.get((fid, math.floor(x / size), math.floor(y / size)), []), x, y) == inside(rings, x, y)


def test_clip_to_box(spark):
    rows = [
        (1, "LineString", [[[(-5, 0), (5, 0), (5, 20), (-5, 20), (-5, 5)]]]),  # leaves and comes back
        (2, "LineString", [[[(30, 0), (30, 5)]]]),                               # wholly outside
        (3, "LineString", [[[(0, 0), (1, 1)]]]),                                 # inside
        (4, "Polygon", [[[(-20, -5), (20, -5), (20, 5), (-20, 5), (-20, -5)], [(-1, -1), (-1, 1), (1, 1), (1, -1), (-1, -1)]]]),
        (5, "Polygon", [[[(-5, 5), (5, 5), (5, 15), (3, 15), (3, 7), (-3, 7), (-3, 15), (-5, 15), (-5, 5)]]]),
        (6, "Polygon", [[[(-5, 15), (5, 15), (5, 8), (3, 8), (3, 13), (-3, 13), (-3, 8), (-5, 8), (-5, 15)]]]),  # falls apart
        (7, "Point", [[[(0, 11)]]]), (8, "Point", [[[(10, 10)]]]), (9, "MultiPoint", [[[(0, 0)]], [[(99, 0)]]]),
        (10, "MultiLineString", [[[(0, 0), (0, 50)]], [[(0, 60), (0, 70)]]]), (11, None, None)]
    df = spark.createDataFrame([(i, (t, [[[{"x": float(x), "y": float(y)} for x, y in r] for r in p] for p in ps]) if t else None, {"k": str(i)}) for i, t, ps in rows],
                               "id long, geom struct<type:string,parts:array<array<array<struct<x:double,y:double>>>>>, props map<string,string>").repartition(2)
    out = {r.id: r for r in A.clip_to_box(df, (-10.0, -10.0, 10.0, 10.0)).collect()}
    assert set(out) == {1, 3, 4, 5, 6, 8, 9, 10, 11} and out[11].geom is None and out[4].props == {"k": "4"}
    verts = lambda i: [[[(v.x, v.y) for v in r] for r in p] for p in out[i].geom.parts]
    assert out[1].geom.type == "MultiLineString" and verts(1) == [[[(-5, 0), (5, 0), (5, 10)]], [[(-5, 10), (-5, 5)]]]
    assert verts(3) == [[[(0, 0), (1, 1)]]] and out[10].geom.type == "LineString" and verts(10) == [[[(0, 0), (0, 10)]]]
    assert out[9].geom.type == "Point" and verts(9) == [[[(0, 0)]]] and out[8].geom.type == "Point"
    areas = {r.id: r.a for r in A.clip_to_box(df, (-10.0, -10.0, 10.0, 10.0)).select("id", G.area("geom").alias("a")).collect()}
    assert (areas[4], areas[5], areas[6]) == (196.0, 10 * 2 + 2 * 2 * 3.0, 2 * 2 * 2.0)
    assert out[6].geom.type == "MultiPolygon" and len(out[6].geom.parts) == 2 and out[5].geom.type == "Polygon"
