"""Hand-made shapes: measures, closedness, point on surface, clipping, DP."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import geometry as G
from gridloom.operators.assemble import vertex_rows
from gridloom.operators.simplify import significance

SQUARE = [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]]
HOLED = [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(4, 4), (4, 6), (6, 6), (6, 4), (4, 4)]]
L_SHAPE = [[(0, 0), (10, 0), (10, 2), (2, 2), (2, 10), (0, 10), (0, 0)]]
BOWTIE = [[(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]]
OPEN_LINE = [(0, 0), (3, 4), (6, 0)]
CLOSED_LINE = [(0, 0), (3, 4), (6, 0), (0, 0)]
COLLINEAR = [(0, 0), (1, 0), (2, 0), (3, 0)]
REPEATED = [(0, 0), (0, 0), (5, 0)]


def _geom_df(spark, rows):
    """rows: (fid, type, parts) with parts as nested python lists."""
    schema = T.StructType([T.StructField("fid", T.LongType()), T.StructField("geom", G.GEOMETRY)])
    data = []
    for fid, typ, parts in rows:
        data.append((fid, (typ, [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in parts])))
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def shapes(spark):
    return _geom_df(spark, [
        (1, "Polygon", [SQUARE]), (2, "Polygon", [HOLED]), (3, "Polygon", [L_SHAPE]), (4, "Polygon", [BOWTIE]),
        (5, "LineString", [[OPEN_LINE]]), (6, "LineString", [[CLOSED_LINE]]), (7, "LineString", [[COLLINEAR]]),
        (8, "LineString", [[REPEATED]]),
    ])


def _measures(shapes):
    rows = shapes.select("fid", G.area("geom").alias("a"), G.length("geom").alias("l"),
                         G.perimeter("geom").alias("p"), G.is_closed("geom").alias("c"),
                         *[v.alias(k) for k, v in G.bbox("geom").items()]).collect()
    return {r.fid: r for r in rows}


def test_area_length_perimeter(shapes):
    m = _measures(shapes)
    assert m[1].a == 100 and m[1].p == 40 and m[1].l == 0
    assert m[2].a == 96 and m[2].p == 48
    assert m[3].a == 36
    assert m[5].l == 10 and m[5].a == 0 and m[5].p == 0
    assert m[7].l == 3
    assert m[8].l == 5
    assert (m[3].minx, m[3].miny, m[3].maxx, m[3].maxy) == (0, 0, 10, 10)


def test_is_closed(shapes):
    m = _measures(shapes)
    assert m[1].c and m[6].c and not m[5].c and not m[7].c


def _inside(ring, x, y):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            inside = not inside
    return inside


def test_point_on_surface_is_inside(shapes):
    rows = G.with_point_on_surface(shapes.where("fid in (1, 2, 3)")).select("fid", "px", "py").collect()
    shape = {1: SQUARE, 2: HOLED, 3: L_SHAPE}
    for r in rows:
        rings = shape[r.fid]
        assert _inside(rings[0], r.px, r.py)
        for hole in rings[1:]:
            assert not _inside(hole, r.px, r.py)


def test_clip_square(spark):
    df = _geom_df(spark, [(1, "Polygon", [SQUARE]), (2, "Polygon", [[[(0, 0), (10, 0), (0, 10), (0, 0)]]])])
    out = df.select("fid", G.area(G.clip_polygon_to_box("geom", 5.0, 5.0, 20.0, 20.0)).alias("a")).collect()
    a = {r.fid: r.a for r in out}
    assert a[1] == pytest.approx(25.0)
    assert a[2] == pytest.approx(0.0)  # the triangle only touches the box corner


def _dp_reference(pts, tol):
    """Plain recursive Douglas-Peucker (distance to segment, > tol keeps)."""
    def seg_d(p, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        l2 = dx * dx + dy * dy
        t = 0.0 if l2 == 0 else max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / l2))
        return math.hypot(p[0] - (a[0] + t * dx), p[1] - (a[1] + t * dy))

    keep = {0, len(pts) - 1}

    def rec(i, j):
        if j - i < 2:
            return
        best, bi = -1.0, None
        for k in range(i + 1, j):
            d = seg_d(pts[k], pts[i], pts[j])
            if d > best:
                best, bi = d, k
        if best > tol:
            keep.add(bi)
            rec(i, bi)
            rec(bi, j)
    rec(0, len(pts) - 1)
    return keep


def test_significance_equals_plain_dp(spark):
    import random
    rnd = random.Random(7)
    lines = []
    for fid in range(40):
        n = rnd.randint(3, 30)
        lines.append((fid, "LineString", [[[(rnd.randint(0, 500), rnd.randint(0, 500)) for _ in range(n)]]]))
    df = _geom_df(spark, lines)
    sig = significance(vertex_rows(df), ["fid", "part", "ring"]).collect()
    by = {}
    for r in sig:
        by.setdefault(r.fid, {})[r.seq] = r.sig
    for fid, _, parts in lines:
        pts = parts[0][0]
        for tol in (5.0, 20.0, 80.0):
            expect = _dp_reference(pts, tol)
            got = {s for s, v in by[fid].items() if v > tol}
            assert got == expect, (fid, tol)


def test_ring_never_collapses(spark):
    df = _geom_df(spark, [(1, "Polygon", [SQUARE])])
    sig = significance(vertex_rows(df), ["fid", "part", "ring"])
    kept = sig.where((F.col("sig") > 1e9) | F.col("protect")).count()
    assert kept >= 4


def test_components_path_and_star(spark):
    from gridloom.operators.components import connected_components
    n = 50
    nodes = spark.range(0, n).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 20)] + [(30, j) for j in range(31, 40)]
                                  + [(45, 44)], "u long, v long")
    lab = {r.node: r.label for r in connected_components(nodes, edges).collect()}
    assert all(lab[i] == 0 for i in range(21))
    assert all(lab[j] == 30 for j in range(30, 40))
    assert lab[44] == 44 and lab[45] == 44 and lab[49] == 49


def test_closing_fills_small_hole(spark):
    from gridloom.operators.closing import closing, rasterize
    big = [[(0, 0), (20, 0), (20, 20), (0, 20), (0, 0)], [(9, 9), (9, 11), (11, 11), (11, 9), (9, 9)]]
    df = _geom_df(spark, [(1, "Polygon", [big])])
    cells = rasterize(df, 1.0)
    assert cells.count() == 400 - 4
    closed = closing(cells, 2)
    got = {(r.cx, r.cy) for r in closed.collect()}
    assert (9, 9) in got and (10, 10) in got  # the 2x2 hole is closed
    assert len(got) == 400                    # a convex square is unchanged otherwise


def test_union_find_block(spark):
    import pandas as pd
    from gridloom.operators.cluster import _union_find
    out = _union_find(pd.DataFrame({"u": [5, 7, 9, 2], "v": [7, 9, 3, 8]}))
    lab = dict(zip(out["node"], out["label"]))
    assert lab[9] == 3 and lab[5] == 3 and lab[8] == 2


def test_multi_and_polygon_parts(shapes):
    rows = shapes.select("fid", G.to_multi("geom").alias("m"), G.polygon_parts("geom").alias("p")).collect()
    by = {r.fid: r for r in rows}
    assert by[1].m.type == "MultiPolygon" and by[5].m.type == "MultiLineString"
    assert len(by[1].p.parts) == 1 and by[5].p.type == "MultiPolygon" and len(by[5].p.parts) == 0


def test_merge_lines_orders_and_orients(spark):
    from gridloom.operators.linemerge import merge_lines
    rows = [
        (1, "k", "LineString", [[[(2, 0), (3, 0)]]]),        # third piece
        (2, "k", "LineString", [[[(1, 0), (0, 0)]]]),        # first piece, reversed
        (3, "k", "LineString", [[[(1, 0), (2, 0)]]]),        # second piece
        (4, "k", "LineString", [[[(4, 0), (3, 0)]]]),        # last piece, reversed
        (5, "c", "LineString", [[[(0, 5), (1, 5)]]]),        # a triangle cycle
        (6, "c", "LineString", [[[(1, 5), (0, 6)]]]),
        (7, "c", "LineString", [[[(0, 6), (0, 5)]]]),
    ]
    schema = T.StructType([T.StructField("fid", T.LongType()), T.StructField("key", T.StringType()),
                           T.StructField("geom", G.GEOMETRY)])
    data = [(f, k, (t, [[[(float(x), float(y)) for x, y in r] for r in p] for p in parts])) for f, k, t, parts in rows]
    df = spark.createDataFrame(data, schema)
    out = {r.key: r for r in merge_lines(df, ["key"]).collect()}
    path = [(v.x, v.y) for v in out["k"].geom.parts[0][0]]
    assert out["k"].n_lines == 4 and out["k"].chain == 1
    assert path in ([(0, 0), (1, 0), (2, 0), (3, 0), (4, 0)], [(4, 0), (3, 0), (2, 0), (1, 0), (0, 0)])
    ring = [(v.x, v.y) for v in out["c"].geom.parts[0][0]]
    assert out["c"].n_lines == 3 and len(ring) == 4 and ring[0] == ring[-1] == (0, 5)


def test_repair_cheap_faults(spark):
    from gridloom.operators.validity import repair, validity_report
    bad = [[(0, 0), (10, 0), (10, 0), (10, 10), (0, 10)]]   # repeated vertex, not closed
    tiny = [[(0, 0), (1, 0), (0, 0)]]                        # collapses to a ring under 4 vertices
    df = _geom_df(spark, [(1, "Polygon", [bad]), (2, "Polygon", [bad, tiny])])
    rep = validity_report(df).collect()
    assert all(not r.valid for r in rep)
    fixed = df.select("fid", repair("geom").alias("geom"))
    again = {r.fid: r for r in validity_report(fixed).collect()}
    assert again[1].valid and again[2].valid
    assert {r.fid: r.a for r in fixed.select("fid", G.area("geom").alias("a")).collect()} == {1: 100.0, 2: 100.0}


def test_a_chain_in_bounded_rows(spark):
    """Thirty members of three vertices, some reversed, and a cycle: rows of at most seven vertices, end to end."""
    from gridloom.operators.linemerge import merge_lines, merge_rows
    rows = []
    for i in range(30):
        v = [(float(2 * i + k), float(k % 2)) for k in range(3)]
        rows.append((100 + i, v[::-1] if i % 4 == 1 else v))
    rows += [(500 + i, [p, q]) for i, (p, q) in enumerate([((0.0, 50.0), (9.0, 50.0)), ((9.0, 50.0), (5.0, 59.0)), ((5.0, 59.0), (0.0, 50.0))])]
    df = spark.createDataFrame([(f, [{"x": x, "y": y} for x, y in v]) for f, v in rows], "fid long, v array<struct<x:double,y:double>>")
    df = df.select("fid", G.line_geom("v").alias("geom")).repartition(4)
    whole = {r.chain: [(p.x, p.y) for p in r.geom.parts[0][0]] for r in merge_lines(df.withColumn("k", F.lit(1)), ["k"]).collect()}
    got = {}
    for r in sorted(merge_rows(df, [], most=7).collect(), key=lambda r: (r.chain, r.seq)):
        v = [(p.x, p.y) for p in r.geom.parts[0][0]]
        assert 2 <= len(v) <= 7 and r.seq == len(got.get(r.chain, []))
        got.setdefault(r.chain, []).append(v)
    assert set(got) == set(whole) == {100, 500} and len(got[100]) == 10
    for chain, parts in got.items():
        assert all(a[-1] == b[0] for a, b in zip(parts, parts[1:]))
        assert parts[0] + [p for x in parts[1:] for p in x[1:]] == whole[chain]
