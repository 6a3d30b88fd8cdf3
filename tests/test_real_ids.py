"""Cases of every real map: ids that nodes and ways share, repeated members, lines of several parts, NULL keys, long lines."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from gridloom.functions import geometry as G

GEOM = "struct<type:string,parts:array<array<array<struct<x:double,y:double>>>>>"


def line_frame(spark, rows, keys):
    """rows: (keys..., fid, [part, ...]) with parts as lists of (x, y)."""
    schema = ", ".join(f"{k} string" for k in keys) + ", fid long, parts array<array<array<struct<x:double,y:double>>>>"
    data = [(*r[:-1], [[[(float(x), float(y)) for x, y in part]] for part in r[-1]]) for r in rows]
    df = spark.createDataFrame(data, schema)
    return df.select(*keys, "fid", G.make_geom("LineString", "parts").alias("geom"))


def test_clusters_of_points_that_share_an_id(spark):
    from gridloom.operators.cluster import FIRST_OF, cluster_points
    rows = [(1, 0.0, 0.0, "node"), (1, 1000.0, 1000.0, "way"), (2, 1010.0, 1000.0, "x"), (1, 0.0, 0.0, "node")]
    df = spark.createDataFrame(rows, "osm_id long, x double, y double, name string")
    df = df.withColumns({"class": F.lit("c"), "subclass": F.lit("s")} | {c: F.lit(None).cast("string") for c in FIRST_OF})
    got = sorted((r.id, r["count"], r.x, r.y, r.name) for r in cluster_points(df, 80.0).collect())
    assert got == [(1, 2, 0.0, 0.0, "node"), (1, 2, 1005.0, 1000.0, "way")]


def test_repeated_member_counts_once(spark):
    from gridloom.operators.linemerge import merge_chains, merge_lines
    rows = [("A", "n", 5, [[(0, 0), (1, 0)]])] * 2 + [("A", "n", 6, [[(1, 0), (3, 0)]])]
    df = line_frame(spark, rows, ["ref", "name"])
    assert [(r.chain, r.n_lines, r.length) for r in merge_chains(df, ["ref", "name"]).collect()] == [(5, 2, 3.0)]
    (r,) = merge_lines(df, ["ref", "name"]).collect()
    assert (r.chain, r.n_lines) == (5, 2) and [tuple(v) for v in r.geom.parts[0][0]] == [(0, 0), (1, 0), (3, 0)]


def test_parts_and_null_keys(spark):
    from gridloom.operators.linemerge import merge_chains, merge_lines
    rows = [(None, "A", 5, [[(0, 0), (1, 0)], [(1, 0), (2, 0)]]), ("A", None, 5, [[(0, 0), (4, 0)]]), ("A", None, 6, [[(9, 9), (9, 10)]])]
    df = line_frame(spark, rows, ["ref", "name"])
    got = sorted(((r.ref, r.name, r.chain, r.n_lines, r.length) for r in merge_chains(df, ["ref", "name"]).collect()), key=str)
    assert got == sorted([(None, "A", 5, 1, 2.0), ("A", None, 5, 1, 4.0), ("A", None, 6, 1, 1.0)], key=str)
    got = sorted(((r.ref, r.name, r.chain, len(r.geom.parts[0][0])) for r in merge_lines(df, ["ref", "name"]).collect()), key=str)
    assert got == sorted([(None, "A", 5, 3), ("A", None, 5, 2), ("A", None, 6, 2)], key=str)


def plain_significance(xs, ys):
    sig = [math.inf] * len(xs)
    stack = [(0, len(xs) - 1, math.inf)]
    while stack:
        a, b, parent = stack.pop()
        if b - a < 2:
            continue
        dx, dy = xs[b] - xs[a], ys[b] - ys[a]
        l2 = dx * dx + dy * dy
        best, at = -1.0, a + 1
        for k in range(a + 1, b):
            t = 0.0 if l2 == 0 else min(1.0, max(0.0, ((xs[k] - xs[a]) * dx + (ys[k] - ys[a]) * dy) / l2))
            px, py = xs[a] + t * dx, ys[a] + t * dy
            d = math.sqrt((xs[k] - px) * (xs[k] - px) + (ys[k] - py) * (ys[k] - py))
            if d > best:
                best, at = d, k
        sig[at] = min(best, parent)
        stack += [(a, at, sig[at]), (at, b, sig[at])]
    return sig


def test_lines_of_every_length_take_one_path(spark):
    from gridloom.operators.simplify import split_tree, with_significance
    r = random.Random(4)
    lines = []
    for n in (2, 3, 5, 10, 500, 6000):
        x = y = 0.0
        pts = []
        for _ in range(n):
            x, y = x + r.uniform(-1, 3), y + r.uniform(-2, 2)
            pts.append((x, y))
        lines.append(pts)
    lines.append([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (2.0, 2.0), (1.0, 2.0), (0.0, 2.0), (0.0, 0.0)])  # a ring with collinear vertices
    df = spark.createDataFrame([(i, p) for i, p in enumerate(lines)], "fid long, _r array<struct<x:double,y:double>>")
    for row in with_significance(df).collect():
        xs, ys = zip(*lines[row.fid])
        assert row._sig == plain_significance(xs, ys)
        assert len(row._prot) == (2 if row.fid == len(lines) - 1 else 0)
    n = 1_000_000
    t = np.linspace(0, 40, n)
    sig = split_tree(t, np.sin(t) + 0.01 * np.sin(900 * t), np.array([0, n]))
    assert np.isinf(sig).sum() == 2 and np.isfinite(sig[1:-1]).all()


def test_full_detail_keeps_collinear_vertices(spark):
    from gridloom.operators.ladder import Rung, ladder_rings
    df = line_frame(spark, [("k", 1, [[(0, 0), (1, 0), (2, 0), (2, 2), (0, 2), (0, 0)]])], ["k"])
    got = {r.gen: len(r.verts) for r in ladder_rings(df, [Rung(0, -1.0), Rung(1, 0.5)]).collect()}
    assert got == {0: 6, 1: 5}


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest

    from gridloom.session import ensure_checkpoint_dir

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda k, d=None: d)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)
