"""Segments of lines in tiles, against a plain loop over all tiles around a line."""

import math
import random

from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.functions.tiles import explode_blocks, tile_segments
from gridloom.operators.ladder import Rung
from gridloom.plans import catalog  # noqa: F401  (imports the plan modules in their order)
from gridloom.plans.q_serve import road_segments

W, BUF = G.WORLD_EDGE, 0.0625


def plain(z, verts):
    """(x, y, seq, x1, y1, x2, y2) of the line."""
    s, n, out = 2.0 * W / 2 ** z, 2 ** z, []
    xs, ys = [x for x, _ in verts if x is not None], [y for _, y in verts if y is not None]
    if not xs or not ys:
        return out
    lo = max(0, math.floor((min(xs) + W) / s) - 1), max(0, math.floor((W - max(ys)) / s) - 1)
    hi = min(n - 1, math.floor((max(xs) + W) / s) + 1), min(n - 1, math.floor((W - min(ys)) / s) + 1)
    b = s * BUF
    for x in range(lo[0], hi[0] + 1):
        for y in range(lo[1], hi[1] + 1):
            tx, ty = -W + x * s, W - y * s
            box = ((tx - b, tx + s + b), (ty - s - b, ty + b))
            if max(xs) < box[0][0] or min(xs) > box[0][1] or max(ys) < box[1][0] or min(ys) > box[1][1]:
                continue
            for seq, (a, e) in enumerate(zip(verts, verts[1:])):
                t0, t1 = 0.0, 1.0
                for k in (0, 1):
                    d = None if a[k] is None or e[k] is None else e[k] - a[k]
                    if d:
                        first, last = (box[k][0] - a[k]) / d, (box[k][1] - a[k]) / d
                        t0, t1 = max(t0, min(first, last)), min(t1, max(first, last))
                    elif a[k] is not None and not box[k][0] <= a[k] <= box[k][1]:
                        t0 = 2.0
                if t0 > t1:
                    continue
                row = []
                for t in (t0, t1):
                    for k in (0, 1):
                        d = None if a[k] is None or e[k] is None else e[k] - a[k]
                        v = None if d is None else (a[k] + t * d - tx if k == 0 else ty - (a[k] + t * d)) / s * 4096
                        row.append(None if v is None else math.floor(v + 0.5))
                out.append((x, y, seq, *row))
    return out


def test_segments_of_random_lines(spark):
    r = random.Random(5)
    lines = []
    for k in range(200):
        span = r.choice([5, 700, 9000])
        x, y = r.randint(-20000, 20000), r.randint(-20000, 20000)
        lines.append((k, r.randint(8, 16), [(float(x + r.randint(0, span)), float(y + r.randint(0, span))) for _ in range(r.randint(0, 9))]))
    lines += [(300, 14, [(0.0, 0.0), (0.0, 0.0), (5000.0, 0.0), (5000.0, -4000.0)]), (301, 12, None), (302, 13, [(None, 5.0), (None, None)]),
              (303, 13, [(1.0, 5.0), (None, 9.0), (9000.0, None), (9000.0, 9000.0)]), (304, 3, [(-W, -W), (W, W)]), (304, 3, [(-W, -W), (W, W)])]
    df = spark.createDataFrame([(k, z, None if v is None else [(0, *p) for p in v]) for k, z, v in lines],
                               "fid long, z int, verts array<struct<id: int, x: double, y: double>>")
    want = sorted(((k, z, *row) for k, z, v in lines if v is not None for row in plain(z, v)), key=str)
    got = sorted((tuple(t) for t in tile_segments(df, BUF).select("fid", "z", "x", "y", "seq", "x1", "y1", "x2", "y2").collect()), key=str)
    assert got == want
    # the same, dealt out by block
    boxed = explode_blocks(df.withColumns(G.bbox(G.line_geom(F.transform("verts", lambda p: G.vertex(p["x"], p["y"]))))), F.col("z"), BUF)
    got = tile_segments(boxed.select("fid", "z", "verts", "block"), BUF, block="block")
    assert sorted((tuple(t) for t in got.select("fid", "z", "x", "y", "seq", "x1", "y1", "x2", "y2").collect()), key=str) == want


def test_segments_are_cut_together(spark):
    """F1: functions over arrays took 18 of 26 s at sf0.1; only lines that meet many blocks are dealt out, and each line's ladder is built once."""
    lines = [(1, [(0.0, 0.0), (900.0, 700.0)]), (2, [(0.0, 0.0), (300000.0, 2000.0), (300000.0, 900.0)])]
    df = spark.createDataFrame(lines, "fid long, v array<struct<x: double, y: double>>")
    base = df.select("fid", G.line_geom("v").alias("geom")).withColumn("length", G.length("geom"))
    out = road_segments(base, [Rung(0, -1.0)], [(16, 0), (9, 0)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "x1" in out.columns and "posexplode(arrays_zip" not in plan and plan.count("MapInArrow") == 3 and "4096" not in plan
    want = sorted((z, x, y, k, 0, *rest) for k, v in lines for z in (9, 16) for x, y, *rest in plain(z, v))
    assert sorted(tuple(t) for t in out.collect()) == want
