"""Outlines of cell sets against a plain tracer, and morphology on runs against cells."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators import closing as C
from gridloom.operators import outline as O

STEPS = [(1, 0), (0, 1), (-1, 0), (0, -1)]


def runs(cells):
    out = []
    for x, y in sorted(cells, key=lambda c: (c[1], c[0])):
        if out and out[-1][0] == y and out[-1][2] == x - 1:
            out[-1][2] = x
        else:
            out.append([y, x, x])
    return [tuple(r) for r in out]


def tracer(cells):
    """{ring's corners from its lowest left one}, with the component (4 neighbours) it bounds."""
    sides = {}
    for x, y in cells:
        for d, (ax, ay, nx, ny) in enumerate([(x, y, x, y - 1), (x + 1, y, x + 1, y), (x + 1, y + 1, x, y + 1), (x, y + 1, x - 1, y)]):
            if (nx, ny) not in cells:
                sides[ax, ay, d] = (x, y)
    component = {}
    for c in cells:
        if c not in component:
            todo, component[c] = [c], c
            while todo:
                x, y = todo.pop()
                for dx, dy in STEPS:
                    if (x + dx, y + dy) in cells and (x + dx, y + dy) not in component:
                        component[x + dx, y + dy] = c
                        todo.append((x + dx, y + dy))
    left, out = set(sides), []
    while left:
        first = e = min(left, key=lambda s: (s[1], s[0], s[2]))
        ring = []
        while True:
            left.discard(e)
            ring.append(e)
            bx, by = e[0] + STEPS[e[2]][0], e[1] + STEPS[e[2]][1]
            e = next((bx, by, (e[2] + t) % 4) for t in (1, 0, 3) if (bx, by, (e[2] + t) % 4) in sides)
            if e == first:
                break
        corners = [(s[0], s[1]) for s, b in zip(ring, [ring[-1], *ring]) if s[2] != b[2]]
        k = min(range(len(corners)), key=lambda i: (corners[i][1], corners[i][0]))
        corners = corners[k:] + corners[:k + 1]
        area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(corners, corners[1:])) / 2
        out.append((tuple(corners), area > 0, component[sides[first]]))
    return out


def shapes():
    r = random.Random(4)
    out = {f"noise{k}": {(x, y) for x in range(-9, 14) for y in range(-9, 14) if r.random() < p} for k, p in enumerate([0.2, 0.45, 0.6, 0.85])}
    out["one"] = {(0, 0)}
    out["corner"] = {(0, 0), (1, 1), (2, 0), (1, -1)}
    box = lambda a, b: {(x, y) for x in range(a, b) for y in range(a, b)}
    out["nested"] = box(0, 30) - box(3, 27) | box(6, 24) - box(9, 21) | box(12, 18)
    out["holes"] = box(0, 12) - {(x, y) for x in range(1, 11, 2) for y in range(1, 11, 3)}
    out["tall"] = {(x, y) for y in range(-700, 900) for x in range(y % 5, 9)} - {(7, y) for y in range(-300, 600)}
    out["comb"] = {(x, y) for x in range(0, 41) for y in range(250, 262) if x % 2 == 0 or y < 253}
    return out


@pytest.fixture(scope="module")
def traced(spark):
    rows = [(k, *r) for k, cells in shapes().items() for r in runs(cells)]
    df = spark.createDataFrame(rows, "fid string, cy long, c0 long, c1 long").repartition(5)
    return O.outline(df, 1.0).collect()


def test_rings_and_their_shells(traced):
    got = {}
    for r in traced:
        got.setdefault(r.fid, {})[r.ring] = (tuple((int(v.x), int(v.y)) for v in r.verts), r.shell)
    for fid, cells in shapes().items():
        want = tracer(cells)
        assert sorted(v for v, _ in got[fid].values()) == sorted(v for v, _, _ in want), fid
        shell_of = {c: v for v, shell, c in want if shell}
        for v, shell, c in want:
            mine = next(s for x, s in got[fid].values() if x == v)
            assert got[fid][mine][0] == (v if shell else shell_of[c]), (fid, v)


def test_polygons_cover_the_cells(spark, traced):
    rings = spark.createDataFrame(traced)
    areas = {r.fid: r.a for r in O.to_polygons(rings).select("fid", G.area("geom").alias("a")).collect()}
    assert areas == {k: float(len(c)) for k, c in shapes().items()}


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_closing_by_runs_equals_closing_by_cells(spark, radius):
    cells = [(k, x, y) for k, c in shapes().items() if k != "tall" for x, y in c]
    by_cells = C.closing(spark.createDataFrame(cells, "fid string, cx long, cy long"), radius)
    want = {(r.fid, r.cx, r.cy) for r in by_cells.collect()}
    rows = [(k, *r) for k, c in shapes().items() if k != "tall" for r in runs(c)]
    closed = O.closed_runs(spark.createDataFrame(rows, "fid string, cy long, c0 long, c1 long"), radius)
    got = closed.select("fid", F.explode(F.sequence("c0", "c1")).alias("cx"), "cy").collect()
    assert len(got) == len(want) and {(r.fid, r.cx, r.cy) for r in got} == want


def test_empty(spark):
    assert O.outline(spark.createDataFrame([], "fid long, cy long, c0 long, c1 long"), 2.0).collect() == []


def test_closing_shuffles_the_runs_once(spark):
    """Runs lie by blocks of rows while they are closed; at the borders of blocks the result is that of the cells."""
    r = random.Random(7)
    cells = {(x, y) for x in range(9) for y in [*range(-270, -240), *range(500, 530)] if r.random() < 0.4}
    df = spark.createDataFrame([(1, *x) for x in runs(cells)], "fid long, cy long, c0 long, c1 long")
    closed = O.closed_runs(df, 2, tasks=3)
    assert closed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = C.closing(spark.createDataFrame([(1, x, y) for x, y in cells], "fid long, cx long, cy long"), 2)
    got = closed.select("fid", F.explode(F.sequence("c0", "c1")).alias("cx"), "cy")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("fid", "cx", "cy").collect()))


def test_simplified_lines_equal_rebuilt_vertex_rows(spark):
    """Copies of a feature and features of several rings come out as from vertex rows, with one shuffle instead of one a level."""
    from gridloom.operators.simplify import rebuild, significance_of_lines, simplified_lines
    r = random.Random(3)
    line = lambda n: [{"x": float(r.randrange(50)), "y": float(r.randrange(50))} for _ in range(n)]
    ring = lambda n: (lambda v: v + v[:1])(line(n))
    rows = [(k % 9 or None, "Polygon", [[ring(12), ring(7)], [ring(20)]][:1 + k % 2]) for k in range(30)]
    df = spark.createDataFrame(rows, "fid long, type string, parts array<array<array<struct<x:double,y:double>>>>")
    df = df.select("fid", G.make_geom("Polygon", "parts").alias("geom")).repartition(3)
    made = simplified_lines(df, 10.0)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = rebuild(significance_of_lines(df), ["fid", "part", "ring"], 10.0)
    assert sorted(map(str, made.collect())) == sorted(map(str, want.collect()))
