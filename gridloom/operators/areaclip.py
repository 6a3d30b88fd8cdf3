"""Areas cut down the tile pyramid.

An area starts at the deepest zoom at which one tile holds it and is cut into the
four children of its tile again and again, so a vertex is handled once a level and not once for each tile.
A cut leaves real polygons behind: where a ring crosses the line, the way goes on along the line to the crossing
at which it comes back, so a ring that falls apart gives several, and a hole that is cut open becomes part of its shell.
All areas of a batch are cut at the same time, each at its own line, as arrays.

Tiles may be widened by a buffer, a share of their width; a child's widened box lies inside its
parent's. Between zooms the rows are dealt out by tile again, so a huge area spreads over the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import geometry as G
from gridloom.functions.tiles import TILE_EXTENT

WORLD = G.WORLD_EDGE
CHUNK = 4096  # areas cut at the same time


@dataclass
class Areas:
    """Rings end to end, without their closing vertex: ``start`` of each ring (one more than rings), ``of``: its area."""

    x: np.ndarray
    y: np.ndarray
    start: np.ndarray
    of: np.ndarray
    n: int

    def take(self, keep: np.ndarray) -> "Areas":
        """The areas with these numbers, ascending, renumbered from 0."""
        new = np.full(self.n, -1)
        new[keep] = np.arange(len(keep))
        rings = np.flatnonzero(new[self.of] >= 0)
        size = np.diff(self.start)
        inside = np.repeat(new[self.of] >= 0, size)
        return Areas(self.x[inside], self.y[inside], np.concatenate([[0], np.cumsum(size[rings])]), new[self.of[rings]], len(keep))


def ring_areas(a: Areas) -> np.ndarray:
    """Signed area of each ring."""
    if not len(a.of):
        return np.empty(0)
    nxt = _next(a.start)
    # about the ring's first vertex, which loses fewer digits
    x0, y0 = np.repeat(a.x[a.start[:-1]], np.diff(a.start)), np.repeat(a.y[a.start[:-1]], np.diff(a.start))
    cross = (a.x - x0) * (a.y[nxt] - y0) - (a.x[nxt] - x0) * (a.y - y0)
    return np.add.reduceat(cross, a.start[:-1]) / 2.0


def _next(start: np.ndarray) -> np.ndarray:
    nxt = np.arange(1, start[-1] + 1)
    nxt[start[1:] - 1] = start[:-1]
    return nxt


def cleaned(a: Areas) -> Areas:
    """Without repeated vertices and rings that have no area."""
    if not len(a.of):
        return a
    nxt = _next(a.start)
    keep = (a.x != a.x[nxt]) | (a.y != a.y[nxt])
    size = np.add.reduceat(keep.astype(np.int64), a.start[:-1])
    x, y = a.x[keep], a.y[keep]
    real = size > 0
    b = Areas(x, y, np.concatenate([[0], np.cumsum(size[real])]), a.of[real], a.n)
    flat = ring_areas(b) != 0
    inside = np.repeat(flat, np.diff(b.start))
    return Areas(b.x[inside], b.y[inside], np.concatenate([[0], np.cumsum(np.diff(b.start)[flat])]), b.of[flat], a.n)


def oriented(a: Areas, hole: np.ndarray) -> Areas:
    """Shells counter-clockwise, holes clockwise."""
    turn = (ring_areas(a) < 0) != hole
    size = np.diff(a.start)
    first, last = np.repeat(a.start[:-1], size), np.repeat(a.start[1:] - 1, size)
    at = np.arange(len(a.x))
    at = np.where(np.repeat(turn, size), first + last - at, at)
    return Areas(a.x[at], a.y[at], a.start, a.of, a.n)


def clip(a: Areas, line: np.ndarray, axis: int, low: bool) -> Areas:
    """The part of every area at or below (``low``) or above its line; areas keep their numbers, some end without rings."""
    if not len(a.of):
        return a
    p, q = (a.x, a.y) if axis == 0 else (a.y, a.x)
    size = np.diff(a.start)
    owner = np.repeat(a.of, size)
    c = line[owner]
    inside = p <= c if low else p >= c
    nxt = _next(a.start)
    cross = np.flatnonzero(inside != inside[nxt])
    if not len(cross):
        keep = inside[a.start[:-1]]
        rings = np.repeat(keep, size)
        return Areas(a.x[rings], a.y[rings], np.concatenate([[0], np.cumsum(size[keep])]), a.of[keep], a.n)
    # nodes: vertices inside and crossings, in ring order
    i, j = cross, nxt[cross]
    share = (c[i] - p[i]) / (p[j] - p[i])
    at_q = q[i] + share * (q[j] - q[i])
    own = np.flatnonzero(inside)
    key = np.concatenate([2 * own, 2 * cross + 1])
    by = np.argsort(key, kind="stable")
    node_p, node_q = np.concatenate([p[own], c[cross]])[by], np.concatenate([q[own], at_q])[by]
    n = len(key)
    place = np.empty(n, np.int64)
    place[by] = np.arange(n)
    of_vertex = np.full(len(p), -1)
    of_vertex[own] = place[: len(own)]
    of_cross = place[len(own):]
    succ = np.full(n, -1)
    # from a vertex to the crossing behind it, or to the next vertex; from a crossing that enters to the vertex behind it
    ahead = np.full(len(p), -1)
    ahead[cross] = of_cross
    succ[of_vertex[own]] = np.where(ahead[own] >= 0, ahead[own], of_vertex[nxt[own]])
    enters = inside[nxt[cross]]
    succ[of_cross[enters]] = of_vertex[nxt[cross[enters]]]
    # along the line, the k-th way out of an area leads to its k-th way in
    def sorted_ones(which):
        return np.flatnonzero(which)[np.lexsort((at_q[which], owner[cross][which]))]
    leaving, entering = sorted_ones(~enters), sorted_ones(enters)
    succ[of_cross[leaving]] = of_cross[entering]
    # rings of the permutation, each from its first node on
    least, to = np.arange(n), succ.copy()
    for _ in range(max(1, n.bit_length())):
        least = np.minimum(least, least[to])
        to = to[to]
    back = succ.copy()
    heads = np.flatnonzero(least == np.arange(n))
    cut = np.isin(back, heads)
    steps, to = np.where(cut, 0, 1), np.where(cut, np.arange(n), succ)
    for _ in range(max(1, n.bit_length())):
        steps = steps + np.where(to == np.arange(n), 0, steps[to])
        to = to[to]
    order = np.lexsort((-steps, least))
    ring = least[order]
    start = np.append(np.flatnonzero(np.concatenate([[True], ring[1:] != ring[:-1]])), n)
    node_owner = np.concatenate([owner[own], owner[cross]])[by]
    x, y = (node_p, node_q) if axis == 0 else (node_q, node_p)
    return cleaned(Areas(x[order], y[order], start, node_owner[order][start[:-1]], a.n))


def children(a: Areas, z: int, x: np.ndarray, y: np.ndarray, buffer: float):
    """(areas, x, y) of the four children of each area's tile (z, x, y)."""
    size = 2.0 * WORLD / (1 << (z + 1))
    b = size * buffer
    mid_x = -WORLD + (2 * x + 1) * size
    mid_y = WORLD - (2 * y + 1) * size
    # the parent's buffer is twice as wide, so its outer sides are cut again
    for dx in (0, 1):
        half = clip(a, mid_x + b if dx == 0 else mid_x - b, 0, dx == 0)
        if buffer:
            half = clip(half, mid_x + (2 * dx - 1) * (size + b), 0, dx == 1)
        for dy in (0, 1):  # y grows south
            part = clip(half, mid_y - b if dy == 0 else mid_y + b, 1, dy == 1)
            if buffer:
                part = clip(part, mid_y + (1 - 2 * dy) * (size + b), 1, dy == 0)
            there = np.unique(part.of)
            yield part.take(there), there, 2 * x[there] + dx, 2 * y[there] + dy


def _read(batch: pa.RecordBatch) -> Areas:
    """Areas of a column ``parts``, one for each row."""
    parts = batch.column("parts")
    rings = parts.flatten()
    verts = rings.flatten()
    points = verts.flatten()
    part_of = np.repeat(np.arange(len(parts)), parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    ring_n = rings.value_lengths().to_numpy(zero_copy_only=False)
    of = np.repeat(part_of, ring_n)
    place = np.arange(len(of)) - np.repeat(np.cumsum(ring_n) - ring_n, ring_n)
    size = verts.value_lengths().to_numpy(zero_copy_only=False)
    start = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    x, y = (points.field(k).to_numpy(zero_copy_only=False) for k in ("x", "y"))
    # the closing vertex goes, and rings too short to have an area
    keep = np.ones(len(x), bool)
    keep[start[1:][size > 0] - 1] = False
    left = np.maximum(size - 1, 0)
    real = left >= 3
    keep &= np.repeat(real, size)
    a = Areas(x[keep], y[keep], np.concatenate([[0], np.cumsum(left[real])]).astype(np.int64), of[real], len(parts))
    if not len(a.of):
        return a
    return cleaned(oriented(a, place[real] > 0))


def _nest(a: Areas, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of rings, whether a ring begins a part): every shell with the holes inside it behind it."""
    area = ring_areas(a)
    hole = area < 0
    shell = np.where(hole, -1, np.arange(len(area)))
    shells = np.bincount(a.of[~hole], minlength=a.n)
    only = np.full(a.n, -1)
    only[a.of[~hole]] = np.flatnonzero(~hole)
    one = hole & (shells[a.of] == 1)
    shell[one] = only[a.of[one]]
    for h in np.flatnonzero(hole & (shells[a.of] > 1)).tolist():  # few: areas in several pieces with whole holes left
        at = slice(a.start[h], a.start[h + 1])
        hy = np.unique(a.y[at])
        hy = (hy[0] + hy[1]) / 2
        hx = _crossings(a, h, hy).min()
        best = None
        for s in np.flatnonzero(~hole & (a.of == a.of[h])).tolist():
            if np.count_nonzero(_crossings(a, s, hy) < hx) % 2 and (best is None or area[s] < area[best]):
                best = s
        shell[h] = -1 if best is None else best
    order = np.lexsort((np.arange(len(area)), hole, shell, a.of))
    order = order[shell[order] >= 0]
    return order, ~hole[order]


def _crossings(a: Areas, ring: int, y: float) -> np.ndarray:
    at = slice(a.start[ring], a.start[ring + 1])
    x0, y0 = a.x[at], a.y[at]
    x1, y1 = np.roll(x0, -1), np.roll(y0, -1)
    i = np.flatnonzero((y0 > y) != (y1 > y))
    return x0[i] + (y - y0[i]) * (x1[i] - x0[i]) / (y1[i] - y0[i])


def _geometry(a: Areas) -> pa.Array:
    """``parts`` of each area, rings closed."""
    order, begins = _nest(a, a.x, a.y)
    size = np.diff(a.start)[order]
    at = np.repeat(a.start[order], size + 1) + np.arange(int((size + 1).sum())) - np.repeat(np.cumsum(size + 1) - (size + 1), size + 1)
    ends = np.cumsum(size + 1) - 1
    at[ends] = a.start[order]
    points = pa.StructArray.from_arrays([pa.array(a.x[at]), pa.array(a.y[at])], names=["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int32)), points)
    heads = np.append(np.flatnonzero(begins), len(order)).astype(np.int32)
    parts = pa.ListArray.from_arrays(pa.array(heads if len(heads) > 1 else np.zeros(1, np.int32)), rings)
    first = np.searchsorted(a.of[order][heads[:-1]], np.arange(a.n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(first), parts)


def _descend(a: Areas, rows: np.ndarray, z: int, x: np.ndarray, y: np.ndarray, z_from: int, z_to: int, buffer: float):
    """(rows, z, x, y, areas) of all tiles from ``z_from`` to ``z_to``, in pieces of bounded size, deepest first."""
    todo = [(a, rows, z, x, y)]
    while todo:
        a, rows, z, x, y = todo.pop()
        if not a.n:
            continue
        if a.n > CHUNK:
            for lo in range(0, a.n, CHUNK):
                own = np.arange(lo, min(lo + CHUNK, a.n))
                todo.append((a.take(own), rows[own], z, x[own], y[own]))
            continue
        if z >= z_from:
            yield rows, z, x, y, a
        if z < z_to:
            for part, there, cx, cy in children(a, z, x, y, buffer):
                todo.append((part, rows[there], z + 1, cx, cy))


def _first_tiles(a: Areas, z_most: int, buffer: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The deepest tile up to ``z_most`` that alone meets each area, buffer included."""
    z, tx, ty = np.zeros(a.n, np.int64), np.zeros(a.n, np.int64), np.zeros(a.n, np.int64)
    if not len(a.of):
        return z, tx, ty
    size = np.diff(a.start)
    low = lambda v: np.minimum.reduceat(v, a.start[:-1])
    box = np.full((4, a.n), np.inf)
    for k, v in enumerate((a.x, -a.x, a.y, -a.y)):
        np.minimum.at(box[k], a.of, low(v))
    left, right, bottom, top = box[0], -box[1], box[2], -box[3]
    there = np.isfinite(left)
    open_ = there & (size.size > 0)
    for zoom in range(1, z_most + 1):
        s = 2.0 * WORLD / (1 << zoom)
        b = s * buffer
        with np.errstate(invalid="ignore"):
            x0, x1 = np.floor((left - b + WORLD) / s), np.floor((right + b + WORLD) / s)
            y0, y1 = np.floor((WORLD - top - b) / s), np.floor((WORLD - bottom + b) / s)
        last = (1 << zoom) - 1
        x0, x1, y0, y1 = (np.clip(np.nan_to_num(v), 0, last).astype(np.int64) for v in (x0, x1, y0, y1))
        open_ &= (x0 == x1) & (y0 == y1)
        z[open_], tx[open_], ty[open_] = zoom, x0[open_], y0[open_]
    return z, tx, ty


def cut_down(areas: DataFrame, z_from: int, z_to: int, buffer: float = 0.0) -> DataFrame:
    """Rows with ``parts`` (polygons), and z, x, y if they were cut before -> the same rows for every tile of the zooms that they meet.

    ``parts`` is the polygon inside the widened tile, in units of the map. An area without extent inside a tile isn't there.
    """
    cut = {"z", "x", "y"} <= set(areas.columns)
    keys = [c for c in areas.columns if c not in ("parts", "z", "x", "y")]
    schema = T.StructType([*(areas.schema[c] for c in keys), T.StructField("z", T.IntegerType()), T.StructField("x", T.LongType()),
                           T.StructField("y", T.LongType()), T.StructField("parts", T.ArrayType(T.ArrayType(G.RING)))])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                own = batch.slice(lo, CHUNK)
                a = _read(own)
                if cut:
                    z, x, y = (own.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("z", "x", "y"))
                else:
                    z, x, y = _first_tiles(a, z_from, buffer)
                alive = np.unique(a.of)
                for zoom in np.unique(z[alive]).tolist():
                    rows = alive[z[alive] == zoom]
                    for at, zz, xx, yy, part in _descend(a.take(rows), rows, zoom, x[rows], y[rows], z_from, z_to, buffer):
                        table = pa.Table.from_batches([own]).select(keys).take(pa.array(at)).combine_chunks()
                        cols = [table.column(k).combine_chunks() for k in keys]
                        yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(at), zz, np.int32)), pa.array(xx), pa.array(yy), _geometry(part)], names=schema.names)

    names = [*keys, "parts"] + (["z", "x", "y"] if cut else [])
    return areas.select(*names).mapInArrow(run, schema)


STEP = 4  # zooms between which rows are dealt out again


def tile_areas(areas: DataFrame, z_from: int, z_to: int, buffer: float = 0.0) -> DataFrame:
    """Like :func:`cut_down`, by steps of some zooms: each deals its deepest tiles out over the cluster for the next one."""
    out, low = None, z_from
    while True:
        high = min(low + STEP - 1, z_to)
        made = cut_down(areas, low, high, buffer)
        out = made if out is None else out.unionByName(made)
        if high == z_to:
            return out
        areas = cut_down(areas, high, high, buffer).repartition("z", "x", "y")
        low = high + 1


def to_tile_units(parts: str | Column = "parts", extent: int = TILE_EXTENT) -> Column:
    """Polygons of a row with z, x, y in the tile's integer coordinates (y grows south); rings without area there go, and parts without a shell."""
    p = F.col(parts) if isinstance(parts, str) else parts
    size = F.lit(2.0 * WORLD) / F.pow(F.lit(2.0), F.col("z"))
    left, top = F.lit(-WORLD) + F.col("x") * size, F.lit(WORLD) - F.col("y") * size

    def point(v):
        return F.struct(F.floor((v["x"] - left) / size * extent + 0.5).cast("int").alias("x"),
                        F.floor((top - v["y"]) / size * extent + 0.5).cast("int").alias("y"))

    def ring(r):
        return F.transform(r, point)

    def distinct(r):
        return F.filter(r, lambda v, i: (i == 0) | (v != F.get(r, i - 1)))

    whole = F.transform(p, lambda part: F.filter(F.transform(F.transform(part, ring), distinct), lambda r: twice_area(r) != 0))
    return F.filter(F.zip_with(whole, p, lambda w, part: F.when(F.size(w) > 0, w)), lambda w: w.isNotNull())


def twice_area(ring: Column) -> Column:
    """Twice the signed area of a ring in whole units."""
    return F.aggregate(G._legs(ring, lambda a, b: a["x"].cast("bigint") * b["y"] - b["x"].cast("bigint") * a["y"]), F.lit(0).cast("bigint"), lambda s, v: s + v)


# ---------------------------------------------------------------- J6

def cut_by_grid(areas: DataFrame, side: str) -> DataFrame:
    """Rows with ``parts`` -> the same rows for every square (gx, gy) that they meet; column ``side`` has the squares' width, from (0, 0) on.

    An area is halved at the middle line of the squares it meets until each piece has one, first across, then up.
    """
    keys = [c for c in areas.columns if c != "parts"]
    schema = T.StructType([*(areas.schema[c] for c in keys), T.StructField("gx", T.LongType()), T.StructField("gy", T.LongType()),
                           T.StructField("parts", T.ArrayType(T.ArrayType(G.RING)))])

    def span(a: Areas, v: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last square of each area on one axis."""
        low, high = np.full(a.n, np.inf), np.full(a.n, -np.inf)
        np.minimum.at(low, a.of, np.minimum.reduceat(v, a.start[:-1]))
        np.maximum.at(high, a.of, np.maximum.reduceat(v, a.start[:-1]))
        return np.floor(low / size).astype(np.int64), np.maximum(np.ceil(high / size).astype(np.int64) - 1, np.floor(low / size).astype(np.int64))

    def halved(a: Areas, rows: np.ndarray, sides: np.ndarray, axis: int):
        # the squares that each piece may have, so that rounding at a line can't bring one back
        todo = [(a, rows, np.full(a.n, -1 << 60), np.full(a.n, 1 << 60))]
        while todo:
            a, rows, least, most = todo.pop()
            there = np.unique(a.of)
            a, rows, least, most = a.take(there), rows[there], least[there], most[there]
            if not a.n:
                continue
            size = sides[rows]
            first, last = span(a, a.x if axis == 0 else a.y, size)
            first = np.clip(first, least, most)
            last = np.clip(last, first, most)
            one = np.flatnonzero(first == last)
            if len(one):
                yield a.take(one), rows[one], first[one]
            more = np.flatnonzero(first < last)
            if len(more):
                wide, middle = a.take(more), (first[more] + last[more] + 1) // 2
                line = middle * size[more]
                todo.append((clip(wide, line, axis, True), rows[more], first[more], middle - 1))
                todo.append((clip(wide, line, axis, False), rows[more], middle, last[more]))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                own = batch.slice(lo, CHUNK)
                sides = own.column(side).to_numpy(zero_copy_only=False).astype(np.float64)
                for column, rows, gx in halved(_read(own), np.arange(own.num_rows), sides, 0):
                    for part, at, gy in halved(column, np.arange(column.n), sides[rows], 1):
                        table = pa.Table.from_batches([own]).select(keys).take(pa.array(rows[at])).combine_chunks()
                        cols = [table.column(k).combine_chunks() for k in keys]
                        yield pa.RecordBatch.from_arrays([*cols, pa.array(gx[at]), pa.array(gy), _geometry(part)], names=schema.names)

    return areas.select(*keys, "parts").mapInArrow(run, schema)


# ---------------------------------------------------------------- S6

def clip_lines(a: Areas, line: float, axis: int, low: bool) -> Areas:
    """The parts of open lines at or below (``low``) or above a line; a line that leaves and comes back has several."""
    p, q = (a.x, a.y) if axis == 0 else (a.y, a.x)
    inside = p <= line if low else p >= line
    last = np.zeros(len(p), bool)
    last[a.start[1:] - 1] = True
    i = np.flatnonzero((inside[:-1] != inside[1:]) & ~last[:-1])
    at_q = q[i] + (line - p[i]) / (p[i + 1] - p[i]) * (q[i + 1] - q[i])
    own = np.flatnonzero(inside)
    key = np.concatenate([2 * own, 2 * i + 1])
    by = np.argsort(key)
    node_p, node_q = np.concatenate([p[own], np.full(len(i), line)])[by], np.concatenate([q[own], at_q])[by]
    first = np.zeros(len(p), bool)
    first[a.start[:-1]] = True
    begins = np.concatenate([first[own], inside[i + 1]])[by]  # a line's first vertex, or a crossing into the box
    owner = np.repeat(a.of, np.diff(a.start))
    start = np.append(np.flatnonzero(begins), len(begins))
    of = np.concatenate([owner[own], owner[i]])[by][start[:-1]]
    size = np.diff(start)
    keep = size > 1
    x, y = (node_p, node_q) if axis == 0 else (node_q, node_p)
    rows = np.repeat(keep, size)
    return Areas(x[rows], y[rows], np.concatenate([[0], np.cumsum(size[keep])]), of[keep], a.n)


def _open_geometry(a: Areas) -> pa.Array:
    """``parts`` of lines or points: every one a part of its own."""
    order = np.argsort(a.of, kind="stable")
    size = np.diff(a.start)[order]
    at = np.repeat(a.start[:-1][order], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    points = pa.StructArray.from_arrays([pa.array(a.x[at]), pa.array(a.y[at])], names=["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), points)
    parts = pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1, dtype=np.int32)), rings)
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(a.of[order], np.arange(a.n + 1)).astype(np.int32)), parts)


def _all_rings(parts: pa.Array) -> Areas:
    rings = parts.flatten()
    verts = rings.flatten()
    points = verts.flatten()
    of = np.repeat(np.repeat(np.arange(len(parts)), parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), rings.value_lengths().to_numpy(zero_copy_only=False))
    size = verts.value_lengths().to_numpy(zero_copy_only=False)
    x, y = (points.field(k).to_numpy(zero_copy_only=False) for k in ("x", "y"))
    real = size > 0
    return Areas(x, y, np.concatenate([[0], np.cumsum(size[real])]).astype(np.int64), of[real], len(parts))


_SINGLE = {"MultiPoint": "Point", "MultiLineString": "LineString", "MultiPolygon": "Polygon"}


def clip_to_box(features: DataFrame, box: tuple[float, float, float, float], geom: str = "geom") -> DataFrame:
    """Features cut at a box (xmin, ymin, xmax, ymax), their other columns as they are.

    Points outside go; lines are cut where they cross, into several parts if they come back; areas are closed along the box. A
    geometry in several parts gets the type for them, one of which nothing is left goes with its row. Geometries inside the box, null
    ones and other types stay untouched.
    """
    lines = ((box[0], 0, False), (box[2], 0, True), (box[1], 1, False), (box[3], 1, True))

    def cut(batch: pa.RecordBatch, rows: np.ndarray, kind: str) -> pa.Array:
        own = batch.take(pa.array(rows))
        parts = own.column("_parts")
        if kind == "Polygon":
            a = _read(pa.RecordBatch.from_arrays([parts], names=["parts"]))
            for at, axis, low in lines:
                a = clip(a, np.full(a.n, at), axis, low)
            return _geometry(a)
        a = _all_rings(parts)
        if kind == "LineString":
            for at, axis, low in lines:
                a = clip_lines(a, at, axis, low)
            return _open_geometry(a)
        there = (a.x >= box[0]) & (a.x <= box[2]) & (a.y >= box[1]) & (a.y <= box[3])
        owner = np.repeat(a.of, np.diff(a.start))[there]
        return _open_geometry(Areas(a.x[there], a.y[there], np.arange(len(owner) + 1), owner, a.n))

    names = features.columns

    def run(batches):
        for batch in batches:
            g = batch.column(geom)
            parts = g.field("parts") if g.null_count == 0 else pa.compute.struct_field(g, "parts")
            kinds = [_SINGLE.get(k, k) for k in pa.compute.struct_field(g, "type").to_pylist()]
            a = _all_rings(parts)
            outside = (a.x < box[0]) | (a.x > box[2]) | (a.y < box[1]) | (a.y > box[3])
            met = np.zeros(batch.num_rows, bool)
            met[np.repeat(a.of, np.diff(a.start))[outside]] = True
            pieces, places = [parts], np.arange(batch.num_rows)
            size = batch.num_rows
            own = pa.RecordBatch.from_arrays([parts], names=["_parts"])
            for kind in ("Point", "LineString", "Polygon"):
                rows = np.array([i for i in np.flatnonzero(met).tolist() if kinds[i] == kind], np.int64)
                if len(rows):
                    pieces.append(cut(own, rows, kind).cast(parts.type))
                    places[rows] = size + np.arange(len(rows))
                    size += len(rows)
            made = pa.concat_arrays(pieces).take(pa.array(places))
            n = made.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            types = [None if k is None else "Multi" + k if met[i] and n[i] > 1 and k in _SINGLE.values() else k if met[i] else old
                     for i, (k, old) in enumerate(zip(kinds, pa.compute.struct_field(g, "type").to_pylist(), strict=True))]
            geoms = pa.StructArray.from_arrays([pa.array(types, pa.string()), made], names=["type", "parts"], mask=pa.compute.is_null(g) if g.null_count else None)
            cols = [geoms if c == geom else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(~met | (n > 0)))

    return features.mapInArrow(run, features.schema)
