"""G14 validity report and cheap repairs.

Report per feature: repeated consecutive vertices, unclosed rings, rings
under 4 vertices, and pairs of non-adjacent edges of one ring that intersect
(touching counts). Crossings are found by a sweep over the edges sorted by their left ends, all rings of
an Arrow batch at the same time: an edge meets those that begin before it ends. Edges that meet
few others are compared step by step, one step of all of them at once; an edge that meets many (the
closing edge of a long ring) is compared with its whole run in one go, so it costs its run and not the cells of its box. Rows
with any fault can be quarantined by the caller.

Repairs (``repair``): drop repeated consecutive vertices, close open rings,
drop rings that end with fewer than 4 vertices. A full polygon repair
(re-noding crossings) is not done.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import geometry as G


FEW = 64       # edges met, up to which an edge is compared step by step
RUN = 1 << 20  # candidates compared at once


def _intersect(x0, y0, x1, y1, i, j) -> np.ndarray:
    """Whether edges i and j share a point."""
    def orient(a, cx, cy):
        return np.sign((x1[a] - x0[a]) * (cy - y0[a]) - (y1[a] - y0[a]) * (cx - x0[a]))

    o1, o2 = orient(i, x0[j], y0[j]), orient(i, x1[j], y1[j])
    o3, o4 = orient(j, x0[i], y0[i]), orient(j, x1[i], y1[i])

    def on(a, cx, cy):
        return (np.minimum(x0[a], x1[a]) <= cx) & (cx <= np.maximum(x0[a], x1[a])) & (np.minimum(y0[a], y1[a]) <= cy) & (cy <= np.maximum(y0[a], y1[a]))

    return ((o1 != o2) & (o3 != o4)) | ((o1 == 0) & on(i, x0[j], y0[j])) | ((o2 == 0) & on(i, x1[j], y1[j])) | ((o3 == 0) & on(j, x0[i], y0[i])) | ((o4 == 0) & on(j, x1[i], y1[i]))


def sweep_crossings(x: np.ndarray, y: np.ndarray, start: np.ndarray):
    """(ring, i, j) arrays of crossing, non-adjacent edges i < j of rings laid end to end (``start``: one more than rings)."""
    size = np.maximum(np.diff(start) - 1, 0)  # edges
    ring = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(ring)) - np.repeat(np.cumsum(size) - size, size)
    at = start[ring] + place
    x0, y0, x1, y1 = x[at], y[at], x[at + 1], y[at + 1]
    left, right, low, high = np.minimum(x0, x1), np.maximum(x0, x1), np.minimum(y0, y1), np.maximum(y0, y1)
    n = len(ring)
    order = np.lexsort((left, ring))
    # how many edges, rings before included, begin up to the end of each
    both = np.lexsort((np.repeat([0, 1], n), np.concatenate([left, right]), np.concatenate([ring, ring])))
    begun = np.cumsum(both < n)
    until = np.empty(n, np.int64)
    until[both[both >= n] - n] = begun[both >= n]
    span = until[order] - np.arange(n) - 1  # by place in the order

    def told(a, b):
        i, j = order[a], order[b]
        near = (low[i] <= high[j]) & (low[j] <= high[i])
        i, j = i[near], j[near]
        i, j = np.where(place[i] < place[j], i, j), np.where(place[i] < place[j], j, i)
        apart = (place[j] - place[i] != 1) & ~((place[i] == 0) & (place[j] == size[ring[i]] - 1))
        i, j = i[apart], j[apart]
        hit = _intersect(x0, y0, x1, y1, i, j)
        return ring[i[hit]], place[i[hit]], place[j[hit]]

    few = np.flatnonzero((span > 0) & (span <= FEW))
    for k in range(1, FEW + 1):
        few = few[span[few] >= k]
        if not len(few):
            break
        for lo in range(0, len(few), RUN):
            yield told(few[lo:lo + RUN], few[lo:lo + RUN] + k)
    for a in np.flatnonzero(span > FEW).tolist():
        for lo in range(a + 1, a + 1 + int(span[a]), RUN):
            b = np.arange(lo, min(lo + RUN, a + 1 + int(span[a])))
            yield told(np.full(len(b), a), b)


def crossing_pairs(rings: DataFrame, key: list[str]) -> DataFrame:
    """(key..., i, j) for intersecting non-adjacent edge pairs i < j of a ring (key..., _r); no shuffle."""
    schema = T.StructType([*(rings.schema[k] for k in key), T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])

    def run(batches):
        for batch in batches:
            lines = batch.column("_r")
            start = np.concatenate([[0], np.cumsum(lines.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = lines.flatten()
            x, y = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("x", "y"))
            for ring, i, j in sweep_crossings(x, y, start):
                if len(ring):
                    own = [batch.column(k).take(pa.array(ring)) for k in key]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(i), pa.array(j)], names=schema.names)

    return rings.select(*key, "_r").mapInArrow(run, schema)


def validity_report(geoms: DataFrame, fid: str = "fid") -> DataFrame:
    """(fid, n_repeated, n_unclosed, n_short, n_crossings, valid)."""
    rings = geoms.select(fid, F.posexplode("geom.parts").alias("part", "_rs")).select(
        fid, "part", F.posexplode("_rs").alias("ring", "_r"))
    first, last = F.element_at("_r", 1), F.element_at("_r", -1)
    rep = F.size(F.filter(F.zip_with(F.slice("_r", 1, F.size("_r") - 1), F.slice("_r", 2, F.size("_r") - 1),
                                     lambda a, b: (a["x"] == b["x"]) & (a["y"] == b["y"])), lambda t: t))
    per_ring = rings.select(
        fid, rep.alias("rep"),
        (~((first["x"] == last["x"]) & (first["y"] == last["y"]))).cast("int").alias("unclosed"),
        (F.size("_r") < 4).cast("int").alias("short"))
    stats = per_ring.groupBy(fid).agg(F.sum("rep").cast("int").alias("n_repeated"),
                                      F.sum("unclosed").cast("int").alias("n_unclosed"),
                                      F.sum("short").cast("int").alias("n_short"))
    cross = crossing_pairs(rings, [fid, "part", "ring"]).groupBy(fid).agg(
        F.count("*").cast("int").alias("n_crossings"))
    out = stats.join(cross, fid, "left").withColumn("n_crossings", F.coalesce("n_crossings", F.lit(0)))
    valid = (F.col("n_repeated") == 0) & (F.col("n_unclosed") == 0) & (F.col("n_short") == 0) & (
        F.col("n_crossings") == 0)
    return out.withColumn("valid", valid)


def repair(g) -> Column:
    """Cheap repairs of a geometry struct (see module doc)."""
    g = G._c(g)

    def fix_ring(r):
        dedup = F.filter(r, lambda v, i: (i == 0) | ~((v["x"] == F.element_at(r, i)["x"]) & (
            v["y"] == F.element_at(r, i)["y"])))
        closed = F.when((F.element_at(dedup, 1)["x"] == F.element_at(dedup, -1)["x"])
                        & (F.element_at(dedup, 1)["y"] == F.element_at(dedup, -1)["y"]), dedup).otherwise(
            F.concat(dedup, F.slice(dedup, 1, 1)))
        return closed

    parts = F.transform(g["parts"], lambda p: F.filter(F.transform(p, fix_ring), lambda r: F.size(r) >= 4))
    return G.make_geom(g["type"], F.filter(parts, lambda p: F.size(p) > 0))
