"""C2 generalization: Douglas-Peucker as per-vertex significance.

The Douglas-Peucker split tree does not depend on the tolerance: a segment is
always split at its farthest interior vertex. So each vertex gets a
*significance* once -- the smaller of its own split distance and its parent's
significance (end points: +inf) -- and the simplification at any tolerance is
``sig > tol``. A whole ladder of rungs (and simplifying an already simplified
rung at a larger tolerance) is then a filter, not another DP run.

Lines that are rows (a geometry column) are split inside Arrow batches, all lines of a
batch together, whatever their length (``with_significance``). Lines that are given as
vertex rows take distributed rounds (``significance``), one per level of the split tree:
every undecided vertex carries its current segment (end seqs and coordinates); a partial-aggregation
``max`` per segment finds the split vertex; a join on the segment key hands the
split back; vertices left and right of it move to the two child segments.
Only undecided vertices go into the next round; decided ones are set aside.
Closed rings start with the degenerate segment (first = last vertex), so the
first split is the vertex farthest from the start; the two most significant
interior vertices of a ring are always kept so a ring never collapses.
Distances are to the segment (not the infinite line); ties go to the smaller
seq.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import geometry as G
from gridloom.session import cut_lineage

INF = float("inf")


def seg_distance(x, y, ax, ay, bx, by) -> Column:
    """Euclidean distance of (x,y) to segment a-b (a point if a = b)."""
    dx, dy = bx - ax, by - ay
    l2 = dx * dx + dy * dy
    t = F.when(l2 == 0, F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - ax) * dx + (y - ay) * dy) / l2))
    )
    px, py = ax + t * dx, ay + t * dy
    return F.sqrt((x - px) * (x - px) + (y - py) * (y - py))


def significance(vertices: DataFrame, key: list[str]) -> DataFrame:
    """vertices(key..., seq, x, y) -> same rows + sig (inf at the ends) + protect.

    ``protect`` marks the two most significant interior vertices of closed
    rings (kept at every tolerance). For lines that are given as vertex rows;
    each round decides one vertex of every open segment, so the loop ends.
    """
    v = vertices.select(*key, "seq", "x", "y")
    bounds = v.groupBy(*key).agg(
        F.min("seq").alias("_s0"), F.max("seq").alias("_s1"),
        F.min_by(F.struct("x", "y"), "seq").alias("_p0"), F.max_by(F.struct("x", "y"), "seq").alias("_p1"),
    )
    j = v.join(bounds, key)
    ends = j.where((F.col("seq") == F.col("_s0")) | (F.col("seq") == F.col("_s1"))).select(
        *key, "seq", "x", "y", F.lit(INF).alias("sig"))
    closed = bounds.select(*key, ((F.col("_p0.x") == F.col("_p1.x")) & (F.col("_p0.y") == F.col("_p1.y")))
                           .alias("closed"))
    state = j.where((F.col("seq") > F.col("_s0")) & (F.col("seq") < F.col("_s1"))).select(
        *key, "seq", "x", "y",
        F.col("_s0").alias("a"), F.col("_p0.x").alias("ax"), F.col("_p0.y").alias("ay"),
        F.col("_s1").alias("b"), F.col("_p1.x").alias("bx"), F.col("_p1.y").alias("by"),
        F.lit(INF).alias("psig"),
    )
    state = cut_lineage(state)
    decided = []
    while state.limit(1).count():
        st = state.withColumn("d", seg_distance(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"),
                                                F.col("by")))
        best = st.groupBy(*key, "a").agg(F.max(F.struct("d", (-F.col("seq")).alias("ns"), "x", "y")).alias("m"))
        st = st.join(best, [*key, "a"])
        ms = -F.col("m.ns")
        sig = F.least(F.col("m.d"), F.col("psig"))
        # recomputed from the checkpointed state if lost; no extra write needed
        decided.append(st.where(F.col("seq") == ms).select(*key, "seq", "x", "y", sig.alias("sig")))
        left = F.col("seq") < ms
        state = cut_lineage(st.where(F.col("seq") != ms).select(
            *key, "seq", "x", "y",
            F.when(left, F.col("a")).otherwise(ms).alias("a"),
            F.when(left, F.col("ax")).otherwise(F.col("m.x")).alias("ax"),
            F.when(left, F.col("ay")).otherwise(F.col("m.y")).alias("ay"),
            F.when(left, ms).otherwise(F.col("b")).alias("b"),
            F.when(left, F.col("m.x")).otherwise(F.col("bx")).alias("bx"),
            F.when(left, F.col("m.y")).otherwise(F.col("by")).alias("by"),
            sig.alias("psig"),
        ))
    allv = cut_lineage(reduce(DataFrame.unionByName, decided, ends))
    # ring guard: the two most significant interior vertices of closed rings
    inner = allv.where(~(F.col("sig") == F.lit(INF))).join(closed.where("closed"), key)
    top1 = inner.groupBy(*key).agg(F.max(F.struct("sig", (-F.col("seq")).alias("ns"))).alias("t"))
    rest = inner.join(top1, key).where(F.col("seq") != -F.col("t.ns"))
    top2 = rest.groupBy(*key).agg(F.max(F.struct("sig", (-F.col("seq")).alias("ns"))).alias("t"))
    prot = top1.unionByName(top2).select(*key, (-F.col("t.ns")).alias("seq"), F.lit(True).alias("protect"))
    return allv.join(prot, [*key, "seq"], "left").withColumn("protect", F.coalesce("protect", F.lit(False)))


def split_tree(x: np.ndarray, y: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Significance of the vertices of many lines laid end to end (``starts``: one more than lines).

    All open segments of all lines are split together, one level of the split
    tree at a time, so a level costs its undecided vertices, however long
    the lines are.
    """
    sig = np.full(len(x), INF)
    size = np.diff(starts)
    line = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(x))
    inner = (at > starts[line]) & (at < starts[line + 1] - 1)
    at, line = at[inner], line[inner]
    a, b = starts[line], starts[line + 1] - 1
    parent = np.full(len(at), INF)
    while len(at):
        ax, ay, px, py = x[a], y[a], x[at], y[at]
        dx, dy = x[b] - ax, y[b] - ay
        l2 = dx * dx + dy * dy
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(l2 == 0, 0.0, np.minimum(1.0, np.maximum(0.0, ((px - ax) * dx + (py - ay) * dy) / l2)))
        qx, qy = ax + t * dx, ay + t * dy
        d = np.sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))
        head = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        n = np.diff(np.append(head, len(at)))
        far = np.maximum.reduceat(d, head)
        place = np.where(d == np.repeat(far, n), np.arange(len(at)), len(at))
        best = np.minimum.reduceat(place, head)  # ties: the first
        own = np.minimum(far, parent[head])
        sig[at[best]] = own
        split, parent = np.repeat(at[best], n), np.repeat(own, n)
        a, b = np.where(at < split, a, split), np.where(at < split, split, b)
        rest = at != split
        at, a, b, parent = at[rest], a[rest], b[rest], parent[rest]
    return sig


def with_significance(rings: DataFrame, ring: str = "_r") -> DataFrame:
    """Adds ``_sig`` (one per vertex of ``ring``, +inf at the ends) and ``_prot``.

    ``_prot`` has the places of the two most significant interior vertices of a
    closed ring. One path for lines of every length: no job, no shuffle; Arrow
    batches of whole rings are worked through together.
    """
    schema = T.StructType([*rings.schema.fields, T.StructField("_sig", T.ArrayType(T.DoubleType())),
                           T.StructField("_prot", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            lines = batch.column(batch.schema.get_field_index(ring))
            starts = np.concatenate([[0], np.cumsum(lines.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = lines.flatten()
            x, y = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("x", "y"))
            sig = split_tree(x, y, starts)
            protect = []
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
                closed = hi > lo and x[lo] == x[hi - 1] and y[lo] == y[hi - 1]
                inner = sig[lo + 1:hi - 1]
                protect.append((np.argsort(-inner, kind="stable")[:2] + 1).tolist() if closed else [])
            offsets = pa.array(starts, pa.int32())
            made = [pa.ListArray.from_arrays(offsets, pa.array(sig)), pa.array(protect, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return rings.mapInArrow(run, schema)


def significance_of_lines(lines: DataFrame, fid: str = "fid") -> DataFrame:
    """C2 over geometries: (fid, part, ring, seq, x, y, sig, protect)."""
    rings = lines.select(fid, F.posexplode("geom.parts").alias("part", "_rs")).select(
        fid, "part", F.posexplode("_rs").alias("ring", "_r"))
    rows = with_significance(rings).select(
        fid, "part", "ring", "_prot", F.posexplode(F.arrays_zip("_r", "_sig")).alias("seq", "_z"))
    return rows.select(
        fid, "part", "ring", "seq", F.col("_z._r.x").alias("x"), F.col("_z._r.y").alias("y"),
        F.col("_z._sig").alias("sig"), F.array_contains("_prot", F.col("seq")).alias("protect"))


def kept(sig_rows: DataFrame, tol: float) -> Column:
    """Vertex survives simplification at ``tol``."""
    return (F.col("sig") > F.lit(float(tol))) | F.col("protect")


def rebuild(sig_rows: DataFrame, key: list[str], tol: float, fid: str = "fid") -> DataFrame:
    """Simplified geometry at ``tol``: kept vertices back into the struct.

    ``key`` = [fid, part, ring]. Returns (fid, geom, type from caller).
    """
    k = sig_rows.where(kept(sig_rows, tol))
    return _whole(k.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("_r")), key, fid)


def simplified_lines(lines: DataFrame, tol: float, fid: str = "fid") -> DataFrame:
    """(fid, parts) at ``tol``: what :func:`rebuild` makes of :func:`significance_of_lines`, by rings, which are shuffled once."""
    key = [fid, "part", "ring"]
    rings = lines.select(fid, F.posexplode("geom.parts").alias("part", "_rs")).select(
        fid, "part", F.posexplode("_rs").alias("ring", "_r"))
    points = F.transform("_r", lambda v, i: F.struct(i.alias("seq"), v["x"].alias("x"), v["y"].alias("y")))
    left = F.filter(points, lambda p: (F.get("_sig", p["seq"]) > F.lit(float(tol))) | F.array_contains("_prot", p["seq"]))
    k = with_significance(rings).select(*key, left.alias("_k")).where(F.size("_k") > 0).repartition(fid)
    return _whole(k.groupBy(*key).agg(F.sort_array(F.flatten(F.collect_list("_k"))).alias("_r")), key, fid)


def _whole(rings: DataFrame, key: list[str], fid: str) -> DataFrame:
    """Rings (key..., _r) of (seq, x, y) back into parts, one row per feature."""
    rings = rings.select(*key, F.transform("_r", lambda p: G.vertex(p["x"], p["y"])).alias("_ring"))
    others = [c for c in key if c != fid]
    parts = rings.groupBy(fid, *others[:-1]).agg(
        F.sort_array(F.collect_list(F.struct(others[-1], "_ring"))).alias("_rs"))
    parts = parts.select(fid, *others[:-1], F.transform("_rs", lambda r: r["_ring"]).alias("_part"))
    geoms = parts.groupBy(fid).agg(F.sort_array(F.collect_list(F.struct(others[0], "_part"))).alias("_ps"))
    return geoms.select(fid, F.transform("_ps", lambda p: p["_part"]).alias("parts"))
