"""C1 distance clustering (DBSCAN with minpts = 1) and the A1-A5 summary.

With minpts = 1 every point is a core point, so a cluster is a connected
component of the graph "distance <= eps". The graph is built without a
cross join:

1. points snap to square cells of side just under eps/sqrt(2); any two points
   of one cell are within eps, so a cell is one node (a cell holding a third of
   all points is still one row after a map-side pre-aggregation);
2. each cell looks at 12 of its 24 neighbours (half plane; the rest are the
   mirror pairs) via an equi-join on the neighbour's cell key;
3. a cell pair is linked at once when the two point bounding boxes are within
   eps at their farthest corners, dropped when they are farther than eps at
   their nearest; only the remaining *ambiguous* pairs compare points, and
   only the distinct positions within eps of the other cell's box;
4. connected components of the cell graph (``components``).

Rungs of a ladder (other radii, other filters) are clustered at the same time: the rung is part of every key.

The summary groups by (class, subclass, cluster) in two partial-aggregation
passes: first per distinct position (ST_Union drops repeated points, so the
centroid is the mean of distinct positions), then per cluster.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.components import connected_components
from gridloom.session import cut_lineage

# half of the 5x5 neighbourhood (without the cell itself)
_OFFSETS = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3) if (dx, dy) > (0, 0)]


def _dist2(ax, ay, bx, by):
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by)


def _gap(lo1, hi1, lo2, hi2):
    """distance between intervals [lo1,hi1] and [lo2,hi2] along one axis"""
    return F.greatest(F.lit(0.0), lo2 - hi1, lo1 - hi2)


def _span(lo1, hi1, lo2, hi2):
    """largest distance between a point of each interval along one axis"""
    return F.greatest(hi2 - lo1, hi1 - lo2)


def _side():
    """Side of a cell, from the row's ``eps``."""
    return F.col("eps") / math.sqrt(2.0) * (1.0 - 1e-9)


def cell_node():
    """Number of the cell of a row with ``gen``, ``eps``, ``x``, ``y``: rung and cell coordinates in one BIGINT, 5 and 29 bits each.

    Ids play no part, so points of different kinds may share ids. 29 bits reach over the world at a side of a tenth of a metre.
    """
    bits = F.lit((1 << 29) - 1)
    cx, cy = (F.floor(F.col(c) / _side()).cast("bigint").bitwiseAND(bits) for c in ("x", "y"))
    return F.shiftleft(F.col("gen").cast("bigint"), 58).bitwiseOR(F.shiftleft(cx, 29)).bitwiseOR(cy)


def eps_graph(points: DataFrame, with_blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """-> (cells(node), edges(u, v[, ub, vb])) for ``points(gen, eps, x, y)``; a node is a cell (:func:`cell_node`).

    Points of different rungs (``gen``, 0 to 31) never meet. With ``with_blocks`` each edge also carries the block
    keys of its two cells.
    """
    eps2 = F.col("eps") * F.col("eps")
    # read twice below (cells, positions); copies of a position count once
    p = cut_lineage(points.select(
        "gen", "eps", "x", "y", cell_node().alias("node"),
        F.floor(F.col("x") / _side()).alias("cx"), F.floor(F.col("y") / _side()).alias("cy"),
    ).distinct())
    cells = p.groupBy("gen", "eps", "cx", "cy", "node").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"),
        F.min("y").alias("y0"), F.max("y").alias("y1"),
    )
    offs = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _OFFSETS])
    a = cells.select(
        "gen", "eps", F.col("node").alias("a_node"), F.col("cx").alias("a_cx"), F.col("cy").alias("a_cy"),
        F.col("x0").alias("a_x0"), F.col("x1").alias("a_x1"), F.col("y0").alias("a_y0"), F.col("y1").alias("a_y1"),
        F.explode(offs).alias("_o"),
    ).select("*", (F.col("a_cx") + F.col("_o.dx")).alias("b_cx"), (F.col("a_cy") + F.col("_o.dy")).alias("b_cy"))
    b = cells.select(
        "gen", F.col("node").alias("b_node"), F.col("cx").alias("b_cx"), F.col("cy").alias("b_cy"),
        F.col("x0").alias("b_x0"), F.col("x1").alias("b_x1"), F.col("y0").alias("b_y0"), F.col("y1").alias("b_y1"),
    )
    cand = a.join(b, ["gen", "b_cx", "b_cy"])
    gx, gy = _gap(F.col("a_x0"), F.col("a_x1"), F.col("b_x0"), F.col("b_x1")), _gap(
        F.col("a_y0"), F.col("a_y1"), F.col("b_y0"), F.col("b_y1"))
    sx, sy = _span(F.col("a_x0"), F.col("a_x1"), F.col("b_x0"), F.col("b_x1")), _span(
        F.col("a_y0"), F.col("a_y1"), F.col("b_y0"), F.col("b_y1"))
    cand = cand.where(gx * gx + gy * gy <= eps2).withColumn("_sure", sx * sx + sy * sy <= eps2)
    if with_blocks:
        nb = with_blocks
        cand = cand.withColumn("ub", F.xxhash64("gen", F.floor(F.col("a_cx") / nb), F.floor(F.col("a_cy") / nb))) \
            .withColumn("vb", F.xxhash64("gen", F.floor(F.col("b_cx") / nb), F.floor(F.col("b_cy") / nb)))
    extra = ["ub", "vb"] if with_blocks else []
    sure = cand.where("_sure").select(F.col("a_node").alias("u"), F.col("b_node").alias("v"), *extra)
    amb = cand.where(~F.col("_sure"))
    blocks = amb.select("a_node", "b_node", *extra)

    # distinct positions per cell, only near the other box
    pos = p.select("gen", "cx", "cy", "x", "y")
    pa = amb.select("gen", "eps", "a_node", "b_node", "a_cx", "a_cy", "b_x0", "b_x1", "b_y0", "b_y1").join(
        pos.withColumnRenamed("cx", "a_cx").withColumnRenamed("cy", "a_cy"), ["gen", "a_cx", "a_cy"]
    )
    dxa, dya = _gap(F.col("x"), F.col("x"), F.col("b_x0"), F.col("b_x1")), _gap(
        F.col("y"), F.col("y"), F.col("b_y0"), F.col("b_y1"))
    pa = pa.where(dxa * dxa + dya * dya <= eps2).select("eps", "a_node", "b_node", F.col("x").alias("ax"),
                                                        F.col("y").alias("ay"))
    pb = amb.select("gen", "eps", "a_node", "b_node", "b_cx", "b_cy", "a_x0", "a_x1", "a_y0", "a_y1").join(
        pos.withColumnRenamed("cx", "b_cx").withColumnRenamed("cy", "b_cy"), ["gen", "b_cx", "b_cy"]
    )
    dxb, dyb = _gap(F.col("x"), F.col("x"), F.col("a_x0"), F.col("a_x1")), _gap(
        F.col("y"), F.col("y"), F.col("a_y0"), F.col("a_y1"))
    pb = pb.where(dxb * dxb + dyb * dyb <= eps2).select("a_node", "b_node", F.col("x").alias("bx"),
                                                        F.col("y").alias("by"))
    checked = (
        pa.join(pb, ["a_node", "b_node"])
        .where(_dist2(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")) <= eps2)
        .select("a_node", "b_node")
        .distinct()
    )
    if with_blocks:
        checked = checked.join(blocks, ["a_node", "b_node"])
    checked = checked.select(F.col("a_node").alias("u"), F.col("b_node").alias("v"), *extra)
    edges = sure.unionByName(checked)
    return cells.select("node"), edges


BLOCK_CELLS = 64  # block side in cells: a block holds at most 64*64 nodes, whatever the data


def _union_find(pdf):
    """Union-find over (u, v) node pairs -> (node, label = smallest node)."""
    import pandas as pd
    parent: dict = {}

    def find(a):
        root = a
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(a, a) != root:
            parent[a], a = root, parent[a]
        return root

    for u, v in zip(pdf["u"].tolist(), pdf["v"].tolist()):
        ru, rv = find(u), find(v)
        if ru != rv:
            parent[max(ru, rv)] = min(ru, rv)
            parent.setdefault(min(ru, rv), min(ru, rv))
    nodes = list(parent.keys())
    return pd.DataFrame({"node": nodes, "label": [find(n) for n in nodes]}, dtype="int64")


def cluster_ids(points: DataFrame, eps: float | None = None) -> DataFrame:
    """Adds ``cluster_id``, a BIGINT that the points of one cluster share (its smallest cell).

    ``points`` have ``gen`` and ``eps``, unless one ``eps`` is given for all.

    Two levels: links inside a block of BLOCK_CELLS x BLOCK_CELLS cells are
    resolved by a union-find in one task per block (a block's node count is
    bounded by its area in cells, not by how many points fall in it); only the
    links between blocks, rewritten to block-local labels, go through the
    distributed component rounds. Points meet their cluster by their cell, so
    neither repeated ids nor repeated rows matter.
    """
    if eps is not None:
        return cluster_ids(points.withColumns({"gen": F.lit(0), "eps": F.lit(float(eps))})).drop("gen", "eps")
    cells, edges = eps_graph(points, with_blocks=BLOCK_CELLS)
    inner = edges.where(F.col("ub") == F.col("vb")).select(F.col("ub").alias("block"), "u", "v")
    local = cut_lineage(inner.groupBy("block").applyInPandas(_union_find, "node long, label long"))
    lu = local.select(F.col("node").alias("_u"), F.col("label").alias("_lu"))
    lv = local.select(F.col("node").alias("_v"), F.col("label").alias("_lv"))
    cross = edges.where(F.col("ub") != F.col("vb")).select("u", "v")
    cross = cross.join(lu, cross.u == lu._u, "left").join(lv, cross.v == lv._v, "left").select(
        F.coalesce("_lu", "u").alias("u"), F.coalesce("_lv", "v").alias("v"))
    loc = cells.join(local, "node", "left").select("node", F.coalesce("label", "node").alias("local"))
    glob = connected_components(loc.select(F.col("local").alias("node")).distinct(), cross)
    comp = loc.join(glob.withColumnRenamed("node", "local"), "local").select(
        F.col("node").alias("_cell"), F.col("label").alias("cluster_id"))
    return points.withColumn("_cell", cell_node()).join(comp, "_cell").drop("_cell")


FIRST_OF = ("ele", "access", "religion", "parking", "subway")


def cluster_summary(clustered: DataFrame, id_col: str = "osm_id", first_of=FIRST_OF) -> DataFrame:
    """A1-A5 over (gen, class, subclass, cluster_id).

    id: smallest member id; count: non-NULL ids; name: first non-empty name by
    id (NULL names are kept, '' skipped); other attributes: value at the
    smallest id (of members that share it, the smallest position's); x, y: mean of
    the distinct member positions.
    """
    keys = ["gen", "class", "subclass", "cluster_id"]
    named = F.when(F.col("name").isNull() | (F.col("name") != ""), F.col(id_col))
    pos = clustered.groupBy(*keys, "x", "y").agg(
        F.min(id_col).alias("_id"),
        F.count(id_col).alias("_n"),
        F.min(F.when(named.isNotNull(), F.struct(named.alias("id"), "x", "y"))).alias("_nid"),
        F.min_by("name", named).alias("_name"),
        *[F.min_by(c, F.col(id_col)).alias("_" + c) for c in first_of],
    )
    return pos.groupBy(*keys).agg(
        F.min("_id").alias("id"),
        F.sum("_n").alias("count"),
        F.min_by("_name", "_nid").alias("name"),
        *[F.min_by("_" + c, F.struct("_id", "x", "y")).alias(c) for c in first_of],
        F.avg("x").alias("x"),
        F.avg("y").alias("y"),
    )


def cluster_rungs(points: DataFrame, rungs: list[tuple[int, float, str | None]], id_col: str = "osm_id") -> DataFrame:
    """All rungs (gen, eps, filter) of a clustering ladder at once, as one table with ``gen``.

    A point goes into every rung whose filter it passes. The rungs are one graph without links between
    them, so the ladder costs one graph and one run of component rounds, as many as its worst rung
    needs, and not one for each rung.
    """
    if not all(0 <= gen < 32 for gen, _, _ in rungs):
        raise ValueError("rungs are numbered from 0 to 31")
    passed = F.filter(F.array(*[F.when(F.expr(cond) if cond else F.lit(True), F.struct(F.lit(gen).alias("gen"), F.lit(float(eps)).alias("eps")))
                                for gen, eps, cond in rungs]), lambda r: r.isNotNull())
    own = points.withColumn("_rung", F.explode(passed)).select(*points.columns, "_rung.gen", "_rung.eps")
    return cluster_summary(cluster_ids(own), id_col)


def cluster_points(points: DataFrame, eps: float, condition=None, id_col: str = "osm_id") -> DataFrame:
    """``cluster(source, target, distance, filter)`` end to end."""
    if condition is not None:
        points = points.where(condition)
    own = points.withColumns({"gen": F.lit(0), "eps": F.lit(float(eps))})
    return cluster_summary(cluster_ids(own), id_col).drop("gen")
