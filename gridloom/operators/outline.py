"""C3 / G15 outlines: cell sets as row runs, morphology on runs, boundaries traced into rings.

A cell set is kept as runs (feature, row, first and last column), so its size
follows the outline and not the area:

1. ``sweep`` adds up overlapping runs of a row and keeps what at least so many cover.
   Dilation by a disk is a union of shifted, widened runs (one of them is enough), erosion the
   intersection of shifted, narrowed ones (all must cover).
2. ``boundary_edges``: every run has a left and a right side; a horizontal edge stands where only one of two
   neighbouring rows covers. The set lies to the left of every edge.
3. ``trace`` links the edges into rings. Where two cells touch at a corner only, the way goes on around the
   same cell, so rings never cross. The edges of one block are linked and ranked together as arrays, whatever
   feature they belong to; what leaves a block is a piece, and only the pieces go through distributed rounds of list
   ranking (pointer doubling, one checkpoint a round).
4. ``nested`` finds the shell of every hole: the boundary that lies next to the left of its lowest left corner
   belongs to the shell, or to another hole of the same shell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.functions import geometry as G
from gridloom.operators.simplify import with_significance
from gridloom.session import cut_lineage

EAST, NORTH, WEST, SOUTH = range(4)
BAND = 8    # rows of a block of an outline, as a power of two
NEST = 6    # rows of a key under which holes meet boundaries, as a power of two


# ---------------------------------------------------------------- runs

def sweep(runs: DataFrame, least: int = 1, fid: str = "fid", dealt: tuple[str, ...] = ()) -> DataFrame:
    """(fid, cy, c0, c1): maximal runs of cells that ``least`` or more of the given runs cover.

    With ``dealt``, columns by which the runs already lie in tasks, nothing is shuffled; they count like ``fid`` and are kept.
    """
    keys = [fid, *dealt, "cy"]
    row = Window.partitionBy(*keys).orderBy("x")
    steps = runs.select(*keys, F.explode(F.array(F.struct(F.col("c0").alias("x"), F.lit(1).alias("d")),
                                                 F.struct((F.col("c1") + 1).alias("x"), F.lit(-1).alias("d")))).alias("s")).select(*keys, "s.x", "s.d")
    # one shuffle, one sort: the sum takes all steps of a place together, and all windows keep the order
    at = steps if dealt else steps.repartition(fid, "cy")
    on = F.sum("d").over(row.rangeBetween(Window.unboundedPreceding, Window.currentRow)) >= least
    turns = at.select(*keys, "x", on.alias("on")).withColumn("was", F.coalesce(F.lag("on").over(row), F.lit(False))).where("on <> was")
    return turns.withColumn("c1", F.lead("x").over(row) - 1).where("on").select(*keys, F.col("x").alias("c0"), "c1")


def _disk(radius: int) -> Column:
    """Rows of a disk: (dy, w) with columns -w to w."""
    return F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(int((radius * radius - dy * dy) ** 0.5)).alias("w")) for dy in range(-radius, radius + 1)])


def dilate(runs: DataFrame, radius: int, fid: str = "fid", dealt: tuple[str, ...] = ()) -> DataFrame:
    """Runs of all cells within a disk of ``radius`` cells."""
    r = runs.select(fid, *dealt, "cy", "c0", "c1", F.explode(_disk(radius)).alias("d"))
    wide = r.select(fid, *dealt, (F.col("cy") + F.col("d.dy")).alias("cy"), (F.col("c0") - F.col("d.w")).alias("c0"), (F.col("c1") + F.col("d.w")).alias("c1"))
    return sweep(wide, fid=fid, dealt=dealt)


def erode(runs: DataFrame, radius: int, fid: str = "fid", dealt: tuple[str, ...] = ()) -> DataFrame:
    """Runs of the cells whose whole disk is covered; the runs given must not overlap."""
    r = runs.select(fid, *dealt, "cy", "c0", "c1", F.explode(_disk(radius)).alias("d"))
    narrow = r.select(fid, *dealt, (F.col("cy") + F.col("d.dy")).alias("cy"), (F.col("c0") + F.col("d.w")).alias("c0"), (F.col("c1") - F.col("d.w")).alias("c1"))
    return sweep(narrow.where("c1 >= c0"), 2 * radius + 1, fid, dealt)


def closed_runs(runs: DataFrame, radius: int, fid: str = "fid", tasks: int | None = None) -> DataFrame:
    """Dilated, then eroded by the same disk.

    The runs are dealt by blocks of rows, each with the rows beside it that reach into it, and closed where they lie:
    they are shuffled once as they are, not a copy for each row of the disk. ``tasks``: into how many (else Spark's choice).
    """
    reach = 2 * radius
    blocks = F.sequence(F.shiftright(F.col("cy") - reach, BAND), F.shiftright(F.col("cy") + reach, BAND))
    r = runs.select(fid, "cy", "c0", "c1", F.explode(blocks).alias("_block"))
    r = r.repartition(tasks, fid, "_block") if tasks else r.repartition(fid, "_block")
    closed = erode(dilate(r, radius, fid, ("_block",)), radius, fid, ("_block",))
    return closed.where(F.shiftright("cy", BAND) == F.col("_block")).drop("_block")


# ---------------------------------------------------------------- edges

EDGE = ["ax", "ay", "bx", "by", "dir"]


def boundary_edges(runs: DataFrame, fid: str = "fid") -> DataFrame:
    """(fid, block, ax, ay, bx, by, dir, px, py) of runs that neither overlap nor touch in their row.

    Ends are corners in cells; (px, py) is the point that the edge gives its ring, its first corner. Horizontal
    edges are as long as they go, vertical ones a row high. ``block`` holds all edges of a cell.
    """
    def edge(ax, ay, bx, by, d, cy):
        return F.struct(ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"), F.lit(d).alias("dir"), cy.alias("cy"))

    cy, left, right = F.col("cy"), F.col("c0"), F.col("c1") + 1
    sides = runs.select(fid, F.explode(F.array(edge(left, cy + 1, left, cy, SOUTH, cy), edge(right, cy, right, cy + 1, NORTH, cy))).alias("e"))
    # on the line between two rows: above is the row over it, below the row under it
    ends = runs.select(fid, F.explode(F.array(*[F.struct((cy + k).alias("y"), x.alias("x"), F.lit(s if k == 0 else 0).alias("above"), F.lit(s if k else 0).alias("below"))
                                                for k in (0, 1) for x, s in ((left, 1), (right, -1))])).alias("p")).select(fid, "p.*")
    line = Window.partitionBy(fid, "y").orderBy("x")
    level = lambda c: F.sum(c).over(line.rowsBetween(Window.unboundedPreceding, 0)).alias(c)
    steps = ends.repartition(fid, "y").groupBy(fid, "y", "x").agg(F.sum("above").alias("above"), F.sum("below").alias("below"))
    parts = steps.select(fid, "y", "x", F.lead("x").over(line).alias("to"), level("above"), level("below")).where("above <> below")
    y, x, to = F.col("y"), F.col("x"), F.col("to")
    flat = parts.select(fid, F.when(F.col("above") == 1, edge(x, y, to, y, EAST, y)).otherwise(edge(to, y, x, y, WEST, y - 1)).alias("e"))
    e = sides.unionByName(flat).select(fid, F.shiftright("e.cy", BAND).alias("block"), *[F.col(f"e.{c}").cast("bigint").alias(c) for c in EDGE])
    return e.withColumns({"px": F.col("ax").cast("double"), "py": F.col("ay").cast("double")})


# ---------------------------------------------------------------- rings

def _jump(nxt: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps to the end of each chain and the end itself; ``nxt`` is -1 at ends. Members of cycles never end: -1."""
    n = len(nxt)
    to, steps = np.where(nxt < 0, np.arange(n), nxt), value.copy()
    for _ in range(max(1, n.bit_length() + 1)):
        steps = steps + np.where(to == np.arange(n), 0, steps[to])
        to = to[to]
    ended = nxt[to] < 0
    return np.where(ended, steps, -1), np.where(ended, to, -1)


def link(group: np.ndarray, ax, ay, bx, by, d) -> tuple[np.ndarray, ...]:
    """(order, chain, closed) of edges: their order chain by chain, the chain of each in that order, and whether a chain is a ring.

    A ring begins at its lowest, then leftmost corner.
    """
    n = len(group)
    g, x, y = np.concatenate([group, group]), np.concatenate([ax, bx]), np.concatenate([ay, by])
    by_place = np.lexsort((x, y, g))
    new = np.ones(2 * n, bool)
    new[1:] = (g[by_place][1:] != g[by_place][:-1]) | (x[by_place][1:] != x[by_place][:-1]) | (y[by_place][1:] != y[by_place][:-1])
    corner = np.empty(2 * n, np.int64)
    corner[by_place] = np.cumsum(new) - 1
    begin, end = corner[:n], corner[n:]
    out = begin * 4 + d
    by_out = np.argsort(out)
    known = out[by_out]
    nxt = np.full(n, -1)
    for turn in (1, 0, 3):  # left, straight, right
        open_ = np.flatnonzero(nxt < 0)
        want = end[open_] * 4 + (d[open_] + turn) % 4
        at = np.minimum(np.searchsorted(known, want), n - 1)
        hit = known[at] == want
        nxt[open_[hit]] = by_out[at[hit]]
    steps, last = _jump(nxt, (nxt >= 0).astype(np.int64))
    loose = np.flatnonzero(last < 0)
    closed = np.zeros(n, bool)
    if len(loose):  # rings: cut before the smallest corner
        least, to = begin.copy(), nxt.copy()
        for _ in range(max(1, n.bit_length())):
            least[loose] = np.minimum(least[loose], least[to[loose]])
            to[loose] = to[to[loose]]
        before = loose[begin[nxt[loose]] == least[loose]]
        nxt[before] = -1
        closed[before] = True
        steps, last = _jump(nxt, (nxt >= 0).astype(np.int64))
    order = np.lexsort((-steps, last))
    chain = last[order]
    return order, chain, closed[chain]


def _chains(edges: pa.Table, schema, corners: bool) -> pa.RecordBatch:
    """Rings and pieces of whole blocks: (fid, closed, sx, sy, ex, ey, verts)."""
    fid = edges["fid"].combine_chunks()
    codes = fid.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    block = edges["block"].to_numpy()
    new = np.ones(len(block), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (block[1:] != block[:-1])
    ax, ay, bx, by, d = (edges[c].to_numpy() for c in EDGE)
    order, chain, closed = link(np.cumsum(new), ax, ay, bx, by, d)
    head = np.flatnonzero(np.concatenate([[True], chain[1:] != chain[:-1]]))
    last = np.append(head[1:], len(order)) - 1
    keep = np.ones(len(order), bool)
    if corners:  # where the direction stays, no corner is
        keep[1:] = d[order][1:] != d[order][:-1]
        keep[head] = True
    px, py = edges["px"].to_numpy()[order], edges["py"].to_numpy()[order]
    size = np.add.reduceat(keep.astype(np.int64), head)
    starts = np.concatenate([[0], np.cumsum(size)])
    values = pa.StructArray.from_arrays([pa.array(px[keep]), pa.array(py[keep])], names=["x", "y"])
    first, final = order[head], order[last]
    return pa.RecordBatch.from_arrays([
        fid.take(pa.array(first)), pa.array(closed[head]), pa.array(ax[first]), pa.array(ay[first]), pa.array(bx[final]), pa.array(by[final]),
        pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values)], names=schema.names)


def _linked(edges: DataFrame, corners: bool) -> DataFrame:
    """Rings and pieces of all blocks, each block linked in one task."""
    schema = T.StructType([T.StructField("fid", edges.schema["fid"].dataType), T.StructField("closed", T.BooleanType()),
                           *(T.StructField(c, T.LongType()) for c in ("sx", "sy", "ex", "ey")), T.StructField("verts", G.RING)])

    def run(batches):
        names, held = to_arrow_schema(schema), None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if len(held) < 1 << 16:
                continue
            # the last block may go on in the next batch
            fid, block = held["fid"], held["block"].to_numpy()
            same = np.asarray((fid.combine_chunks().dictionary_encode().indices.fill_null(-1)).to_numpy(zero_copy_only=False))
            other = np.flatnonzero((same != same[-1]) | (block != block[-1]))
            if len(other):
                yield _chains(held.slice(0, int(other[-1]) + 1), names, corners)
                held = held.slice(int(other[-1]) + 1)
        if held is not None and len(held):
            yield _chains(held, names, corners)

    cols = ["fid", "block", *EDGE, "px", "py"]
    return edges.select(*cols).repartition("fid", "block").sortWithinPartitions("fid", "block").mapInArrow(run, schema)


def _joined(pieces: DataFrame) -> DataFrame:
    """Rings (fid, verts) of pieces that begin where others end: list ranking by pointer doubling."""
    p = cut_lineage(pieces.withColumn("id", F.monotonically_increasing_id()))
    begins = p.select(F.col("fid").alias("_f"), F.col("sx").alias("_x"), F.col("sy").alias("_y"), F.col("id").alias("to"))
    at = p.join(begins, p["fid"].eqNullSafe(begins["_f"]) & (p["ex"] == begins["_x"]) & (p["ey"] == begins["_y"])).select("id", "to")
    # least: the smallest id among the pieces from here on, and how far away it is
    state = cut_lineage(at.select("id", "to", F.struct(F.col("id").alias("id"), F.lit(0).cast("bigint").alias("far")).alias("least")))
    span = 1
    while True:
        ahead = state.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("least").alias("_least"))
        farther = F.struct(F.col("_least.id").alias("id"), (F.col("_least.far") + span).alias("far"))
        step = state.join(ahead, "to").select("id", F.col("_to").alias("to"), F.least("least", farther).alias("least"), (F.col("_least.id") < F.col("least.id")).alias("moved"))
        step = cut_lineage(step)
        state = step.drop("moved")
        if not step.where("moved").limit(1).count():
            break
        span *= 2
    # the piece with the smallest id comes first, the others by their distance to it, the farthest first
    placed = p.join(state.select("id", F.col("least.id").alias("ring"), F.col("least.far").alias("far")), "id")
    at = F.when(F.col("far") == 0, F.lit(None).cast("bigint")).otherwise(-F.col("far"))
    rings = placed.groupBy("fid", "ring").agg(F.sort_array(F.collect_list(F.struct(at.alias("at"), "verts"))).alias("ps"))
    return rings.select("fid", F.flatten(F.transform("ps", lambda x: x["verts"])).alias("verts"))


def trace(edges: DataFrame, corners: bool = True) -> DataFrame:
    """(fid, ring, verts): the closed rings of boundary edges, each from its lowest, then leftmost point on.

    ``corners`` drops the points at which a ring goes straight on. Rings keep the set to their left: shells run
    counter-clockwise, holes clockwise. ``ring`` is a number of its own.
    """
    found = cut_lineage(_linked(edges, corners))
    whole = found.where("closed").select("fid", "verts")
    pieces = found.where("not closed").drop("closed")
    if pieces.limit(1).count():
        whole = whole.unionByName(_joined(pieces))
    n = F.size("v")
    at = lambda i: F.element_at("v", (F.pmod(i, n) + 1).cast("int"))
    rings = whole.select("fid", F.col("verts").alias("v"))
    if corners:
        turns = lambda p, i: F.lit(0.0) != (p["x"] - at(i - 1)["x"]) * (at(i + 1)["y"] - p["y"]) - (p["y"] - at(i - 1)["y"]) * (at(i + 1)["x"] - p["x"])
        rings = rings.select("fid", F.filter("v", turns).alias("v"))
    first = F.array_min(F.transform("v", lambda p, i: F.struct(p["y"], p["x"], i.alias("i"))))["i"]
    rings = rings.withColumn("_i", first)
    turned = F.concat(F.slice("v", F.col("_i") + 1, n), F.slice("v", F.lit(1), F.col("_i") + 1))
    return cut_lineage(rings.select("fid", turned.alias("verts"))).withColumn("ring", F.monotonically_increasing_id()).select("fid", "ring", "verts")


def nested(rings: DataFrame) -> DataFrame:
    """(fid, ring, shell, verts): every ring and the number of its shell (a shell's is its own)."""
    signed = rings.withColumn("hole", G.ring_signed_area(F.col("verts")) < 0)
    start = F.element_at("verts", 1)
    legs = signed.select("fid", "ring", "hole", F.explode(G._legs(F.col("verts"), lambda a, b: F.struct(
        ((a["x"] + b["x"]) / 2).alias("x"), F.least(a["y"], b["y"]).alias("y0"), F.greatest(a["y"], b["y"]).alias("y1"), a.alias("a"), b.alias("b")))).alias("e"))
    key = lambda y: F.shiftright(F.floor(y), NEST)
    legs = legs.where("e.y1 > e.y0").select("fid", F.col("ring").alias("near"), F.col("hole").alias("near_hole"), "e.*", F.explode(F.sequence(key(F.col("e.y0")), key(F.col("e.y1")))).alias("k"))
    # a ray to the left from beside the hole's start, at a height at which no corner is
    holes = signed.where("hole").select(F.col("fid").alias("_f"), "ring", start["x"].alias("hx"), _ray_height("verts").alias("hy"))
    holes = holes.withColumn("hk", key(F.col("hy")))
    x = F.col("a.x") + (F.col("hy") - F.col("a.y")) * (F.col("b.x") - F.col("a.x")) / (F.col("b.y") - F.col("a.y"))
    meets = holes.join(legs, holes["_f"].eqNullSafe(legs["fid"]) & (F.col("hk") == F.col("k")) & (F.col("y0") <= F.col("hy")) & (F.col("hy") < F.col("y1")))
    meets = meets.withColumn("mx", x).withColumn("own", F.col("near") == F.col("ring"))
    left = Window.partitionBy("ring")
    meets = meets.withColumn("edge", F.min(F.when(F.col("own"), F.col("mx"))).over(left)).where("not own and mx < edge")
    near = meets.groupBy("ring").agg(F.max(F.struct("mx", "near", "near_hole")).alias("m")).select("ring", F.col("m.near").alias("shell"), F.col("m.near_hole").alias("again"))
    near = cut_lineage(near)
    while near.where("again").limit(1).count():  # a chain of holes, each to the left of the last, ends at the shell
        ahead = near.select(F.col("ring").alias("shell"), F.col("shell").alias("_s"), F.col("again").alias("_a"))
        near = cut_lineage(near.join(ahead, "shell", "left").select(
            "ring", F.coalesce("_s", "shell").alias("shell"), F.coalesce("_a", F.lit(False)).alias("again")))
    return signed.join(near.select("ring", "shell"), "ring", "left").select("fid", "ring", F.coalesce("shell", "ring").alias("shell"), "verts")


def _ray_height(verts: str) -> Column:
    """Between a ring's lowest corner and the next higher one of the same ring."""
    ys = F.transform(verts, lambda p: p["y"])
    low = F.array_min(ys)
    return (low + F.array_min(F.filter(ys, lambda y: y > F.array_min(F.transform(verts, lambda p: p["y"]))))) / 2.0


def to_polygons(rings: DataFrame) -> DataFrame:
    """(fid, geom): one MultiPolygon a feature, its parts in order of their shell's start, holes likewise."""
    key = lambda v: F.struct(F.element_at(v, 1)["y"].alias("y"), F.element_at(v, 1)["x"].alias("x"))
    one = rings.select("fid", "shell", F.struct((F.col("ring") != F.col("shell")).alias("hole"), key(F.col("verts")).alias("k"), "verts").alias("r"))
    parts = one.groupBy("fid", "shell").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    geoms = parts.groupBy("fid").agg(F.sort_array(F.collect_list(F.struct(F.col("rs")[0]["k"].alias("k"), F.transform("rs", lambda r: r["verts"]).alias("p")))).alias("ps"))
    return geoms.select("fid", G.make_geom("MultiPolygon", F.transform("ps", lambda p: p["p"])).alias("geom"))


def outline(runs: DataFrame, cell: float) -> DataFrame:
    """(fid, ring, shell, verts): outlines of run sets (fid, cy, c0, c1), in units of the map."""
    rings = nested(trace(boundary_edges(runs)))
    return rings.select("fid", "ring", "shell", F.transform("verts", lambda p: G.vertex(p["x"] * cell, p["y"] * cell)).alias("verts"))


def simplified(rings: DataFrame, tol: float | Column) -> DataFrame:
    """Rings (..., verts) at a tolerance, the row's own if it is a column; a ring keeps its two most significant corners besides its ends."""
    names = rings.columns
    per = with_significance(rings.withColumnRenamed("verts", "_r"))
    zipped = F.arrays_zip(F.col("_r").alias("v"), F.col("_sig").alias("s"), F.sequence(F.lit(0), F.size("_r") - 1).alias("i"))
    kept = F.filter(zipped, lambda z: (z["s"] > tol) | F.array_contains("_prot", z["i"]))
    return per.select(*[F.transform(kept, lambda z: z["v"]).alias(c) if c == "verts" else F.col(c) for c in names])
