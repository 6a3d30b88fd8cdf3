"""C4 line merge (``ST_LineMerge(ST_Collect(geom))`` per group key).

Lines of one group join where exactly two line ends meet (degree-2 nodes);
at nodes of degree 1 or >= 3 chains stop. Each degree-2 node gives one edge
(its two lines, read off a partial ``min``/``max`` aggregation -- no pair
listing), and a chain is a connected component of lines (``components``).
The result is one row per chain with its member count, total length and the
smallest member id; ordering the members into one vertex sequence is not done
here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators.components import connected_components
from gridloom.operators.labels import global_row_number
from gridloom.session import cut_lineage
from gridloom.sources.tables import SPREAD_ROWS, spread


def merge_chains(lines: DataFrame, keys: list[str], fid: str = "fid") -> DataFrame:
    """lines(keys..., fid, geom) -> (keys..., chain, n_lines, length).

    Every part of a multi-part line is a line of its own; a member that comes
    several times in a group counts once. Keys may be NULL.
    """
    part = cut_lineage(_parts(lines, keys, fid))
    n = part.count()
    base = part.withColumn("node", F.monotonically_increasing_id())
    first, last = F.element_at("_v", 1), F.element_at("_v", -1)
    ends = base.select(*keys, "node", F.explode(F.array(first, last)).alias("_p")).select(
        *keys, "node", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))
    # here and below few rows share a group, so the tasks of a group-by or join follow the rows
    ends = spread(ends, *keys, "x", "y", rows=5 * SPREAD_ROWS, count=2 * n)
    deg = ends.groupBy(*keys, "x", "y").agg(F.count("*").alias("deg"), F.min("node").alias("u"),
                                            F.max("node").alias("v"))
    edges = deg.where((F.col("deg") == 2) & (F.col("u") != F.col("v"))).select("u", "v")
    comp = connected_components(base.select("node"), edges)
    j = base.select(*keys, fid, "node", G.length(G.line_geom("_v")).alias("_len"))
    j = spread(j, "node", rows=5 * SPREAD_ROWS, count=n).join(comp, "node")
    member = spread(j.select(*keys, "label", fid, "_len"), "label", fid, rows=5 * SPREAD_ROWS, count=n).groupBy(
        *keys, "label", fid).agg(F.sum("_len").alias("_len"))
    return member.groupBy(*keys, "label").agg(
        F.min(fid).alias("chain"), F.count(fid).alias("n_lines"), F.sum("_len").alias("length"),
    ).drop("label")


def _parts(lines: DataFrame, keys: list[str], fid: str) -> DataFrame:
    """(keys..., fid, part, _v): one row for each part of each distinct member of a group."""
    one = lines.select(*keys, fid, "geom").dropDuplicates([*keys, fid])
    return one.select(*keys, fid, F.posexplode("geom.parts").alias("part", "_rs")).select(
        *keys, fid, "part", F.element_at("_rs", 1).alias("_v")).where(F.size("_v") > 1)


def _line_states(lines: DataFrame, keys: list[str], fid: str):
    """(fid, _v), (fid, end, x, y) and the links between ends that only two lines of a group share; ``fid`` is unique over all groups."""
    base = lines.select(fid, "_v")
    ends = lines.select(*keys, fid, F.explode(F.array(
        F.struct(F.lit(0).alias("end"), F.element_at("_v", 1).alias("p")),
        F.struct(F.lit(1).alias("end"), F.element_at("_v", -1).alias("p")))).alias("_e")).select(
        *keys, fid, F.col("_e.end").alias("end"), F.col("_e.p.x").alias("x"), F.col("_e.p.y").alias("y"))
    node = ends.groupBy(*keys, "x", "y").agg(F.count("*").alias("deg"), F.min(F.struct(fid, "end")).alias("m1"),
                                             F.max(F.struct(fid, "end")).alias("m2"))
    two = node.where((F.col("deg") == 2) & (F.col("m1")[fid] != F.col("m2")[fid]))
    links = two.select(F.col("m1")[fid].alias(fid), F.col("m1.end").alias("end"),
                       F.col("m2")[fid].alias("pfid"), F.col("m2.end").alias("pend")).unionByName(
        two.select(F.col("m2")[fid].alias(fid), F.col("m2.end").alias("end"),
                   F.col("m1")[fid].alias("pfid"), F.col("m1.end").alias("pend")))
    return base, ends.select(fid, "end", "x", "y"), links


def _ordered(lines: DataFrame, keys: list[str], fid: str = "fid") -> tuple[DataFrame, DataFrame]:
    """(chain, pos, _o) members of all chains, ordered and oriented; (keys..., chain, _id).

    Chains come from :func:`merge_chains`' rule (degree-2 end points). Each
    line has two traversal states (entered at its start or at its end); a
    state's successor is the line met at its exit end. A cycle is cut at its
    smallest line's start. List ranking by pointer jumping (log rounds, one
    checkpoint each) gives every state its distance to the chain end; the
    states that end where the chain's first state ends are the forward path,
    in order. Members are reversed where entered at their end, junction
    vertices are not repeated.
    """
    # lines get dense numbers of their own (keys may be NULL, members repeat, lines have parts), and joins go by them
    # alone: one by the group would meet a large group in one task. Numbers follow the ids, so the smallest line
    # of a chain is the one with the smallest id.
    lines = global_row_number(_parts(lines, keys, fid), [F.col(c) for c in (*keys, fid, "part")], "_line")
    ids = lines.select(*keys, F.col("_line").alias("chain"), F.col(fid).alias("_id"))
    base, ends, links = _line_states(lines, keys, "_line")
    fid = "_line"
    # chains
    edges = links.select(F.col(fid).alias("u"), F.col("pfid").alias("v"))
    comp = connected_components(base.select(F.col(fid).alias("node")), edges)
    lines_c = base.select(fid).join(comp, base[fid] == comp["node"]).select(
        fid, F.col("label").alias("chain"))
    # cycles: chains without a free end are cut at (smallest line, start)
    linked = links.select(fid, "end").withColumn("_linked", F.lit(True))
    ends_c = ends.join(lines_c, fid).join(linked, [fid, "end"], "left")
    free = ends_c.groupBy("chain").agg(F.sum(F.when(F.col("_linked").isNull(), 1).otherwise(0))
                                              .alias("_free"))
    cut = free.where(F.col("_free") == 0).select(F.col("chain").alias(fid), F.lit(0).alias("end"))
    cut_pairs = links.join(cut, [fid, "end"], "left_semi")
    drop = cut_pairs.select(fid, "end").unionByName(
        cut_pairs.select(F.col("pfid").alias(fid), F.col("pend").alias("end")))
    links = links.join(drop, [fid, "end"], "left_anti")
    # states (fid, entry); successor through the exit end
    st = lines_c.select(fid, "chain", F.explode(F.array(F.lit(0), F.lit(1))).alias("entry"))
    nx = links.select(fid, F.col("end").alias("_exit"), F.col("pfid").alias("nfid"),
                      F.col("pend").alias("nentry"))
    st = st.withColumn("_exit", 1 - F.col("entry")).join(nx, [fid, "_exit"], "left").drop("_exit")
    st = st.select(fid, "entry", "chain", "nfid", "nentry",
                   F.when(F.col("nfid").isNotNull(), 1).otherwise(0).alias("d"),
                   F.coalesce("nfid", fid).alias("lfid"), F.coalesce("nentry", "entry").alias("lentry"))
    st = cut_lineage(st)
    while st.where(F.col("nfid").isNotNull()).limit(1).count():  # distances double: log rounds
        t = st.select(F.col(fid).alias("nfid"), F.col("entry").alias("nentry"),
                      F.col("nfid").alias("_nn"), F.col("nentry").alias("_ne"), F.col("d").alias("_d"),
                      F.col("lfid").alias("_lf"), F.col("lentry").alias("_le"))
        # only states that go on meet their successor (which is a state, so always found): in a join of all, those that
        # have ended would all be in one task, that of NULL
        j = st.where(F.col("nfid").isNotNull()).join(t, ["nfid", "nentry"])
        st = cut_lineage(j.select(
            fid, "entry", "chain", F.col("_nn").alias("nfid"), F.col("_ne").alias("nentry"),
            (F.col("d") + F.col("_d")).alias("d"), F.col("_lf").alias("lfid"), F.col("_le").alias("lentry")).unionByName(
            st.where(F.col("nfid").isNull())))
    # start state per chain: smallest free (fid, end), entered there
    free_ends = ends_c.join(drop.withColumn("_cut", F.lit(True)), [fid, "end"], "left").where(
        F.col("_linked").isNull() | F.col("_cut").isNotNull())
    start = free_ends.groupBy("chain").agg(F.min(F.struct(fid, "end")).alias("_s"))
    start = start.join(st.select(F.col(fid).alias("_sf"), F.col("entry").alias("_se"), "chain",
                                 F.col("d").alias("_sd"), F.col("lfid").alias("_slf"),
                                 F.col("lentry").alias("_sle")), "chain").where(
        (F.col("_sf") == F.col("_s")[fid]) & (F.col("_se") == F.col("_s.end")))
    fwd = st.join(start.select("chain", "_sd", "_slf", "_sle"), "chain").where(
        (F.col("lfid") == F.col("_slf")) & (F.col("lentry") == F.col("_sle")))
    fwd = fwd.select("chain", fid, "entry", (F.col("_sd") - F.col("d")).alias("pos"))
    pieces = fwd.join(base, fid).select(
        "chain", "pos",
        F.when(F.col("entry") == 0, F.col("_v")).otherwise(F.reverse("_v")).alias("_o"))
    pieces = pieces.select("chain", "pos",
                           F.when(F.col("pos") == 0, F.col("_o")).otherwise(F.slice("_o", 2, F.size("_o")))
                           .alias("_o"))
    return pieces, ids


def merge_lines(lines: DataFrame, keys: list[str], fid: str = "fid") -> DataFrame:
    """C4 with geometry: one LineString per chain, members ordered and oriented.

    Returns (keys..., chain, n_lines, geom); a chain is one row (``merge_rows`` bounds it).
    """
    pieces, ids = _ordered(lines, keys, fid)
    merged = pieces.groupBy("chain").agg(F.count("*").alias("n_lines"),
                                         F.sort_array(F.collect_list(F.struct("pos", "_o"))).alias("_ps"))
    verts = F.flatten(F.transform("_ps", lambda p: p["_o"]))
    out = merged.select("chain", "n_lines", G.line_geom(verts).alias("geom")).join(ids, "chain")
    return out.select(*keys, F.col("_id").alias("chain"), "n_lines", "geom")


def merge_rows(lines: DataFrame, keys: list[str], fid: str = "fid", most: int = 10_000) -> DataFrame:
    """Chains in rows of at most ``most`` vertices, (keys..., chain, seq, geom) with seq from 0.

    A row begins with the vertex that the last one ended with, so the rows of a chain are one line. Without keys all
    lines are one group; no row and no task holds a whole chain: vertices are placed by running sums over narrow rows
    (chain, place of the member, its vertices) and collected by row.
    """
    if most < 2:
        raise ValueError("a row needs two vertices at least")
    pieces, ids = _ordered(lines, keys, fid)
    pieces = cut_lineage(pieces)
    order = Window.partitionBy("chain").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    first = pieces.select("chain", "pos", F.size("_o").alias("n")).select(
        "chain", "pos", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("_first"))
    v = pieces.join(first, ["chain", "pos"]).select("chain", "_first", F.posexplode("_o").alias("_i", "v"))
    at = F.col("_first") + F.col("_i")
    row = F.floor(at / (most - 1))
    # a vertex between two rows is in both
    v = v.select("chain", at.alias("at"), "v", F.explode(F.when((at % (most - 1) == 0) & (at > 0), F.array(row - 1, row)).otherwise(F.array(row))).alias("seq"))
    rows = v.groupBy("chain", "seq").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("_vs")).where((F.size("_vs") > 1) | (F.col("seq") == 0))
    out = rows.select("chain", "seq", G.line_geom(F.transform("_vs", lambda x: x["v"])).alias("geom"))
    return out.join(ids, "chain").select(*keys, F.col("_id").alias("chain"), F.col("seq").cast("bigint").alias("seq"), "geom")
