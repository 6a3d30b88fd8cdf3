"""Connected components of an edge list, as distributed DataFrame rounds.

Used by distance clustering (C1) and line merging (C4).

Each round, every representative with a smaller neighbour points to its
smallest neighbour; the pointer forest is collapsed by pointer jumping until
every pointer reaches a root; then edges and node labels are rewritten to the
roots, self-loops are dropped, and the contracted graph goes into the next
round. Pointers only ever decrease, so labels end as the smallest node id of
each component. A path of n nodes collapses in one round (log n jumps); the
number of rounds is logarithmic in practice.

Every aggregation is partial (map-side ``min``); the joins are against tables
with one row per node id, so a hot node only skews the side AQE can split.
Lineage is cut with reliable checkpoints in the session's checkpoint folder,
so a lost executor recomputes from the last checkpoint, not from the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import cut_lineage

# Node labels are rewritten every round but only read at the end; their
# lineage (one join per round against checkpointed parent tables) is cut
# every few rounds instead of every round.
LABEL_CHECKPOINT_EVERY = 4


def _jump(parent: DataFrame) -> DataFrame:
    """parent(node, p) -> node pointing at its forest root (pointers only fall, so the loop ends)."""
    while True:
        b = parent.select(F.col("node").alias("_n"), F.col("p").alias("_pp"))
        j = parent.join(b, parent.p == b._n, "left")
        nxt = j.select("node", F.coalesce("_pp", "p").alias("p"), F.col("_pp").isNotNull().alias("_moved"))
        nxt = cut_lineage(nxt)
        if nxt.where("_moved").limit(1).count() == 0:
            return nxt.drop("_moved")
        parent = nxt.drop("_moved")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes(node BIGINT), edges(u BIGINT, v BIGINT) -> (node, label).

    ``label`` is the smallest node id of the component.
    """
    labels = nodes.select(F.col("node"), F.col("node").alias("label"))
    e = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct()
    e = cut_lineage(e)
    rounds = 0
    while e.limit(1).count():  # each round joins at least two components
        parent = e.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("p"))
        parent = _jump(cut_lineage(parent))
        pu = parent.select(F.col("node").alias("_a"), F.col("p").alias("_pa"))
        pv = parent.select(F.col("node").alias("_b"), F.col("p").alias("_pb"))
        e2 = (
            e.join(pu, e.u == pu._a, "left").join(pv, e.v == pv._b, "left")
            .select(F.coalesce("_pa", "u").alias("a"), F.coalesce("_pb", "v").alias("b"))
        )
        e = cut_lineage(
            e2.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u <> v").distinct()
        )
        pl = parent.select(F.col("node").alias("_l"), F.col("p").alias("_pl"))
        labels = labels.join(pl, labels.label == pl._l, "left").select(
            "node", F.coalesce("_pl", "label").alias("label"))
        rounds += 1
        if rounds % LABEL_CHECKPOINT_EVERY == 0:
            labels = cut_lineage(labels)
    return labels
