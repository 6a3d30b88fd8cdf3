"""SimHash near-duplicates by a self-join of a binary trie.

The distinct fingerprints form a binary trie, one bit a level. The join goes down
pairs of nodes together, adding up the bits in which the two paths differ, and
leaves a pair as soon as that exceeds the error budget. Two fingerprints within k
bits differ in at most k // 2 bits in one of their halves, so the trie is walked
twice, once as it is and once with the halves swapped, and on its upper 32 levels
the budget is k // 2; that keeps the number of node pairs near N rather than N^1.4.

Spark walks the upper levels, two at a time, as joins of the table of node pairs
with the table of nodes; a pair whose two nodes hold at most ``leaf`` fingerprints
is a task of its own, and a heavier one goes deeper, whatever the fingerprints
share. Inside a task numpy goes on level by level. A task returns a forest with the
same components as the links that it found, never all pairs of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.words import pieces, stored, texts_of
from gridloom.operators.components import connected_components
from gridloom.session import cut_lineage

SEED = 42
SHINGLE = 4       # words
BITS = 4          # largest distance of a link
LEAF = 16384      # fingerprints of the two nodes of one task
STEP = 2          # levels a Spark round goes down
FRONT = 1 << 20   # node pairs that numpy holds at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half the hashes of the text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp BIGINT) of every row. Null and empty texts: zero. One pass, no shuffle."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches):
        for table in pieces(batches, 1 << 20):
            made = np.array([fingerprint(t, shingle) for t in texts_of(table)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(table.column("doc_id").chunks), pa.array(made)], names=["doc_id", "fp"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def joined(a: np.ndarray, b: np.ndarray, same: bool, bits: int, depth: int = 0):
    """Yield (i, j) arrays with a[i] and b[j] within ``bits`` bits and, in the upper half, ``bits // 2``.

    ``a`` and ``b`` are sorted distinct fingerprints, each the members of one node at
    ``depth``; ``same``: one node, whose pairs come once, i < j.
    """
    if not len(a) or not len(b):
        return
    half = bits // 2
    one = np.array([0], np.int64)
    stack = [(depth, one, one + len(a), one, one + len(b))]
    while stack:
        level, alo, ahi, blo, bhi = stack.pop()
        if len(alo) > FRONT:
            cut = len(alo) // 2
            stack += [(level, alo[cut:], ahi[cut:], blo[cut:], bhi[cut:])]
            alo, ahi, blo, bhi = alo[:cut], ahi[:cut], blo[:cut], bhi[:cut]
            stack += [(level, alo, ahi, blo, bhi)]
            continue
        na, nb = ahi - alo, bhi - blo
        few = (na * nb <= 16) | (level >= 64)
        if few.any():
            # the fingerprints below small nodes are compared directly
            pa_, pb_, w, h = alo[few], blo[few], nb[few], na[few]
            total = w * h
            for at in _slices(total, FRONT):
                row = np.repeat(np.arange(at.start, at.stop), total[at])
                k = np.arange(len(row)) - np.repeat(np.cumsum(total[at]) - total[at], total[at])
                i, j = pa_[row] + k // w[row], pb_[row] + k % w[row]
                x = a[i] ^ b[j]
                near = (_popcount(x) <= bits) & (_popcount(x >> np.uint64(32)) <= half)
                if same:
                    near &= i < j
                if near.any():
                    yield i[near], j[near]
        alo, ahi, blo, bhi = alo[~few], ahi[~few], blo[~few], bhi[~few]
        if not len(alo):
            continue
        bit = np.uint64(63 - level)
        # first member below the node's right child
        amid = np.clip(np.searchsorted(a, ((a[alo] >> bit) | np.uint64(1)) << bit), alo, ahi)
        bmid = np.clip(np.searchsorted(b, ((b[blo] >> bit) | np.uint64(1)) << bit), blo, bhi)
        out = []
        for left, right in ((0, 0), (0, 1), (1, 0), (1, 1)):
            c = [amid, ahi] if left else [alo, amid]
            d = [bmid, bhi] if right else [blo, bmid]
            keep = (c[0] < c[1]) & (d[0] < d[1])
            if same and (left, right) == (1, 0):
                keep &= alo != blo  # a node with itself has that pair as (0, 1)
            c0, c1, d0, d1 = c[0][keep], c[1][keep], d[0][keep], d[1][keep]
            x = (a[c0] ^ b[d0]) >> bit
            differ = _popcount(x)
            upper = differ if level < 32 else _popcount(x >> np.uint64(level - 31))
            good = (differ <= bits) & (upper <= half)
            out.append((c0[good], c1[good], d0[good], d1[good]))
        children = [np.concatenate([o[k] for o in out]) for k in range(4)]
        if len(children[0]):
            stack.append((level + 1, *children))


def _slices(sizes: np.ndarray, limit: int):
    """Slices of ``sizes`` with a sum of about ``limit`` each."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield slice(at, stop)
        at = stop


def forest(n: int, links) -> np.ndarray:
    """Root of each of ``n`` nodes under links that come as pairs of arrays."""
    root = np.arange(n)
    for u, v in links:
        while True:
            ru, rv = root[u], root[v]
            lo, hi = np.minimum(ru, rv), np.maximum(ru, rv)
            apart = lo < hi
            if not apart.any():
                break
            np.minimum.at(root, hi[apart], lo[apart])
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def links(nodes: DataFrame, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """(u, v): links between distinct fingerprints ``nodes`` (fp) whose components are those of all pairs within ``bits`` bits."""
    # both orders of the halves; unsigned order is the order of the trie
    turned = nodes.select(F.col("fp"), F.explode(F.array(
        F.struct(F.lit(0).alias("turn"), F.col("fp").alias("key")),
        F.struct(F.lit(1).alias("turn"), F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32)).alias("key")))).alias("_x")).select("_x.turn", "_x.key")
    turned = cut_lineage(turned)
    half = bits // 2

    def at(depth):
        return F.lit(0).cast("bigint") if depth == 0 else F.shiftrightunsigned("key", 64 - depth)

    def nodes_at(depth, inside=None):
        found = turned.select("turn", at(depth).alias("node"), at(max(depth - STEP, 0)).alias("up"))
        if inside is not None:
            found = found.join(inside, ["turn", "up"], "left_semi")
        return found.groupBy("turn", "node", "up").agg(F.count(F.lit(1)).alias("n"))

    pairs = nodes_at(0).select("turn", F.col("node").alias("a"), F.col("node").alias("b"), F.col("n").alias("na"), F.col("n").alias("nb"))
    tasks, depth = [], 0
    while True:
        pairs = cut_lineage(pairs)
        last = depth >= 64
        fits = F.lit(True) if last else F.when(F.col("a") == F.col("b"), F.col("na") <= leaf).otherwise(F.col("na") + F.col("nb") <= leaf)
        tasks.append((depth, pairs.where(fits)))
        if last:
            break
        heavy = pairs.where(~fits)
        if heavy.limit(1).count() == 0:
            break
        depth += STEP
        open_nodes = heavy.select("turn", F.col("a").alias("up")).union(heavy.select("turn", F.col("b").alias("up"))).distinct()
        below = cut_lineage(nodes_at(depth, open_nodes))
        left = below.select("turn", F.col("up").alias("a"), F.col("node").alias("a2"), F.col("n").alias("na2"))
        right = below.select("turn", F.col("up").alias("b"), F.col("node").alias("b2"), F.col("n").alias("nb2"))
        met = heavy.select("turn", "a", "b").join(left, ["turn", "a"]).join(right, ["turn", "b"])
        x = F.col("a2").bitwiseXOR(F.col("b2"))
        upper = x if depth <= 32 else F.shiftrightunsigned(x, depth - 32)
        met = met.where(((F.col("a") != F.col("b")) | (F.col("a2") <= F.col("b2"))) & (F.bit_count(x) <= bits) & (F.bit_count(upper) <= half))
        pairs = met.select("turn", F.col("a2").alias("a"), F.col("b2").alias("b"), F.col("na2").alias("na"), F.col("nb2").alias("nb"))

    members = None
    for depth, found in tasks:
        task = F.struct("turn", F.lit(depth).alias("depth"), "a", "b")
        sides = found.select("turn", F.col("a").alias("node"), F.lit(0).alias("side"), task.alias("task")).union(
            found.where("a <> b").select("turn", F.col("b").alias("node"), F.lit(1).alias("side"), task.alias("task")))
        # a node travels as one row of at most ``leaf`` fingerprints
        used = sides.select("turn", "node").distinct()
        held = turned.select("turn", at(depth).alias("node"), "key").join(used, ["turn", "node"], "left_semi").groupBy("turn", "node").agg(F.collect_list("key").alias("keys"))
        got = held.join(sides, ["turn", "node"]).select("task.*", "side", "keys")
        members = got if members is None else members.union(got)

    out = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def work(key, table):
        turn, depth, a, b = (k.as_py() for k in key)
        sides = [np.empty(0, np.uint64)] * 2
        for side, keys in zip(table.column("side").to_pylist(), table.column("keys"), strict=True):
            sides[side] = np.sort(keys.values.to_numpy().view(np.uint64))
        left, right = (sides[0], sides[0]) if a == b else sides
        base = 0 if a == b else len(left)
        everything = left if a == b else np.concatenate([left, right])
        root = forest(len(everything), ((i, j + base) for i, j in joined(left, right, a == b, bits, depth)))
        own = np.flatnonzero(root != np.arange(len(root)))
        u, v = everything[own], everything[root[own]]
        if turn:
            u, v = (x << np.uint64(32) | x >> np.uint64(32) for x in (u, v))
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return members.groupBy("turn", "depth", "a", "b").applyInArrow(work, out)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest id reachable by links, itself included.

    Equal fingerprints, so all exact copies, are one node. Null and empty texts have
    fingerprint zero and are linked like any other. A null id keeps its row, but is
    no one's component_id unless no row of the component has an id. Repeated rows
    come as often as they are there; no other column is read.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    edges = stored(links(nodes, bits).distinct(), "simhash-links")
    linked = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    label = connected_components(linked, edges)
    named = nodes.join(label, nodes["fp"] == label["node"], "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = stored(named, "simhash-labels")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of = named.select(F.col("fp").alias("_fp"), "label").join(least, "label").select("_fp", "component_id")
    return rows.join(of, rows["fp"] == of["_fp"], "left").select("doc_id", "fp", "component_id")
