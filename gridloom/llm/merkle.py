"""Merkle manifest of a dataset by nested-struct rollup.

Every row is a leaf, every group (a language) a tree over its leaves in order of id, and
the groups' roots are the leaves of one more tree. Two nodes that follow each other make
a node of the next level; the last one of an odd level makes one alone.

A leaf's rank in its group is written in binary: the lowest ``DIGITS`` digits are columns, the others name
its block. The digit columns are grouped away one after the other, from the lowest; each step nests the structs of two
children in their parent's. The block stays a grouping column throughout, so one shuffle
serves all steps, and a nested struct holds ``2 ** DIGITS`` leaves at most, however large the group
is. The blocks' roots are the leaves of the next rollup, until one block is left of
every group. On the way back one aggregation hands each block the path of its own root, and a transform
and an explode for each digit write the proofs: a leaf meets its siblings inside its block's nested struct, without joins.

Ranks come from range partitioning and offsets, so a group that holds a third of all rows
spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.sharding import with_slots
from gridloom.llm.words import stored

DIGITS = 10  # of a block: 1024 leaves
STEP = "struct<left:string,right:string>"


def field(value: Column) -> Column:
    """A field's canonical form: its length in bytes, a colon and the value; a hyphen if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    return digest(*[field(c) for c in fields])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda at, step: digest(step["left"], at, step["right"]))


def proof(path: Column) -> Column:
    """The siblings' digests on end, from the leaf to the root."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _blocks(nodes: DataFrame, digits: int) -> DataFrame:
    """(g, last, block, tree): nodes (g, last, at, node) rolled up by ``digits`` digits of their place ``at``.

    ``last`` is the place of the group's last node; where a level has one node only, it is passed on as it is.
    """
    names = [f"d{k}" for k in range(digits)]
    out = nodes.select("g", "last", F.shiftright("at", digits).alias("block"), *[F.shiftright("at", k).bitwiseAND(F.lit(1)).alias(n) for k, n in enumerate(names)], "node")
    # shuffled once: the later steps group by more columns than these
    out = out.repartition("g", "last", "block")
    for k, name in enumerate(names):
        kids = F.transform(F.sort_array(F.collect_list(F.struct(F.col(name).alias("d"), F.col("node.h").alias("h"), "node"))), lambda x: x["node"])
        out = out.groupBy("g", "last", "block", *names[k + 1:]).agg(kids.alias("kids"))
        joined = F.array_join(F.transform("kids", lambda x: x["h"]), "")
        h = F.when(F.shiftright("last", k) == 0, F.col("kids")[0]["h"]).otherwise(digest(joined))
        out = out.select("g", "last", "block", *names[k + 1:], F.struct(h.alias("h"), "kids").alias("node"))
    return out.withColumnRenamed("node", "tree")


def _paths(blocks: DataFrame, given: DataFrame, digits: int) -> DataFrame:
    """(g, at, node, path, top) of every node of ``blocks``, from the path and top of each block's root (``given``: g, at, path, top)."""
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    first = lambda c: F.first(c, ignorenulls=True).alias(c)
    both = blocks.select("g", "block", "last", "tree", none(given, "path"), none(given, "top")).unionAll(
        given.select("g", "at", none(blocks, "last"), none(blocks, "tree"), "path", "top"))
    out = both.groupBy("g", "block").agg(*map(first, ("last", "tree", "path", "top"))).select("g", "last", F.col("block").alias("at"), F.col("tree").alias("node"), "path", "top")
    for k in reversed(range(digits)):
        h = lambda i: F.coalesce(F.get("node.kids", i)["h"], F.lit(""))
        empty = F.lit("")
        alone = F.shiftright("last", k) == 0
        step = lambda i: F.when(F.lit(i) == 0, F.struct(empty.alias("left"), h(F.lit(1)).alias("right"))).otherwise(F.struct(h(F.lit(0)).alias("left"), empty.alias("right")))
        down = lambda kid, i: F.struct(kid.alias("node"), F.when(i == 0, step(0)).otherwise(step(1)).alias("step"), i.alias("i"))
        out = out.select("g", "last", "at", "path", "top", alone.alias("alone"), F.explode(F.transform("node.kids", down)).alias("kid")).select(
            "g", "last", (F.shiftleft("at", 1) + F.col("kid.i")).alias("at"), F.col("kid.node").alias("node"),
            F.when(F.col("alone"), F.col("path")).otherwise(F.concat(F.array("kid.step"), "path")).alias("path"), "top")
    return out.drop("last")


def _rolled(nodes: DataFrame, digits: int, name: str) -> list[DataFrame]:
    """The blocks of every rollup, from the leaves up, until each group has one block."""
    stages = []
    while True:
        stages.append(stored(_blocks(nodes, digits), name))
        last = stages[-1].agg(F.max("last")).first()[0]
        if last is None or last >> digits == 0:
            return stages
        nodes = stages[-1].select("g", F.shiftright("last", digits).alias("last"), F.col("block").alias("at"), F.struct(F.col("tree.h").alias("h")).alias("node"))


def _descended(stages: list[DataFrame], given: DataFrame, digits: int) -> DataFrame:
    """(g, at, node, path, top) of the leaves."""
    for blocks in reversed(stages):
        given = _paths(blocks, given, digits)
    return given


def _ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with the place ``at`` in their group and the group's ``last`` place."""
    ranked = stored(with_slots(rows, group, order, "at"), "merkle-ranks")
    ends = ranked.groupBy(group).agg(F.max("at").alias("last"))  # one row a group
    return ranked.join(ends, group)


def prove(rows: DataFrame, id_col: str, group_col: str, leaf_col: str, digits: int = DIGITS) -> DataFrame:
    """``rows`` with subroot, root and path, the steps (left, right) from the leaf to the root.

    ``leaf_col`` has each row's digest as hex text. Groups are strings; leaves stand in order of id (null first; ties by
    digest), groups in order of their UTF-8 bytes (null first, a group like any other). Repeated rows are a leaf each. An
    empty table has no row. Columns of the names subroot, root and path are replaced.
    """
    names = rows.columns
    kept = [c for c in names if c.lower() not in ("subroot", "root", "path")]
    key = F.coalesce(F.concat(F.lit("1"), rows[group_col].cast("string")), F.lit("0"))
    keyed = rows.select(key.alias("g"), rows[id_col].alias("id"), rows[leaf_col].alias("h"), F.struct(*[rows[c].alias(f"c{i}") for i, c in enumerate(kept)]).alias("rest"))
    leaves = _ranked(keyed, "g", ["id", "h"]).select("g", "last", "at", F.struct("h", "rest").alias("node"))
    stages = _rolled(leaves, digits, "merkle-blocks")
    # every group's root is a leaf of the last tree, whose own path starts empty
    subroots = stages[-1].select(F.lit("").alias("all"), F.col("g").alias("of"), F.col("tree.h").alias("h"))
    nodes = _ranked(subroots, "all", ["of"]).select(F.col("all").alias("g"), "last", "at", F.struct("h", "of").alias("node"))
    upper = _rolled(nodes, digits, "merkle-groups")
    start = upper[-1].select("g", F.col("block").alias("at"), F.array().cast(f"array<{STEP}>").alias("path"), F.col("tree.h").alias("top"))
    tops = _descended(upper, start, digits)
    given = tops.select(F.col("node.of").alias("g"), F.lit(0).cast("bigint").alias("at"), "path", F.struct(F.col("node.h").alias("subroot"), F.col("top").alias("root")).alias("top"))
    found = _descended(stages, given, digits)
    return found.select(*[F.col("node.rest")[f"c{i}"].alias(c) for i, c in enumerate(kept)], "top.subroot", "top.root", "path")

