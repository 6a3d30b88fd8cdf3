"""Sharding by jump consistent hashing.

The shard depends on the key and the number of shards only. There is no table
of the ring: a linear congruential generator seeded with the key jumps from one
shard count at which the key would move to the next. Going from n to n + 1
shards moves one key in n + 1, and only into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from gridloom.llm.words import packed, unpacked
from gridloom.session import cut_lineage

# fixed values: the generator of the published algorithm
MULTIPLIER = 2862933555777941757
LAW = "key"


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard 0 to ``shards`` - 1 of each unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    last = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        last[live] = ahead[live]
        state[live] = state[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        step = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[live] = ((last[live] + 1) * step).astype(np.int64)
        live = live[ahead[live] < shards]
    return last


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a BIGINT key; a null key is key 0. Other types: hash them to BIGINT first."""

    @F.pandas_udf(T.IntegerType())
    def run(k: pd.Series) -> pd.Series:
        return pd.Series(jump(k.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return run(F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")))


def assign(rows: DataFrame, key_col: str, shards: int, into: str = "shard", grown: str | None = None) -> DataFrame:
    """``rows`` with the shard of each row in column ``into``, without any shuffle.

    ``grown`` names a further column for the shard once one more shard is there.
    Equal keys share a shard; null keys are key 0; repeated rows share theirs. A column of
    the same name that is there already is replaced.
    """
    made = {into: shard_of(rows[key_col], shards)} | ({grown: shard_of(rows[key_col], shards + 1)} if grown else {})
    taken = {n.lower() for n in made}
    return rows.select(*[rows[c] for c in rows.columns if c.lower() not in taken], *[c.alias(n) for n, c in made.items()])


def with_slots(rows: DataFrame, shard_col: str, order: list[str], into: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in ``order`` (nulls first; ties: any order).

    No window runs over a whole shard: rows are range-partitioned by shard and
    order, so a large shard spans many tasks, and each partition adds what the
    partitions before it hold. Pass narrow rows only. The table of counts has at most
    one row for each partition and shard that meet, partitions + shards - 1 in all.
    A column ``into`` that is there already is replaced.
    """
    names = rows.columns
    keys = ["s", *(f"o{i}" for i in range(len(order)))]
    narrow = cut_lineage(packed(rows, s=rows[shard_col], **{f"o{i}": rows[c] for i, c in enumerate(order)}))  # range partitioning reads its input twice
    spread = narrow.withColumn("tie", F.monotonically_increasing_id())
    fixed = cut_lineage(spread.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie").select("_row", "s"))
    low = (1 << 33) - 1
    at = F.monotonically_increasing_id()
    placed = fixed.select("_row", "s", F.shiftright(at, 33).alias("part"), at.bitwiseAND(F.lit(low)).alias("place"))
    counts = placed.groupBy("s", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("s", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    joined = placed.join(F.broadcast(offsets), ["s", "part"])
    return joined.select(*unpacked(names, (into,)), (F.col("place") + F.col("shift")).alias(into))
