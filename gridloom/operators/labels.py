"""A8 ``DISTINCT ON (pop, name)`` and W2 global numbering, without one task.

W2: a global ``row_number() over (order by ...)`` is a single-partition
window in Spark. Instead the rows are range-partitioned on the order key,
sorted inside each partition, numbered locally, and shifted by the row counts
of all earlier partitions (a table with one row per partition, so its
broadcast is bounded by the partition count, not by the data).

A8: one row per (pop, name) -- the smallest osm_id -- by a partial-aggregation
``min`` of a struct, so a name shared by a third of the rows is still a
map-side combine, not a sort of that group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id in the upper bits


def global_row_number(df: DataFrame, order: list, name: str = "gid", partitions: int | None = None) -> DataFrame:
    """Adds a 1-based dense position in ``order`` (ties must be broken by the caller).

    The number of ranges is Spark's own choice by size unless ``partitions`` is
    given. Choosing the ranges reads the input once more, so it is written first.
    """
    df = cut_lineage(df)
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = cut_lineage(dealt.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid") - F.shiftleft(part, _LOCAL_BITS)
    counts = ranged.groupBy(part.alias("_p")).agg(F.count("*").alias("_c"))
    offs = counts.select("_p", (F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))
                         .alias("_off"))
    out = ranged.join(F.broadcast(offs), part == F.col("_p"))
    return out.select(*df.columns, (F.coalesce("_off", F.lit(0)) + local + 1).alias(name))


def first_labels(labels: DataFrame) -> DataFrame:
    """A8 alone: of the rows that share (pop, name), NULLs included, the one with the smallest osm_id."""
    rest = [c for c in labels.columns if c not in ("pop", "name", "osm_id")]
    best = labels.groupBy("pop", "name").agg(F.min(F.struct("osm_id", *rest)).alias("_b"))
    return best.select(*[F.col(c) if c in ("pop", "name") else F.col(f"_b.{c}").alias(c) for c in labels.columns])


def dedup_labels(labels: DataFrame) -> DataFrame:
    """Number by (pop desc nulls last, name, osm_id), then keep the smallest
    osm_id of each (pop, name) with its number."""
    num = global_row_number(labels, [F.col("pop").desc_nulls_last(), F.col("name").asc_nulls_last(), F.col("osm_id")])
    rest = [c for c in num.columns if c not in ("pop", "name")]
    best = num.groupBy("pop", "name").agg(F.min(F.struct("osm_id", *[c for c in rest if c != "osm_id"])).alias("_b"))
    return best.select("pop", "name", *[F.col("_b." + c).alias(c) for c in rest])
