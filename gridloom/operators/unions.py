"""S19 typed union-load and U1/U2 unions.

``typed_union`` casts every source to one declared schema and unions by
name (never by position), then numbers rows like a serial key: by source
order, then by the given key -- a global numbering done with range
partitioning and partition offsets, not a single-task window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.labels import global_row_number


def typed_union(sources: list[DataFrame], schema: T.StructType, order_key: str, gid: str = "gid") -> DataFrame:
    cast = []
    for i, df in enumerate(sources):
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        cast.append(df.select(F.lit(i).alias("_src"), F.col(order_key).alias("_k"), *cols))
    u = reduce(DataFrame.unionByName, cast)
    return global_row_number(u, [F.col("_src"), F.col("_k")], gid).drop("_src", "_k")
