"""Stored feature tables, clustered by place, replaced as a whole, appended to once.

The reference keeps a spatial index and a catalogue; here a table is a folder of Parquet files and of loads:

* rows are range-partitioned by the Z-order of their box's centre, so a file holds features that lie
  together; the load's manifest has the box, the rows and the bytes of every file. A query for some tiles reads only
  the files whose boxes meet them, and Parquet's own minima and maxima skip row groups inside.
* a load counts once its manifest is there, which is written last and as one file. ``replace`` starts a
  table anew: readers see the old rows until then, the new ones afterwards. ``append`` of a load that is there
  already does nothing, so a repeated job adds nothing.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.geometry import WORLD_EDGE
from gridloom.functions.tiles import tile_bounds, tile_size

BOX = ["minx", "miny", "maxx", "maxy"]
BITS = 16  # of each coordinate in the key
MANIFEST = "load string, fresh boolean, seq long, file string, rows long, bytes long, minx double, miny double, maxx double, maxy double"


def _spread(v: Column) -> Column:
    """The bits of a 16-bit number with a zero bit between any two."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def z_order(x: Column, y: Column) -> Column:
    """Place on the Z-order curve over the world square; points beyond it count as on its edge."""
    def cell(v):
        at = F.floor((v + WORLD_EDGE) / (2.0 * WORLD_EDGE) * (1 << BITS)).cast("bigint")
        return F.least(F.lit((1 << BITS) - 1).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), at))

    return _spread(cell(x)).bitwiseOR(F.shiftleft(_spread(cell(y)), 1))


def loads(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows of all loads that the table has now: the last fresh one and those after it."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/loads")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], MANIFEST)
    first = rows.where("fresh").agg(F.max("seq")).first()[0]
    return rows if first is None else rows.where(F.col("seq") >= first)


def _write(rows: DataFrame, path: str, load: str, fresh: bool, partitions: int | None) -> None:
    spark = rows.sparkSession
    key = z_order((F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2)
    keyed = rows.withColumn("_z", key)
    dealt = keyed.repartitionByRange(partitions, "_z") if partitions else keyed.repartitionByRange("_z")
    data = f"{path}/data/{uuid.uuid4().hex}"
    dealt.sortWithinPartitions("_z").drop("_z").write.parquet(data)
    stored = spark.read.schema(rows.schema).parquet(data)
    files = stored.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), *[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in BOX])
    # one row a file; also of an empty load, so that it counts
    named = files.select(F.lit(load).alias("load"), F.lit(fresh).alias("fresh"), F.lit(time.time_ns()).alias("seq"), "file", "rows", "bytes", *BOX)
    empty = spark.range(1).select(F.lit(load).alias("load"), F.lit(fresh).alias("fresh"), F.lit(time.time_ns()).alias("seq"), F.lit(None).cast("string").alias("file"),
                                  F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("bytes"), *[F.lit(None).cast("double").alias(c) for c in BOX])
    (named if stored.limit(1).count() else empty).coalesce(1).write.mode("append").parquet(f"{path}/loads")


def replace(rows: DataFrame, path: str, load: str, partitions: int | None = None) -> None:
    """Start the table anew with these rows (with columns minx, miny, maxx, maxy); no row may lack its box."""
    _write(rows, path, load, True, partitions)


def append(rows: DataFrame, path: str, load: str, partitions: int | None = None) -> bool:
    """Add the rows of ``load``, unless the table has that load; True if they were added."""
    if loads(rows.sparkSession, path).where(F.col("load") == load).limit(1).count():
        return False
    _write(rows, path, load, False, partitions)
    return True


def files_for(spark: SparkSession, path: str, tiles: DataFrame | None = None, buffer_frac: float = 0.0) -> DataFrame:
    """(file) whose boxes meet one of the ``tiles`` (z, x, y), widened by the buffer; all files without tiles."""
    own = loads(spark, path).where(F.col("file").isNotNull())
    if tiles is None:
        return own.select("file").distinct()
    tb, b = tile_bounds(), tile_size("z") * buffer_frac
    boxes = tiles.select((tb["tminx"] - b).alias("x0"), (tb["tmaxx"] + b).alias("x1"), (tb["tminy"] - b).alias("y0"), (tb["tmaxy"] + b).alias("y1"))
    # the wanted tiles' own extent: a few numbers, whatever the number of tiles
    box = boxes.agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1")).first()
    if box["x0"] is None:
        return own.where("false").select("file")
    meets = (F.col("maxx") >= box["x0"]) & (F.col("minx") <= box["x1"]) & (F.col("maxy") >= box["y0"]) & (F.col("miny") <= box["y1"])
    return own.where(meets).select("file").distinct()


def read(spark: SparkSession, path: str, schema, tiles: DataFrame | None = None, buffer_frac: float = 0.0) -> DataFrame:
    """The table's rows, from the files that meet the ``tiles`` only (features beside them may be among the rows)."""
    names = [r["file"] for r in files_for(spark, path, tiles, buffer_frac).collect()]  # file names, as any reader lists them
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*names)


def size_report(spark: SparkSession, path: str) -> DataFrame:
    """(load, files, rows, bytes) of the table as it is now."""
    return loads(spark, path).groupBy("load").agg(F.count("file").alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
