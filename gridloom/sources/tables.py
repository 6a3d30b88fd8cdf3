"""Driver table scans (Parquet, one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Column pruning and filters reach the Parquet scan through Catalyst."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


SPREAD_ROWS = 20_000  # rows of a task, where each row becomes a geometry many times its size in the file


def spread(df: DataFrame, *by: str, rows: int = SPREAD_ROWS, count: int | None = None) -> DataFrame:
    """The same rows in as many tasks as their number (``count``, where known) asks for, dealt by ``by`` where given.

    Files are split by their compressed bytes, so a small file of many narrow rows is one task, however
    much each row grows behind the scan. Tables of a few tasks' rows stay as they are.
    """
    tasks = -(-(df.count() if count is None else count) // rows)  # Parquet: read from the footers
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) and by or tasks <= 1:
        return df
    return df.repartition(tasks, *by)


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
