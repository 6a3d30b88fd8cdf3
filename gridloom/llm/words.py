"""Helpers shared by the operators: words, batches, scratch folders.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; these are
exactly the bytes on which ``bytes.split()`` splits, and none of them occurs
inside a multi-byte UTF-8 character.
"""

from __future__ import annotations

import ctypes
import re
import sys
import types
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import ensure_checkpoint_dir


class Vocab(dict):
    """word -> number in order of first sight."""

    def __missing__(self, word):
        number = len(self)
        self[word] = number
        return number


def kept(name: str, make):
    """The object ``make()`` returns, made once in each worker process."""
    store = sys.modules.setdefault("_gridloom_worker", types.ModuleType("_gridloom_worker")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def tidy() -> None:
    """Give freed memory back to the system: idle Python workers live on beside the next task's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def pieces(batches, limit: int = 16 << 20):
    """Regroup Arrow batches into tables of about ``limit`` bytes, in order.

    No row is cut; one row longer than ``limit`` is a table of its own.
    """
    held, size = [], 0
    for batch in batches:
        step = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            part_size = part.get_total_buffer_size() if batch.num_rows <= step else part.nbytes
            if held and size + part_size > limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(part)
            size += part_size
    if held:
        yield pa.Table.from_batches(held)
        held = []
    tidy()


def texts_of(table: pa.Table, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [t or b"" for t in table.column(column).cast(pa.binary()).to_pylist()]


def numbered(word_lists) -> tuple[np.ndarray, np.ndarray, Vocab]:
    """Word numbers of all lists on end, the start of each list (one more than lists), the vocabulary."""
    vocab = Vocab()
    get, numbers, starts = vocab.__getitem__, [], [0]
    for words in word_lists:
        numbers.extend(map(get, words))
        starts.append(len(numbers))
    return np.array(numbers, dtype=np.int64), np.array(starts, dtype=np.int64), vocab


ARROW_BYTES = 4 << 20


def lean(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches between Spark and Python by bytes.

    The usual bound is ten thousand rows, which for whole texts means tens of MB at once in
    each of several buffers of every task, outside the heap. A smaller bound of the session stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
    if not held or int(held[1]) > ARROW_BYTES:
        spark.conf.set(key, f"{ARROW_BYTES}b")
    return spark


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """``df`` as one column ``_row`` besides the ``named`` ones, so no column's name can clash with another's."""
    row = F.struct(*[df[c].alias(f"c{i}") for i, c in enumerate(df.columns)])
    return df.select(row.alias("_row"), *[c.alias(n) for n, c in named.items()])


def unpacked(names: list[str], skip: tuple[str, ...] = ()) -> list[Column]:
    """The columns of :func:`packed` again, but those whose names are in ``skip``."""
    gone = {s.lower() for s in skip}
    return [F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(names) if c.lower() not in gone]


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared folder in spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
