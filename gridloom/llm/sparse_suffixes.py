"""Passages that repeat, by sparse suffix arrays over word minimisers.

Any passage of ``least`` words shows the same minimiser at each of its places: the
smallest hash of its K-word sequences. Only suffixes at those positions are retained,
about one in twenty. Each carries the windows of ``least`` words that it stands for:
those whose minimiser it is, one after the other.

1. The retained suffixes are sorted by their first K words and then by all the words
   that their windows reach over, and neighbours are compared. A run of equal ones is
   a passage with equal surroundings, settled as it is.
2. A suffix whose first K words also begin a different one is extended to both sides:
   its windows, read from the text, are compared one by one with those of the others.
   One suffix stands in for its whole run of equal ones, so copies aren't expanded.

Both steps together give exactly the windows that stand at two or more places. The
place with the smallest (doc_id, row key, position) keeps a window, the others lose it.

Sorting is by ranges, so a sequence that a third of all documents share spreads over
many tasks; runs that touch the edge of a task are put together again by aggregation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.llm.words import numbered, packed, pieces, stored, texts_of, tidy

LEAST = 50  # words of the shortest passage that counts
K = 10      # words of a minimiser; LEAST - K + 1 sequences are in a window, 63 at most
BASE = 0x9E3779B97F4A7C15  # odd


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """Hashes of any stretch of words of texts laid end to end."""

    def __init__(self, texts: list[bytes]):
        numbers, self.starts, vocab = numbered(t.split() for t in texts)
        digest = xxhash.xxh64_intdigest
        own = np.fromiter((digest(w) for w in vocab), np.uint64, len(vocab))
        n = len(numbers)
        power = np.full(n + 1, BASE, np.uint64)
        back = np.full(n + 1, pow(BASE, -1, 1 << 64), np.uint64)
        power[0] = back[0] = 1
        self.back = np.cumprod(back)
        self.sums = np.zeros(n + 1, np.uint64)
        if n:
            np.cumsum(own[numbers] * np.cumprod(power)[:n], out=self.sums[1:])

    def __call__(self, first: np.ndarray, size) -> np.ndarray:
        return _mix((self.sums[first + size] - self.sums[first]) * self.back[first] + np.uint64(1))


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value of each window of ``width``."""
    if len(values) < width:
        return np.empty(0, np.int64)
    best, at, span = values, np.arange(len(values)), 1

    def merged(best, at, shift):
        n = len(best) - shift
        left = best[:n] <= best[shift:]
        return np.where(left, best[:n], best[shift:]), np.where(left, at[:n], at[shift:])

    while 2 * span <= width:
        best, at = merged(best, at, span)
        span *= 2
    if span < width:
        best, at = merged(best, at, width - span)
    return at


def retained(hashed: Hashed, least: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, position, first window, windows) of each suffix retained, positions counted over all texts."""
    starts = hashed.starts
    n = int(starts[-1])
    none = (np.empty(0, np.int64),) * 4
    if n < least:
        return none
    at = leftmost_minima(hashed(np.arange(n - k + 1), k), least - k + 1)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(at)]
    first = np.arange(len(at))
    inside = first + least <= starts[text + 1]
    at, text, first = at[inside], text[inside], first[inside]
    if not len(at):
        return none
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    return text[head], at[head], first[head], np.diff(np.append(head, len(at)))


def with_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, doc_id, text): rows with the same id and text share a key and count as one document."""
    return docs.select(F.xxhash64(docs[id_col], docs[text_col]).alias("key"), docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def suffixes(rows: DataFrame, least: int, k: int) -> DataFrame:
    """(h, s, doc_id, key, a, n) of each suffix retained: hash of its first words, of all that its n windows from word a reach over."""
    schema = T.StructType([
        T.StructField("h", T.LongType()), T.StructField("s", T.LongType()), T.StructField("doc_id", rows.schema["doc_id"].dataType),
        T.StructField("key", T.LongType()), T.StructField("a", T.IntegerType()), T.StructField("n", T.IntegerType())])

    def run(batches):
        for table in pieces(batches, 2 << 20):
            hashed = Hashed(texts_of(table))
            text, at, first, n = retained(hashed, least, k)
            if not len(text):
                continue
            where = _mix(((at - first) * 64 + n).astype(np.uint64))
            own = table.select(["doc_id", "key"]).take(pa.array(text))
            cols = [hashed(at, k).view(np.int64), (hashed(first, n - 1 + least) ^ where).view(np.int64)]
            rest = [(first - hashed.starts[text]).astype(np.int32), n.astype(np.int32)]
            made = pa.Table.from_arrays([pa.array(cols[0]), pa.array(cols[1]), own["doc_id"], own["key"], pa.array(rest[0]), pa.array(rest[1])], names=schema.names)
            yield from made.combine_chunks().to_batches(max_chunksize=1 << 17)

    return rows.select("key", "doc_id", "text").mapInArrow(run, schema)


HOLD = 1 << 17  # rows of an open run held back before it is sent on unsettled
NEAR, OPEN, SEEN = 0, 1, 2  # settled suffix, suffix of an unsettled run, what a task has seen of such a run


def _runs(table: pa.Table, schema, settled: bool) -> pa.Table:
    """Judge whole runs (``settled``), or pass rows on with a summary of each of their runs, to be judged later."""
    h, s, key, a = (table[c].to_numpy() for c in ("h", "s", "key", "a"))
    new_h = np.ones(len(h), bool)
    new_h[1:] = h[1:] != h[:-1]
    new_s = new_h.copy()
    new_s[1:] |= s[1:] != s[:-1]
    head_s = np.flatnonzero(new_s)
    if not settled:
        last = np.append(head_s[1:], len(h)) - 1
        ends = [table.take(pa.array(at)) for at in (head_s, last)]
        out = table
        for name in ("f_doc", "f_key", "f_a", "many", "other"):
            out = out.append_column(schema.field(name), pa.nulls(len(h), schema.field(name).type))
        out = out.append_column("kind", pa.array(np.full(len(h), OPEN, np.int32)))
        seen = ends[0].append_column(schema.field("f_doc"), ends[1]["doc_id"]).append_column("f_key", ends[1]["key"]).append_column("f_a", ends[1]["a"])
        none = pa.nulls(len(head_s), pa.bool_())
        seen = seen.append_column("many", none).append_column("other", none).append_column("kind", pa.array(np.full(len(head_s), SEEN, np.int32)))
        return pa.concat_tables([out, seen])
    new_place = new_s.copy()  # repeated rows are one place
    new_place[1:] |= (key[1:] != key[:-1]) | (a[1:] != a[:-1])
    head_h = np.flatnonzero(new_h)
    of_h = np.cumsum(new_h, dtype=np.int32) - 1
    keep = np.flatnonzero((np.add.reduceat(new_place, head_h, dtype=np.int32) > 1)[of_h])
    other = (np.add.reduceat(new_s, head_h, dtype=np.int32) > 1)[of_h[keep]]
    of_s = (np.cumsum(new_s, dtype=np.int32) - 1)[keep]
    many = (np.add.reduceat(new_place, head_s, dtype=np.int32) > 1)[of_s]
    first = table.select(["doc_id", "key", "a"]).take(pa.array(head_s[of_s]))
    out = table.take(pa.array(keep))
    for name, col in (("f_doc", first["doc_id"]), ("f_key", first["key"]), ("f_a", first["a"]), ("many", pa.array(many)), ("other", pa.array(other)), ("kind", pa.array(np.full(len(keep), NEAR, np.int32)))):
        out = out.append_column(name, col)
    return out


def neighbours(batches, schema, hold: int):
    """Judge the suffixes of one sorted range piece by piece, with the last run of each piece held back.

    The first and the last run of a range may go on in the next one, and a run of more than ``hold`` rows isn't
    held: these leave unsettled, with a summary for each piece. Memory is bounded by piece and ``hold``.
    """
    held, loose = None, None  # the open run; the first words whose run leaves unsettled
    for table in pieces(batches, 4 << 20):
        table = table if held is None else pa.concat_tables([held, table])
        h = table["h"].to_numpy()
        if loose is None:
            loose = h[0]  # the first run of the range
        start = int(np.searchsorted(h != loose, True)) if h[0] == loose else 0
        if start:
            yield _runs(table.slice(0, start), schema, False)
        if start == len(h):
            held = None
            continue
        last = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[-1] != h[start] else start
        if last > start:
            yield _runs(table.slice(start, last - start), schema, True)
        held = table.slice(last)
        if len(held) > hold:
            yield _runs(held, schema, False)
            loose, held = h[-1], None
        else:
            held = pa.Table.from_batches(held.combine_chunks().to_batches())
    if held is not None:
        yield _runs(held, schema, False)
    tidy()


def compared(found: DataFrame) -> DataFrame:
    """Suffixes whose first words stand at two places or more, with the first place of their run (f_doc, f_key, f_a),
    whether the run has several places (many) and whether other runs share the first words (other)."""
    order = ["h", "s", "doc_id", "key", "a"]
    extra = [T.StructField("f_doc", found.schema["doc_id"].dataType), T.StructField("f_key", T.LongType()), T.StructField("f_a", T.IntegerType()),
             T.StructField("many", T.BooleanType()), T.StructField("other", T.BooleanType()), T.StructField("kind", T.IntegerType())]
    schema = T.StructType([*found.schema.fields, *extra])

    def run(batches):
        schema_ = to_arrow_schema(schema)
        for table in neighbours(batches, schema_, HOLD):
            yield from table.combine_chunks().to_batches(max_chunksize=1 << 16)

    done = stored(found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), "suffix-neighbours")
    # runs that left unsettled, put together from what their tasks have seen of them
    place, last = F.struct("doc_id", "key", "a"), F.struct(F.col("f_doc").alias("doc_id"), F.col("f_key").alias("key"), F.col("f_a").alias("a"))
    runs = done.where(F.col("kind") == SEEN).groupBy("h", "s").agg(F.min(place).alias("_f"), F.max(last).alias("_l"))
    heads = runs.groupBy("h").agg((F.count(F.lit(1)) > 1).alias("_other"))
    ends = stored(runs.join(heads, "h").select("h", "s", "_f", (F.col("_f") != F.col("_l")).alias("_many"), "_other").where("_many or _other"), "suffix-edges")
    # settled runs have no row in ``ends``, which is small: two runs of each range, and the long ones
    joined, late = done.where(F.col("kind") != SEEN).join(ends, ["h", "s"], "left"), F.col("kind") == OPEN
    new = {"f_doc": "_f.doc_id", "f_key": "_f.key", "f_a": "_f.a", "many": "_many", "other": "_other"}
    return joined.select(*found.columns, *[F.when(late, F.col(e)).otherwise(F.col(c)).alias(c) for c, e in new.items()]).where("many or other")


def numbered_suffixes(near: DataFrame) -> DataFrame:
    """(u, key, s, a, n): one suffix of each run that shares its first words with others, numbered in order of place.

    64 u + i is thus one number for the place of window i, in the same order as (doc_id, key, word).
    """
    first = F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("key") == F.col("f_key")) & (F.col("a") == F.col("f_a"))
    order = ["doc_id", "key", "a"]
    wanted = near.where(F.col("other") & first).select(*order, "s", "n").distinct()
    return stored(wanted.repartitionByRange(*order).sortWithinPartitions(*order).select(F.monotonically_increasing_id().alias("u"), "key", "s", "a", "n"), "suffix-wanted")


def extended(rows: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """(w, p): hash and place of each window of the suffixes ``wanted`` (u, key, a, n), read from the texts."""
    per_doc = wanted.groupBy("key").agg(F.collect_list(F.struct("u", "a", "n")).alias("_todo"))  # no more than a text's own suffixes
    # the lists are the smaller side; hashed, so that the texts needn't be sorted
    joined = rows.select("key", "text").join(per_doc.hint("shuffle_hash"), "key").select("text", "_todo")
    schema = T.StructType([T.StructField("w", T.LongType()), T.StructField("p", T.LongType())])

    def run(batches):
        for table in pieces(batches, 2 << 20):
            hashed = Hashed(texts_of(table))
            todo = table["_todo"].combine_chunks()
            todo = todo if isinstance(todo, pa.Array) else pa.concat_arrays(todo.chunks)
            text = np.repeat(np.arange(len(todo)), todo.value_lengths().to_numpy())
            flat = todo.flatten()
            u, a, n = (flat.field(x).to_numpy() for x in range(3))
            for lo in range(0, len(n), 4096):
                own = slice(lo, lo + 4096)
                size = n[own].astype(np.int64)
                row = np.repeat(np.arange(len(size)), size)
                i = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                w = hashed((hashed.starts[text[own]] + a[own])[row] + i, least).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(u[own][row] * 64 + i)], names=schema.names)

    return joined.mapInArrow(run, schema)


def repeated_windows(rows: DataFrame, least: int = LEAST, k: int = K) -> DataFrame:
    """(doc_id, key, a, lose, keep) of each retained suffix with repeated windows: bit i tells of the window at word a + i."""
    found = stored(suffixes(rows, least, k), "suffixes")
    near = stored(compared(found), "suffix-runs")
    wanted = numbered_suffixes(near)
    windows = stored(extended(rows, wanted, least), "suffix-windows")
    # both are written, so that the joins below are plain ones, whose hot keys Spark can split
    twice = stored(windows.groupBy("w").agg(F.min("p").alias("_f"), F.max("p").alias("_l")).where("_f <> _l").select(F.col("w").alias("_w"), "_f"), "suffix-twice")
    bit, none = F.expr("shiftleft(1L, cast(p & 63 as int))"), F.lit(0).cast("bigint")
    marked = windows.join(twice, windows["w"] == twice["_w"]).groupBy(F.expr("shiftright(p, 6)").alias("u")).agg(
        F.bit_or(bit).alias("_all"), F.bit_or(F.when(F.col("p") == F.col("_f"), bit).otherwise(none)).alias("_first"))
    marked = stored(marked.join(wanted.select("u", F.col("s").alias("_s")), "u").select("_s", "_all", "_first"), "suffix-marks")
    joined = near.join(marked, near["s"] == marked["_s"], "left")
    first = F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("key") == F.col("f_key")) & (F.col("a") == F.col("f_a"))
    full = F.expr("shiftleft(1L, n) - 1")
    there, kept_here = F.coalesce("_all", none), F.coalesce("_first", none)
    again = F.when(F.col("many"), full).otherwise(there)
    keeps = F.when(first, kept_here.bitwiseOR(full.bitwiseAND(F.bitwise_not(there)))).otherwise(none)
    out = joined.select("doc_id", "key", "a", again.bitwiseAND(F.bitwise_not(keeps)).alias("lose"), again.bitwiseAND(keeps).alias("keep"))
    return out.where("lose <> 0 or keep <> 0")


def spans_of(owner: np.ndarray, a: np.ndarray, bits: np.ndarray, owners: int, least: int) -> pa.Array:
    """Each owner's union of the windows whose bits are set, as a list of (first word, words)."""
    own, at = [], []
    for lo in range(0, len(bits), 1 << 14):
        part = slice(lo, lo + (1 << 14))
        row, i = np.nonzero(np.unpackbits(bits[part].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        own.append(owner[part][row])
        at.append(a[part][row] + i)
    own, at = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (own, at))
    by = np.lexsort((at, own))
    own, at = own[by], at[by]
    new = np.ones(len(at), bool)
    new[1:] = (own[1:] != own[:-1]) | (at[1:] > at[:-1] + least)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(at))[:len(head)] - 1  # none where no bit is set
    values = pa.StructArray.from_arrays([pa.array(at[head].astype(np.int32)), pa.array((at[last] + least - at[head]).astype(np.int32))], names=["first_word", "n"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(own[head], np.arange(owners + 1)).astype(np.int32)), values)


SPANS = "array<struct<first_word:int,n:int>>"


def passages(rows: DataFrame, least: int = LEAST, k: int = K) -> DataFrame:
    """(key, doc_id, lose, keep) of each document with repeated passages: word spans that it loses, and that it keeps as the first."""
    marks = repeated_windows(rows, least, k).groupBy("key", "doc_id").agg(F.collect_set(F.struct("a", "lose", "keep")).alias("_m"))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", rows.schema["doc_id"].dataType), *T._parse_datatype_string(f"lose {SPANS}, keep {SPANS}").fields])

    def run(batches):
        for table in pieces(batches, 2 << 20):
            for batch in table.combine_chunks().to_batches():
                marks_ = batch.column("_m")
                owner = np.repeat(np.arange(len(marks_)), marks_.value_lengths().to_numpy())
                a, lose, keep = (marks_.flatten().field(x).to_numpy() for x in range(3))
                cols = [spans_of(owner, a.astype(np.int64), x, len(marks_), least) for x in (lose, keep)]
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), *cols], names=schema.names)

    return marks.mapInArrow(run, schema)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, k: int = K) -> DataFrame:
    """(doc_id, first_word, n_words, kept): every passage of ``least`` words or more that stands at two places or more.

    Words are what white space (x20, x09-x0D) separates; a passage may repeat between or within documents. ``kept`` marks
    the first of its places, in order of id (null first), row key and position. Rows with equal id and text are one document,
    told once. Null, empty and shorter texts have none; other columns aren't read.
    """
    if not 0 < k <= least <= k + 62:
        raise ValueError("least must be from k to k + 62")
    found = passages(with_keys(docs, id_col, text_col), least, k)
    one = lambda col, kept: F.transform(col, lambda x: F.struct(x["first_word"].alias("first_word"), x["n"].alias("n"), F.lit(kept).alias("kept")))
    return found.select("doc_id", F.explode(F.concat(one("lose", False), one("keep", True))).alias("_x")).select(
        "doc_id", F.col("_x.first_word").cast("bigint").alias("first_word"), F.col("_x.n").cast("bigint").alias("n_words"), "_x.kept")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, k: int = K) -> DataFrame:
    """``docs`` with every passage cut from its texts but at its first place; rows and other columns stay.

    The white space before a passage goes with it. Texts without a repeated passage are left as they are.
    """
    rows = with_keys(docs, id_col, text_col)
    found = stored(passages(rows, least, k).where(F.size("lose") > 0).select("key", "lose"), "suffix-cuts")

    names = docs.columns
    place = names.index(next(c for c in names if c.lower() == text_col.lower()))
    keyed = packed(docs, key=F.xxhash64(docs[id_col], docs[text_col]))
    joined = keyed.join(found, "key", "left").select("_row.*", "lose")
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(names)])

    def run(batches):
        for table in pieces(batches, 4 << 20):
            for batch in table.to_batches():
                cols = [batch.column(f"c{i}") for i in range(len(names))]
                lose = batch.column("lose")
                if lose.null_count < len(lose):
                    texts = cols[place]
                    cols[place] = pa.array((_cut(texts[i].as_py(), x) if (x := lose[i].as_py()) else texts[i].as_py() for i in range(len(texts))), texts.type)
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return joined.mapInArrow(run, schema).toDF(*names)


def _cut(text: str | None, spans) -> str | None:
    """The text without these word spans."""
    if text is None or spans is None or not len(spans):
        return text
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begin = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    end = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    keep = np.ones(len(raw), bool)
    for x in spans:
        first, n = x["first_word"], x["n"]
        keep[end[first - 1] if first else 0:end[first + n - 1]] = False
    return raw[keep].tobytes().decode("utf-8", "surrogatepass")
