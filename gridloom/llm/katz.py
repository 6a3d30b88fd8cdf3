"""Katz back-off language model over words, trained and applied in one go.

P(w | h) = d(r) r / c(h) if h w was seen r > 0 times, else alpha(h) P(w); a context never seen has
alpha 1. P(w) = d1(c) c / N for words seen c times; what discounting leaves is the probability of
the unknown word. d is Good-Turing: (r + 1) n(r + 1) / (r n(r)) for r up to 5 where that lies
between 0 and 1, and for other r the same from a log-log line through the counts of counts, so
every r is discounted and every context has something left. alpha(h) is what the context's
bigrams leave, divided by what their words leave in P: each conditional distribution sums to one.

How the work is dealt
---------------------
Occurrences (h, w, document) go once through the shuffle, to the bucket of w, packed by
batch and bucket (sorted, delta-coded words; a plain row for each would not fit the disk). A
bucket then has all counts of its words and of the bigrams that end in them, which is the
model's table; a document's score is linear in what a bucket knows, given sums that are known
only at the end (N, the discounts), so a bucket returns a few numbers for each document.
Bigrams not seen in training are sent on to the bucket of h, where the back-off weights are
made, and the parts meet by batch. Words so frequent that a bucket would be too large (found
in a bounded sample; only the balance depends on it) are dealt by w and h; their own totals are few
numbers, added up apart. Bigrams as frequent as that aren't dealt at all: how often each document
has them stays with the batch, as do unseen bigrams of frequent contexts, and what these add
is reckoned where the batch's parts meet.

Tables written: ``bigrams`` and ``contexts``, by bucket (see :func:`bigram_rows`, :func:`context_rows`).
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.words import numbered, pieces, scratch, stored, texts_of, tidy

END = xxhash.xxh64_intdigest(b" end")      # no word has a space
START = xxhash.xxh64_intdigest(b" start")
TURING = 5                 # counts up to this are discounted by their own counts of counts
BUCKET_BYTES = 24 << 20    # of text whose occurrences make a bucket; only the memory of a task depends on it
BATCH_BYTES = 16 << 20
SAMPLE_DOCS = 2_000        # expected size of the sample in which frequent words are looked for
FEW = 8                    # bigrams of a context that a bucket sends singly; more are added up first

COUNTS = ["k1", "k2", "k3", "k4", "k5", "known", "u1", "u2", "u3", "u4", "u5", "useen", "uoov"]
SUMS = ["a", "s", "s1", "b"]
UNIT = float(1 << 30)      # sums are sent as multiples of 2^-30


# ---------------------------------------------------------------- packing

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers (or floats), each with its bytes sorted by significance, compressed."""
    out = [struct.pack("<H", len(arrays))]
    for x in arrays:
        if x.dtype.kind == "f":
            kind, y = 9, x.astype("<f8")
        else:
            top = int(x.max()) if len(x) else 0
            size = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
            kind, y = size, x.astype(f"<u{size}")
        out.append(struct.pack("<BQ", kind, len(y)))
        out.append(np.ascontiguousarray(y.view(np.uint8).reshape(len(y), -1).T).tobytes() if len(y) else b"")
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (count,), at, out = struct.unpack_from("<H", raw), 2, []
    for _ in range(count):
        kind, n = struct.unpack_from("<BQ", raw, at)
        at += 9
        size = 8 if kind == 9 else kind
        y = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T
        at += n * size
        y = np.ascontiguousarray(y).reshape(-1).view("<f8" if kind == 9 else f"<u{size}")
        out.append(y if kind == 9 else y.astype(np.uint64) if kind == 8 else y.astype(np.int64))
    return out


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of an ascending array of unsigned 64-bit numbers."""
    return np.diff(x, prepend=x.dtype.type(0)) if len(x) else x


def summed(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x.astype(np.uint64), dtype=np.uint64)


def run_steps(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Differences inside runs in which ``x`` ascends; the first of a run as it is."""
    d = np.diff(x, prepend=0)
    head = np.cumsum(sizes) - sizes
    d[head] = x[head]
    return d


def run_summed(d: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.cumsum(d)
    head = np.cumsum(sizes) - sizes
    return total - np.repeat(total[head] - d[head], sizes)


def signed(x: np.ndarray) -> np.ndarray:
    """Real sums as non-negative integers, signs folded in."""
    n = np.rint(x * UNIT).astype(np.int64)
    return ((n << 1) ^ (n >> 63)).view(np.uint64)


def unsigned(x: np.ndarray) -> np.ndarray:
    n = x.astype(np.uint64)
    return ((n >> np.uint64(1)).astype(np.int64) ^ -(n & np.uint64(1)).astype(np.int64)) / UNIT


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs of equal values."""
    if not len(x):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    head = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return head, np.diff(np.append(head, len(x)))


# ---------------------------------------------------------------- discounts

class Discounts:
    """Good-Turing discounts from counts of counts (ascending r, n(r) > 0)."""

    def __init__(self, r: np.ndarray, n: np.ndarray):
        self.slope = -2.0
        if len(r) > 1:
            before = np.concatenate([[0], r[:-1]])
            after = np.concatenate([r[1:], [2 * r[-1] - r[-2]]])
            z = n / (0.5 * (after - before))
            x, y = np.log(r), np.log(z)
            self.slope = float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum())
        self.slope = min(self.slope, -1.05)
        of = dict(zip(r.tolist(), n.tolist(), strict=True))
        self.low = np.array([self._line(k) for k in range(1, TURING + 1)])
        for k in range(1, TURING + 1):
            if k in of and k + 1 in of and 0 < (own := (k + 1) * of[k + 1] / (k * of[k])) < 1:
                self.low[k - 1] = own

    def _line(self, r):
        return ((r + 1) / r) ** (self.slope + 1)

    def __call__(self, r: np.ndarray) -> np.ndarray:
        r = np.asarray(r, np.float64)
        return np.where(r <= TURING, self.low[np.clip(r, 1, TURING).astype(np.int64) - 1], self._line(np.maximum(r, 1)))


class Totals:
    """What all training documents give: tokens, types, discounts, frequent words' counts."""

    def __init__(self, rows, hot: int, often: int):
        by: dict[str, dict[int, int]] = {"uni": {}, "bi": {}, "hot": {}, "docs": {}, "often": {}}
        for r in rows:
            by[r["what"]][r["r"]] = r["n"]
        self.hot = np.array([by["hot"].get(i, 0) for i in range(hot)], np.int64)
        uni = dict(by["uni"])
        for c in self.hot[self.hot > 0].tolist():
            uni[c] = uni.get(c, 0) + 1
        ordered = lambda d: (np.array(sorted(d), np.float64), np.array([d[k] for k in sorted(d)], np.float64))
        r, n = ordered(uni)
        self.tokens, self.types = int((r * n).sum()), int(n.sum())
        self.docs = by["docs"].get(0, 0)
        self.often = np.array([by["often"].get(i, 0) for i in range(often)], np.int64)
        bi = dict(by["bi"])
        for c in self.often[self.often > 0].tolist():
            bi[c] = bi.get(c, 0) + 1
        self.one, self.two = Discounts(r, n), Discounts(*ordered(bi))
        self.unknown = 1.0 - float((n * r * self.one(r)).sum()) / self.tokens if self.tokens else 1.0

    def word(self, c: np.ndarray) -> np.ndarray:
        """P(w) of words seen c times; the unknown word's for 0."""
        return np.where(c > 0, self.one(np.maximum(c, 1)) * c / max(self.tokens, 1), self.unknown)


# ---------------------------------------------------------------- the four passes

def _frequent(docs: DataFrame, buckets: int, share: float) -> tuple[list[int], list[tuple[int, int]]]:
    """Hashes of words, and of bigrams (h, w), with over a quarter of a bucket's share of the tokens, in a sample; at most 4 x buckets of each."""
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(2)), F.lit(1 << 30)) < int(share * (1 << 30)))
    schema = T.StructType([T.StructField("before", T.BinaryType()), T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches):
        for table in pieces(batches, 4 << 20):
            numbers, starts, vocab = numbered(t.lower().split() for t in texts_of(table))
            names = [*vocab, b" end", b" start"]
            w, h = _places(numbers, starts, len(vocab), len(vocab) + 1)
            n = np.bincount(w, minlength=len(vocab) + 1)
            key, times = np.unique(w * len(names) + h, return_counts=True)
            before = [None] * len(n) + [names[i] for i in (key % len(names)).tolist()]
            word = names[:-1] + [names[i] for i in (key // len(names)).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(before, pa.binary()), pa.array(word, pa.binary()), pa.array(np.concatenate([n, times]), pa.int64())], names=schema.names)

    found = stored(sample.select("text").mapInArrow(run, schema).groupBy("before", "word").agg(F.sum("n").alias("n")), "katz-sample")
    total = found.where("before is null").agg(F.sum("n")).first()[0] or 0
    heavy = found.where(F.col("n") * (4 * buckets) > total).collect()
    digest = lambda x: xxhash.xxh64_intdigest(bytes(x))
    # the words of a frequent bigram are frequent themselves (the start as often as the end)
    return sorted(digest(r["word"]) for r in heavy if r["before"] is None), sorted((digest(r["before"]), digest(r["word"])) for r in heavy if r["before"] is not None)


def _places(numbers: np.ndarray, starts: np.ndarray, end: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and context of each place: the words of each text and one ``end``, ``start`` before the first."""
    ends = starts[1:] + np.arange(len(starts) - 1)
    w = np.empty(len(numbers) + len(ends), np.int64)
    is_end = np.zeros(len(w), bool)
    is_end[ends] = True
    w[~is_end], w[is_end] = numbers, end
    h = np.empty_like(w)
    h[1:] = w[:-1]
    h[np.concatenate([[0], ends[:-1] + 1])] = start
    return w, h


def _as_contexts(hot: list[int]) -> np.ndarray:
    """Frequent words as contexts: the start stands for the end."""
    return np.array(sorted(START if x == END else x for x in hot), np.uint64)


def _found(sorted_in: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x in an ascending array, -1 where it isn't there."""
    if not len(sorted_in):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(sorted_in, x), len(sorted_in) - 1)
    return np.where(sorted_in[at] == x, at, -1)


def _dealt(docs: DataFrame, buckets: int, hot: list[int], often: list[tuple[int, int]]) -> DataFrame:
    """Packed occurrences by bucket of w, and each batch's documents."""
    schema = T.StructType([T.StructField("p", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("slot", T.LongType()), T.StructField("blob", T.BinaryType()),
                           T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType))])
    hot_hashes = np.array(hot, np.uint64)
    often_h, often_w = (np.array([x[i] for x in often], np.uint64) for i in (0, 1))

    def run(batches):
        part = TaskContext.get().partitionId()
        digest = xxhash.xxh64_intdigest
        for number, table in enumerate(pieces(batches, BATCH_BYTES)):
            slot = part << 32 | number
            train = ~np.asarray(table["held"].to_numpy(), bool)
            numbers, starts, vocab = numbered(t.lower().split() for t in texts_of(table))
            docs_n, size = len(train), len(numbers) + len(train)
            own = np.fromiter((digest(w) for w in vocab), np.uint64, len(vocab))
            own = np.concatenate([own, np.array([END, START], np.uint64)])
            by = np.argsort(own)
            rank = np.empty(len(own), np.int64)
            rank[by] = np.arange(len(own))
            hashes = own[by]
            del vocab
            doc = np.repeat(np.arange(docs_n, dtype=np.int32), np.diff(starts) + 1)
            w = np.empty(size, np.int32)
            ends = starts[1:] + np.arange(docs_n)
            is_end = np.zeros(size, bool)
            is_end[ends] = True
            w[~is_end] = rank[numbers]
            w[is_end] = rank[-2]
            del numbers, is_end
            h = np.empty(size, np.int32)
            h[1:] = w[:-1]
            h[np.concatenate([[0], ends[:-1] + 1])] = rank[-1]
            # frequent words' counts stay with the documents
            index = np.searchsorted(hot_hashes, hashes)
            index = np.where((index < len(hot_hashes)) & (hot_hashes[np.minimum(index, max(len(hot_hashes) - 1, 0))] == hashes) if len(hot_hashes) else False, index, -1)
            own_hot = index[w] >= 0
            pair = doc[own_hot].astype(np.int64) * max(len(hot), 1) + index[w[own_hot]]
            pairs, times = np.unique(pair, return_counts=True)
            # so do frequent bigrams, and nothing else is sent of them
            m = len(hashes)
            oh, ow = _found(hashes, often_h), _found(hashes, often_w)
            here = np.flatnonzero((oh >= 0) & (ow >= 0))
            own_often = ow[here] * m + oh[here]
            here, own_often = here[np.argsort(own_often)], np.sort(own_often)
            at_hot = np.flatnonzero(own_hot)
            which = _found(own_often, w[at_hot].astype(np.int64) * m + h[at_hot])
            at_hot, which = at_hot[which >= 0], which[which >= 0]
            many, many_times = np.unique(doc[at_hot].astype(np.int64) * max(len(often), 1) + here[which], return_counts=True)
            sent = np.ones(size, bool)
            sent[at_hot] = False
            del at_hot, which
            info = pack(train.astype(np.int64), np.diff(starts) + 1, pairs, times, many, many_times)
            ids = pa.ListArray.from_arrays(pa.array([0, docs_n], pa.int32()), pa.concat_arrays(table["doc_id"].chunks))
            yield pa.RecordBatch.from_arrays([pa.array([slot % buckets], pa.int32()), pa.array(["docs"]), pa.array([slot]), pa.array([info], pa.binary()), ids], names=schema.names)
            p = (mixed(hashes) % np.uint64(buckets)).astype(np.int64)[w]
            if own_hot.any():
                p[own_hot] = (mixed(hashes[w[own_hot]] ^ mixed(hashes[h[own_hot]])) % np.uint64(buckets)).astype(np.int64)
            w, h, p, doc = w[sent], h[sent], p[sent], doc[sent]
            key = w.astype(np.int64) * m + h
            del w, h, own_hot, sent
            order = np.lexsort((key, p))
            key, p, doc = key[order], p[order], doc[order]
            del order
            bits = np.packbits(train).astype(np.int64)
            for first, n in zip(*(x.tolist() for x in runs(p)), strict=True):
                own_key = key[first:first + n]
                head, sizes = runs(own_key // m)
                contexts, hi = np.unique(own_key % m, return_inverse=True)
                blob = pack(steps(hashes[own_key[head] // m]), sizes, steps(hashes[contexts]), run_steps(hi, sizes), doc[first:first + n], bits, np.array([docs_n]))
                yield pa.RecordBatch.from_arrays([pa.array([int(p[first])], pa.int32()), pa.array(["occ"]), pa.array([slot]), pa.array([blob], pa.binary()), pa.nulls(1, ids.type)], names=schema.names)

    return docs.select("doc_id", "text", "held").mapInArrow(run, schema)


def _table(schema: T.StructType, ids_type, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.table({"kind": pa.array(cols[0], pa.string()), "slot": pa.array(cols[1], pa.int64()), "blob": pa.array(cols[2], pa.binary()), "ids": pa.array(cols[3], ids_type)})


def _counted(dealt: DataFrame, buckets: int, hot: list[int], often: list[tuple[int, int]]) -> DataFrame:
    """For each bucket of w: its bigrams, what each document gets from it, unseen bigrams by bucket of h, counts of counts."""
    id_type = dealt.schema["ids"].dataType
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("slot", T.LongType()), T.StructField("blob", T.BinaryType()), T.StructField("ids", id_type)])
    hot_hashes = np.array(hot, np.uint64)

    def work(key, table):
        ids_type = table.schema.field("ids").type
        out: list[tuple] = []
        occ, offset = [], 0
        kinds, slots, blobs = table["kind"].to_pylist(), table["slot"].to_pylist(), table["blob"]
        hot_total, often_total, train_docs = np.zeros(len(hot), np.int64), np.zeros(len(often), np.int64), 0
        batches = []  # (slot, first document, documents)
        for i, kind in enumerate(kinds):
            if kind == "docs":
                blob = blobs[i].as_py()
                train, _, pairs, times, many, many_times = unpack(blob)
                train_docs += int(train.sum())
                if len(pairs):
                    own = train[pairs // len(hot)] > 0
                    np.add.at(hot_total, (pairs % len(hot))[own], times[own])
                if len(many):
                    own = train[many // len(often)] > 0
                    np.add.at(often_total, (many % len(often))[own], many_times[own])
                out.append(("docs", slots[i], blob, table["ids"][i].as_py()))
                continue
            words, sizes, contexts, hi, doc, bits, (docs_n,) = unpack(blobs[i].as_py())
            train = np.unpackbits(bits.astype(np.uint8))[:docs_n].astype(bool)
            occ.append((summed(words), sizes, summed(contexts), run_summed(hi, sizes), (doc + offset).astype(np.int32), train[doc]))
            batches.append((slots[i], offset, int(docs_n)))
            offset += int(docs_n)
        out.append(("stats", 0, pack(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), hot_total, np.array([train_docs]), often_total), None))
        if occ:
            out += _bucket(occ, batches, offset, buckets, hot_hashes, key[0].as_py())
        tidy()
        return _table(schema, ids_type, out)

    return dealt.groupBy("p").applyInArrow(work, schema)


def _bucket(occ: list, batches: list, docs_n: int, buckets: int, hot: np.ndarray, number: int) -> list[tuple]:
    # all words and contexts of the bucket, numbered in order of their hashes
    words, wi = np.unique(np.concatenate([o[0] for o in occ]), return_inverse=True)
    contexts, ci = np.unique(np.concatenate([o[2] for o in occ]), return_inverse=True)
    w_at = np.cumsum([0, *(len(o[0]) for o in occ)])
    c_at = np.cumsum([0, *(len(o[2]) for o in occ)])
    key = np.concatenate([np.repeat(wi[a:a + len(o[0])], o[1]) for o, a in zip(occ, w_at, strict=False)])
    key *= len(contexts)
    key += np.concatenate([ci[a:a + len(o[2])][o[3]] for o, a in zip(occ, c_at, strict=False)])
    doc = np.concatenate([o[4] for o in occ])
    train = np.concatenate([o[5] for o in occ])
    occ.clear()
    del wi, ci
    order = np.argsort(key)
    key, doc, train = key[order], doc[order], train[order]
    del order
    head, sizes = runs(key)
    pair_w, pair_h = key[head] // len(contexts), key[head] % len(contexts)
    del key
    r = np.add.reduceat(train.astype(np.int32), head).astype(np.int64)
    del train, head
    c_word = np.bincount(pair_w, r, len(words)).astype(np.int64)
    at_hot = np.searchsorted(hot, words)
    is_hot = hot[np.minimum(at_hot, max(len(hot) - 1, 0))] == words if len(hot) else np.zeros(len(words), bool)
    # what follows depends on the pair alone: it is spread over the pair's places one thing at a time
    c = np.where(is_hot, 0, c_word)[pair_w]  # frequent words: their total isn't known here
    plain = ~is_hot[pair_w]
    word = plain & (words != np.uint64(END))[pair_w]
    seen, late = r > 0, r == 0
    per = lambda mask: np.bincount(doc[np.repeat(mask, sizes)], minlength=docs_n)
    add = lambda x: np.bincount(doc, np.repeat(x, sizes), docs_n)
    log = lambda x: np.log10(np.maximum(x, 1))
    unseen = late & plain & (c > 0)
    counts = {f"k{i}": per(seen & (r == i)) for i in range(1, 6)}
    counts["known"] = per(plain & (c > 0))
    for i in range(1, 6):
        counts[f"u{i}"] = per(unseen & (c == i))
    counts["useen"] = per(unseen)
    counts["uoov"] = per(late & plain & (c == 0))
    sums = {
        "a": add(log(r) - np.where(word, log(c), 0.0) + np.where(unseen, log(c), 0.0)),
        "s": add(np.where(r > TURING, log(r + 1) - log(r), 0.0)),
        "s1": add(np.where(unseen & (c > TURING), log(c + 1) - log(c), 0.0)),
        "b": add(np.where(plain, log(c + 1), 0.0)),
    }
    out = []
    hot_contexts = _as_contexts(hot.tolist())
    at_context = _found(hot_contexts, contexts)[pair_h]
    late_of_hot = np.repeat(late & (at_context >= 0), sizes)
    far_doc, far_index = doc[late_of_hot], np.repeat(at_context, sizes)[late_of_hot]
    late &= at_context < 0  # those of other contexts are sent on
    del late_of_hot
    hot_late = np.repeat((r == 0) & ~plain, sizes)
    hot_doc = doc[hot_late]
    hot_index = np.repeat(at_hot[pair_w], sizes)[hot_late]
    del hot_late
    for slot, first, n in batches:
        at = slice(first, first + n)
        own = (hot_doc >= first) & (hot_doc < first + n)
        pairs, times = np.unique((hot_doc[own].astype(np.int64) - first) * max(len(hot), 1) + hot_index[own], return_counts=True)
        own = (far_doc >= first) & (far_doc < first + n)
        far, far_times = np.unique((far_doc[own].astype(np.int64) - first) * max(len(hot), 1) + far_index[own], return_counts=True)
        out.append(("part", slot, pack(*(counts[k][at] for k in COUNTS), *(signed(sums[k][at]) for k in SUMS), pairs, times, far, far_times), None))
    # unseen bigrams, to the buckets of their contexts
    if late.any():
        lh = np.repeat(pair_h[late], sizes[late])
        ld = doc[np.repeat(late, sizes)].astype(np.int64)
        of = np.searchsorted(np.array([b[1] for b in batches]), ld, "right") - 1
        q = (mixed(contexts) % np.uint64(buckets)).astype(np.int64)[lh]
        by = np.lexsort((lh, of, q))
        lh, ld, of, q = lh[by], ld[by], of[by], q[by]
        for first, n in zip(*(x.tolist() for x in runs(q * len(batches) + of)), strict=True):
            at = slice(first, first + n)
            slot, start, _ = batches[int(of[first])]
            top, sizes2 = runs(lh[at])
            out.append(("unseen", slot, pack(np.array([int(q[first])]), steps(contexts[lh[at][top]]), sizes2, ld[at] - start), None))
    # the model's bigrams, and counts of counts
    pw, ph, pr = pair_w[seen], pair_h[seen], r[seen]
    if len(pr):
        top, sizes3 = runs(pw)
        used, hi = np.unique(ph, return_inverse=True)
        flag = np.where(is_hot[pw[top]], 2 * at_hot[pw[top]] + 1, 2 * c_word[pw[top]])
        out.append(("bigrams", number, pack(steps(words[pw[top]]), sizes3, flag, steps(contexts[used]), run_steps(hi, sizes3), pr), None))
        bi_r, bi_n = np.unique(pr, return_counts=True)
        uni_r, uni_n = np.unique(c_word[(c_word > 0) & ~is_hot], return_counts=True)
        out.append(("stats", 0, pack(uni_r, uni_n, bi_r, bi_n, np.zeros(len(hot), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)), None))
    return out


def _totals(stats: DataFrame, hot: int, often: int) -> Totals:
    schema = T.StructType([T.StructField("what", T.StringType()), T.StructField("r", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                ur, un, br, bn, hot_n, docs, often_n = unpack(blob)
                what = ["uni"] * len(ur) + ["bi"] * len(br) + ["hot"] * len(hot_n) + ["docs"] + ["often"] * len(often_n)
                yield pa.RecordBatch.from_arrays([pa.array(what), pa.array(np.concatenate([ur, br, np.arange(len(hot_n)), [0], np.arange(len(often_n))]), pa.int64()), pa.array(np.concatenate([un, bn, hot_n, docs, often_n]), pa.int64())], names=schema.names)

    # N tokens have at most sqrt(2 N) different counts
    return Totals(stats.select("blob").mapInArrow(run, schema).groupBy("what", "r").agg(F.sum("n").alias("n")).collect(), hot, often)


def _to_contexts(bigrams: DataFrame, buckets: int, totals: Totals) -> DataFrame:
    """Each bucket's bigrams by bucket of the context: count, discounted count and P(w); more than FEW of a context as sums."""
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("slot", T.LongType()), T.StructField("blob", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                _, sizes, flag, used, hi, r = unpack(blob)
                contexts, hi = summed(used), run_summed(hi, sizes)
                c = np.repeat(flag, sizes)
                q = (mixed(contexts) % np.uint64(buckets)).astype(np.int64)
                by = np.lexsort((hi, q[hi]))
                hi, r, c = hi[by], r[by], c[by]
                for first, n in zip(*(x.tolist() for x in runs(q[hi])), strict=True):
                    at = slice(first, first + n)
                    top, times = runs(hi[at])
                    own, rr, cc = contexts[hi[at][top]], r[at], c[at]
                    few = np.repeat(times <= FEW, times)
                    many = np.flatnonzero(times > FEW)
                    count = np.where(cc & 1, totals.hot[np.minimum(cc >> 1, max(len(totals.hot) - 1, 0))] if len(totals.hot) else 0, cc >> 1)
                    total = np.add.reduceat(rr, top)[many]
                    left = np.add.reduceat(rr * totals.two(rr), top)[many]
                    mass = np.add.reduceat(totals.word(count), top)[many]
                    blob = pack(steps(own[times <= FEW]), times[times <= FEW], rr[few], cc[few], steps(own[many]), total, left, mass)
                    yield pa.RecordBatch.from_arrays([pa.array([int(q[hi[first]])], pa.int32()), pa.array(["ctx"]), pa.array([0], pa.int64()), pa.array([blob], pa.binary())], names=schema.names)

    return bigrams.select("blob").mapInArrow(run, schema)


def _weighed(met: DataFrame, totals: Totals, hot: list[int]) -> DataFrame:
    """For each bucket of h: the back-off weights, those of frequent contexts again apart, and what they add to documents with unseen bigrams."""
    hot_contexts = _as_contexts(hot)
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("slot", T.LongType()), T.StructField("blob", T.BinaryType())])

    def work(key, table):
        own, total, left, mass = [], [], [], []
        late = []
        for kind, slot, blob in zip(table["kind"].to_pylist(), table["slot"].to_pylist(), table["blob"], strict=True):
            if kind == "unseen":
                late.append((slot, unpack(blob.as_py())))
                continue
            few, times, r, c, many, t, d, m = unpack(blob.as_py())
            if len(times):
                count = np.where(c & 1, totals.hot[np.minimum(c >> 1, max(len(totals.hot) - 1, 0))] if len(totals.hot) else 0, c >> 1)
                top = np.cumsum(times) - times
                own.append(summed(few))
                total.append(np.add.reduceat(r, top))
                left.append(np.add.reduceat(r * totals.two(r), top))
                mass.append(np.add.reduceat(totals.word(count), top))
            own.append(summed(many))
            total.append(t)
            left.append(d)
            mass.append(m)
        rows = []
        contexts, g = np.empty(0, np.uint64), np.empty(0)
        if own:
            contexts, at = np.unique(np.concatenate(own), return_inverse=True)
            c = np.bincount(at, np.concatenate(total), len(contexts))
            kept = np.bincount(at, np.concatenate(left), len(contexts))
            taken = np.bincount(at, np.concatenate(mass), len(contexts))
            alpha = (1 - kept / c) / (1 - taken)
            g = np.log10(alpha) + np.log10(c)
            rows.append(("contexts", key[0].as_py(), pack(steps(contexts), c.astype(np.int64), alpha)))
            at = _found(hot_contexts, contexts)
            if (at >= 0).any():
                rows.append(("hot", 0, pack(at[at >= 0], g[at >= 0])))
        for slot, (_, h, times, doc) in late:
            h = summed(h)
            at = np.minimum(np.searchsorted(contexts, h), max(len(contexts) - 1, 0))
            known = contexts[at] == h if len(contexts) else np.zeros(len(h), bool)
            add = np.repeat(np.where(known, g[at], 0.0) if len(contexts) else np.zeros(len(h)), times)
            docs, place = np.unique(doc, return_inverse=True)
            rows.append(("late", slot, pack(docs, signed(np.bincount(place, add, len(docs))))))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        return pa.table({"kind": pa.array(cols[0], pa.string()), "slot": pa.array(cols[1], pa.int64()), "blob": pa.array(cols[2], pa.binary())})

    return met.groupBy("q").applyInArrow(work, schema)


def _scored(parts: DataFrame, totals: Totals, hot: int, often: np.ndarray, far: np.ndarray, id_type) -> DataFrame:
    """The parts of each batch added up: one row for each document. ``often`` is what a frequent bigram adds, ``far`` what a frequent context adds to an unseen one."""
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def work(table):
        kinds, blobs = table["kind"].to_pylist(), table["blob"]
        at = kinds.index("docs")
        train, tokens, pairs, times, many, many_times = unpack(blobs[at].as_py())
        ids = table["ids"].combine_chunks()
        ids = (ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks))[at].values
        n = len(train)
        counts = {k: np.zeros(n, np.int64) for k in COUNTS}
        sums = {k: np.zeros(n) for k in SUMS}
        score, known, base = np.zeros(n), np.zeros(n, np.int64), np.zeros(n)
        log = np.log10
        word = log(totals.word(totals.hot)) if hot else np.zeros(0)
        for i, kind in enumerate(kinds):
            if kind == "part":
                got = unpack(blobs[i].as_py())
                for k, x in zip(COUNTS, got, strict=False):
                    counts[k] += x.astype(np.int64)
                for k, x in zip(SUMS, got[len(COUNTS):], strict=False):
                    sums[k] += unsigned(x)
                p, t, p2, t2 = got[-4:]
                if len(p2):
                    np.add.at(score, p2 // hot, t2 * far[p2 % hot])
                if len(p):
                    np.add.at(score, p // hot, t * word[p % hot])
            elif kind == "late":
                docs, add = unpack(blobs[i].as_py())
                score[docs] += unsigned(add)
        if len(many):
            np.add.at(score, many // len(often), many_times * often[many % len(often)])
        if len(pairs):
            d, k, c = pairs // hot, pairs % hot, totals.hot[pairs % hot]
            np.add.at(base, d, times * log(c + 1))
            np.add.at(known, d, np.where(c > 0, times, 0))
            np.subtract.at(score, d, np.where((c > 0) & ~totals.hot_end[k], times * log(np.maximum(c, 1)), 0.0))
        low2, low1 = log(totals.two.low), log(totals.one.low)
        score += sums["a"] + (totals.two.slope + 1) * sums["s"] + (totals.one.slope + 1) * sums["s1"]
        for i in range(TURING):
            score += counts[f"k{i + 1}"] * low2[i] + counts[f"u{i + 1}"] * low1[i]
        if totals.tokens:
            score -= counts["useen"] * log(totals.tokens)
        score += counts["uoov"] * log(totals.unknown)
        if totals.docs:
            score -= log(totals.docs)  # the first token's context
        base += sums["b"] - tokens * log(totals.tokens + totals.types + 1)
        known += counts["known"]
        return pa.table({"doc_id": ids, "held_out": pa.array(train == 0), "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(known), "train_tokens": pa.array(np.full(n, totals.tokens, np.int64)), "base_score": pa.array(base), "score": pa.array(score)})

    return parts.groupBy("slot").applyInArrow(work, schema)


def _often_rows(spark: SparkSession, often: list[tuple[int, int]], hot: list[int], totals: Totals, number: int, schema: T.StructType) -> DataFrame:
    """The model's frequent bigrams, as a bucket of their own."""
    own = sorted((w, h, r) for (h, w), r in zip(often, totals.often.tolist(), strict=True) if r)
    w, h = (np.array([x[i] for x in own], np.uint64) for i in (0, 1))
    top, sizes = runs(w)
    used, hi = np.unique(h, return_inverse=True)
    flag = 2 * _found(np.array(hot, np.uint64), w[top]) + 1
    blob = pack(steps(w[top]), sizes, flag, steps(used), run_steps(hi, sizes), np.array([x[2] for x in own], np.int64))
    values = {"kind": "bigrams", "slot": number, "blob": bytearray(blob), "ids": None}
    return spark.createDataFrame([tuple(values[n] for n in schema.names)], schema)


def _gains(often: list[tuple[int, int]], hot: list[int], totals: Totals, far: np.ndarray) -> np.ndarray:
    """What a place of each frequent bigram adds to the score, the context's count apart; unseen ones back off."""
    if not often:
        return np.zeros(0)
    h, w = (np.array([x[i] for x in often], np.uint64) for i in (0, 1))
    word = totals.word(totals.hot)[_found(np.array(hot, np.uint64), w)]
    r = np.maximum(totals.often, 1)
    return np.where(totals.often > 0, np.log10(totals.two(r) * r), np.log10(word) + far[_found(_as_contexts(hot), h)])


def train_and_score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> tuple[DataFrame, str]:
    """Scores of all documents by a model of those for which ``held_out`` isn't true, and the folder of the model's tables.

    doc_id, held_out, n_tokens (words and one end), n_known (tokens seen in training),
    train_tokens, base_score (add-one unigrams), score (the model's log10 probability of the
    text). A-Z are lower-cased. A null or empty text is its end alone. Repeated rows are counted and scored
    each; null ids stay null; other columns aren't read. Without training documents every token has probability one.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    size, n = rows.agg(F.sum(F.octet_length("text") + 1), F.count(F.lit(1))).first()
    buckets = max(1, -(-(size or 0) // BUCKET_BYTES))
    hot, often = _frequent(rows, buckets, min(1.0, SAMPLE_DOCS / max(n, 1))) if buckets > 1 else ([], [])
    path = path or scratch(spark, "katz")
    counted = _counted(_dealt(rows, buckets, hot, often), buckets, hot, often)
    counted.write.partitionBy("kind").parquet(f"{path}/counted")
    tables = spark.read.schema(counted.schema).parquet(f"{path}/counted")
    kind = lambda k: tables.where(F.col("kind") == k)
    totals = _totals(kind("stats"), len(hot), len(often))
    if (totals.often > 0).any():
        _often_rows(spark, often, hot, totals, buckets, counted.schema).write.mode("append").partitionBy("kind").parquet(f"{path}/counted")
        tables = spark.read.schema(counted.schema).parquet(f"{path}/counted")
    totals.hot_end = np.array(hot, np.uint64) == np.uint64(END)
    schema = "q int, slot bigint, blob binary"

    def bucket_of(batches):
        for batch in batches:
            blobs = batch.column("blob").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([int(unpack(b)[0][0]) for b in blobs], pa.int32()), batch.column("slot"), batch.column("blob")], names=["q", "slot", "blob"])

    unseen = kind("unseen").select("slot", "blob").mapInArrow(bucket_of, schema).select("q", F.lit("unseen").alias("kind"), "slot", "blob")
    weighed = _weighed(_to_contexts(kind("bigrams"), buckets, totals).unionByName(unseen), totals, hot)
    weighed.write.partitionBy("kind").parquet(f"{path}/weighed")
    met = spark.read.schema(weighed.schema).parquet(f"{path}/weighed")
    late = met.where("kind = 'late'")
    far = np.zeros(len(hot))
    for r in met.where("kind = 'hot'").select("blob").collect():  # 4 x buckets numbers at most
        at, g = unpack(bytes(r["blob"]))
        far[at] = g
    gains = _gains(often, hot, totals, far)
    parts = tables.where("kind in ('docs', 'part')").unionByName(late.withColumn("ids", F.lit(None).cast(counted.schema["ids"].dataType)))
    return _scored(parts, totals, len(hot), gains, far, rows.schema["doc_id"].dataType), path


def bigram_rows(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, context, word, n) of a stored model; words are their XXH64."""
    schema = "bucket bigint, context bigint, word bigint, n bigint"

    def run(batches):
        for batch in batches:
            for slot, blob in zip(batch.column("slot").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                words, sizes, _, used, hi, r = unpack(blob)
                h = summed(used)[run_summed(hi, sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), slot)), pa.array(h.view(np.int64)), pa.array(np.repeat(summed(words), sizes).view(np.int64)), pa.array(r, pa.int64())], names=["bucket", "context", "word", "n"])

    return spark.read.parquet(f"{path}/counted").where("kind = 'bigrams'").select(F.col("slot").cast("bigint").alias("slot"), "blob").mapInArrow(run, schema)


def context_rows(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, context, n, alpha) of a stored model."""
    schema = "bucket bigint, context bigint, n bigint, alpha double"

    def run(batches):
        for batch in batches:
            for slot, blob in zip(batch.column("slot").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                h, c, alpha = unpack(blob)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), slot)), pa.array(summed(h).view(np.int64)), pa.array(c, pa.int64()), pa.array(alpha)], names=["bucket", "context", "n", "alpha"])

    return spark.read.parquet(f"{path}/weighed").where("kind = 'contexts'").select(F.col("slot").cast("bigint").alias("slot"), "blob").mapInArrow(run, schema)
