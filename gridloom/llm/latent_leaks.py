"""Benchmark leaks by latent semantic retrieval.

Texts are cut into passages of two blocks of words, one block apart. A passage is a
TF-IDF vector over hashed words; a randomised SVD of such vectors gives a space of a
few dimensions in which every passage of every document is compared with every
benchmark item by cosine. A candidate must then share a long common subsequence of words
with the item, or a shorter one together with the item's answer, so paraphrases are found
and passages of like subject are not.

Word statistics and the space, which is the index, cover all documents and all items, and every passage is then
placed in it. The documents' words are read once, as numbers, and stored; statistics, range finder and singular
values are a pass each over these. Nothing grows with the documents on the
driver: it holds word statistics and space (``features`` x ``rank`` numbers) and one block of
``item_block`` items.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.words import kept, packed, pieces, stored, texts_of, tidy, unpacked

FEATURES = 1 << 15
RANK = 96
BLOCK = 24             # words; a passage has two blocks
ITEM_BLOCK = 5_000
PART = 1 << 16         # numbers of a slice in which partial sums are sent
DENSE = 64             # blocks of words that meet their own features as one small matrix
COSINE = 0.30          # least similarity of a candidate
LCS = 0.70             # of the item's words, in order: a leak by itself
LCS_ANSWER = 0.50      # a leak if the answer is there too
ANSWER = 0.80          # of the answer's words, in order
LEAST = 8              # words of an item; the few words of shorter ones are found anywhere

# A-Z lower-cased, other ASCII but digits a space, the rest as it is
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def folded(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def answer_of(text: bytes) -> list[bytes]:
    """Words of the item's answer: what follows its last question mark or colon, else its last sentence; the last quarter at most."""
    words = folded(text)
    body = text.rstrip(b" \t\n\r.!?:")
    cut = max(body.rfind(b"?"), body.rfind(b":"))
    tail = folded(body[cut + 1:]) if cut >= 0 else folded(body[max(body.rfind(b". "), body.rfind(b".\n")) + 1:])
    most = max(3, len(words) // 4)
    return (tail or words)[-most:]


def lcs(masks: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each word of the item."""
    full = (1 << size) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def places(words: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def featured(texts: list[bytes], features: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature of each word of all texts on end, and where each text's words start (one more than texts).

    A word's number is a polynomial hash of its bytes, read off prefix sums over
    all texts at once; it is the same wherever the word stands.
    """
    raw = np.frombuffer(b" ".join(t.translate(FOLD) for t in texts) + b" ", np.uint8)
    word = raw != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
    first, end = edge[::2], edge[1::2]
    power, back = _powers(len(raw))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(raw * power[: len(raw)], out=sums[1:])
    value = (sums[end] - sums[first]) * back[first]
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) if texts else np.empty(0, np.int64)
    starts = np.concatenate([[0], np.searchsorted(first, ends)]).astype(np.int64)
    return ((value >> np.uint64(32)) % np.uint64(features)).astype(np.int64), starts


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64; a few MB of them are kept."""
    base, usual = 0x9E3779B97F4A7C15, 1 << 20

    def make(n):
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
        return tuple(out)

    return kept("latent powers", lambda: make(usual)) if size <= usual else make(size)


def blocks_of(starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start) of each block of words, and each text's number of blocks."""
    n = -(-np.diff(starts) // block)
    text = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return text, starts[text] + k * block, n


def padded(table: np.ndarray) -> np.ndarray:
    """``table`` and one more word, which points nowhere: it fills up the last block of a text."""
    return np.concatenate([table, np.zeros((1, table.shape[1]), table.dtype)])


def placed(feats: np.ndarray, starts: np.ndarray, table: np.ndarray, block: int):
    """(text, first word, vector) of each passage: two blocks of a text, or the only one. ``table`` is padded."""
    text, at, n = blocks_of(starts, block)
    width = table.shape[1]
    if not len(text):
        return text, at, np.empty((0, width), np.float32)
    # blocks of equal size, the last of a text filled up
    full = np.full(len(at) * block, len(table) - 1, np.int64)
    size = np.diff(starts)
    shift = (np.cumsum(n) - n) * block - starts[:-1]
    full[np.arange(len(feats)) + np.repeat(shift, size)] = feats
    sums = np.empty((len(at), width), np.float32)
    step = 128  # blocks whose words' vectors stay in the processor's cache
    room = np.empty((step * block, width), np.float32)
    for i in range(0, len(at), step):
        words = full[i * block:(i + step) * block]
        own = np.take(table, words, axis=0, out=room[:len(words)], mode="clip").reshape(-1, block, width)
        np.einsum("bkw->bw", own, out=sums[i:i + step])
    last = lasts(text)
    sums[:-1][~last[:-1]] += sums[1:][~last[:-1]]
    keep = ~last | (n[text] == 1)
    return text[keep], at[keep], sums[keep]


def lasts(text: np.ndarray) -> np.ndarray:
    """Whether a block is the last of its text."""
    last = np.ones(len(text), bool)
    last[:-1] = text[1:] != text[:-1]
    return last


def _words(rows: DataFrame, features: int) -> DataFrame:
    """(feats, starts): what :func:`featured` has for the texts, as bytes, some texts a row."""
    kind = _kind(features)

    def run(batches):
        for table in pieces(batches, 1 << 19):
            feats, starts = featured(texts_of(table), features)
            yield pa.RecordBatch.from_arrays([pa.array([feats.astype(kind).tobytes()], pa.binary()), pa.array([starts.astype(np.int64).tobytes()], pa.binary())], names=["feats", "starts"])

    return rows.select("text").mapInArrow(run, "feats binary, starts binary")


def _kind(features: int) -> type:
    return np.uint16 if features <= 1 << 16 else np.uint32


def _read(batches, features: int):
    """(feats, starts) of each row of :func:`_words`."""
    kind = _kind(features)
    for batch in batches:
        for f, s in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("feats", "starts")), strict=True):
            yield np.frombuffer(f.as_buffer(), kind).astype(np.int64), np.frombuffer(s.as_buffer(), np.int64)
    tidy()


def _statistics(rows: DataFrame, features: int, block: int) -> tuple[np.ndarray, int]:
    """Passages that hold each feature and their number, over all documents."""
    return _counts(_words(rows, features), features, block)


def _counts(words: DataFrame, features: int, block: int) -> tuple[np.ndarray, int]:
    schema = T.StructType([T.StructField("feature", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches):
        count, total = np.zeros(features, np.int64), 0
        for feats, starts in _read(batches, features):
            text, at, _ = blocks_of(starts, block)
            if len(at):
                of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(feats))))
                both = np.sort(of * features + feats)
                both = both[np.concatenate([[True], both[1:] != both[:-1]])]
                count += np.bincount(both % features, minlength=features)
                total += len(at)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(own, -1).astype(np.int32)), pa.array(np.append(count[own], total))], names=schema.names)

    got = words.mapInArrow(run, schema).groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # features + 1 rows at most
    count = np.zeros(features, np.float64)
    inner = got[got["feature"] >= 0]
    count[inner["feature"].to_numpy()] = inner["n"].to_numpy()
    return count, int(got.loc[got["feature"] < 0, "n"].sum())


def _summed(words: DataFrame, features: int, size: int, add) -> np.ndarray:
    """Sum of ``size`` numbers to which ``add(feats, starts, total)`` adds for each row of words.

    One partial sum a task, and slices of them are added up as they come in, so neither
    grows with the number of tasks.
    """
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("value", T.BinaryType())])

    def rows(sums: dict):
        for part, value in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([value.astype(np.float32).tobytes()], pa.binary())], names=schema.names)

    def run(batches):
        total = None
        for feats, starts in _read(batches, features):
            total = np.zeros(size) if total is None else total
            add(feats, starts, total)
        if total is not None:
            yield from rows({i // PART: own for i in range(0, size, PART) if (own := total[i:i + PART]).any()})

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(value.as_buffer(), np.float32)
                sums[part] = sums[part] + own if part in sums else own.astype(np.float64)
        yield from rows(sums)

    out = np.zeros(size, np.float32)
    for r in words.mapInArrow(run, schema).repartition(-(-size // PART), "part").mapInArrow(merge, schema).toLocalIterator():
        out[r["part"] * PART:(r["part"] + 1) * PART] = np.frombuffer(r["value"], np.float32)
    return out


def spread(feats: np.ndarray, starts: np.ndarray, table: np.ndarray, block: int, out: np.ndarray) -> None:
    """Adds A' (A table) over the passages of the texts to ``out``, but for the words' own weights. ``table`` is padded.

    A word stands in its block's passages, that of the block and that of the one before: their vectors are
    added up once a block, and a few blocks at a time meet their words as a product of small matrices.
    """
    text, at, n = blocks_of(starts, block)
    if not len(text):
        return
    v = placed(feats, starts, table, block)[2]
    v /= np.maximum(np.einsum("pw,pw->p", v, v), 1e-18)[:, None]
    last = lasts(text)
    keep = ~last | (n[text] == 1)
    both = np.zeros((len(text), v.shape[1]), np.float32)
    both[keep] = v
    follows = np.flatnonzero(~last[:-1])
    both[follows + 1] += v[np.cumsum(keep)[follows] - 1]
    bounds = np.append(at, len(feats))
    for i in range(0, len(at), DENSE):
        stop = min(i + DENSE, len(at))
        own, place = np.unique(feats[bounds[i]:bounds[stop]], return_inverse=True)
        of = np.repeat(np.arange(stop - i), np.diff(bounds[i:stop + 1]))
        times = np.bincount(place * (stop - i) + of, minlength=len(own) * (stop - i)).reshape(len(own), -1).astype(np.float32)
        out[own] += times @ both[i:stop]


def space(words: DataFrame, items, idf: np.ndarray, rank: int, block: int, seed: int = 7) -> np.ndarray:
    """features x rank: where each word points, by randomised SVD of all passages of ``words`` and of the items.

    ``items()`` yields lists of texts. Range finder and one power iteration: the passages meet a random matrix, made
    alike in each task, and come back as features x rank; a second pass gives the
    singular values. Directions are scaled to equal spread, so common words, which all passages of a language
    share, weigh no more than others.
    """
    features = len(idf)
    idf32 = idf.astype(np.float32)

    def start():
        return padded(np.random.default_rng(seed).standard_normal((features, rank), np.float32) * idf32[:, None])

    def gram(feats, starts, table):
        v = placed(feats, starts, table, block)[-1].astype(np.float64)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        return v.T @ v

    def ranged():
        table = []  # made with the task's first row

        def add(feats, starts, total):
            if not table:
                table.append(start())
            spread(feats, starts, table[0], block, total.reshape(features, rank))

        return add

    z = _summed(words, features, features * rank, ranged()).astype(np.float64).reshape(features, rank)
    table = start()
    for texts in items():
        spread(*featured(texts, features), table, block, z)
    q, _ = np.linalg.qr((z * idf[:, None]).astype(np.float32))
    del z
    table = padded(q * idf32[:, None])
    sent = words.sparkSession.sparkContext.broadcast(table)

    def squared(feats, starts, total):
        total += gram(feats, starts, sent.value).ravel()

    g = _summed(words, features, rank * rank, squared).astype(np.float64).reshape(rank, rank)
    sent.destroy()
    for texts in items():
        g += gram(*featured(texts, features), table)
    del table
    value, turn = np.linalg.eigh(g)
    value = np.maximum(value, value.max() * 1e-6 + 1e-12)
    out = (q @ (turn / np.sqrt(value)).astype(np.float32)) * idf32[:, None]
    del q
    tidy()
    return out


FOUND = [("item_id", T.LongType()), ("first_word", T.LongType()), ("common_words", T.LongType()), ("item_words", T.LongType()), ("answer_found", T.BooleanType()), ("cosine", T.DoubleType())]


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", features: int = FEATURES, rank: int = RANK,
          block: int = BLOCK, fit_passages: int | None = None, item_block: int = ITEM_BLOCK, cosine: float = COSINE, verify: bool = True) -> DataFrame:
    """(doc_id, item_id, first_word, common_words, item_words, answer_found, cosine): one row for each document and item that it leaks.

    The place is that of the passage with the most common words (ties: the first), the
    cosine the largest of all its candidate passages.
    Documents and items that are null, empty or, items, under 8 words leak nothing. Repeated
    rows of either table are judged each; null ids stay null; other columns aren't read. ``verify=False`` returns
    the candidates themselves, with the common words they have. The space is fitted on all passages;
    only who asks for ``fit_passages`` has it fitted on about so many, of whole documents chosen by hash.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    bench = items.select(items[item_col].cast("bigint").alias("item_id"), items[item_text].alias("text")).where("text is not null")
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), *(T.StructField(n, t) for n, t in FOUND)])
    words = stored(_words(rows, features), "leaks-words")
    count, total = _counts(words, features, block)
    idf = np.log((total + 1) / (count + 1)) + 1
    groups = -(-bench.count() // item_block)
    bench = bench.withColumn("_g", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(groups, 1))))

    def group(g):
        """Items of block ``g`` that are long enough, with their texts and words."""
        own = bench.where(F.col("_g") == g).collect()  # item_block rows, as the hash deals them
        texts = [r["text"].encode("utf-8", "surrogatepass") for r in own]
        return [(r["item_id"], t, w) for r, t in zip(own, texts, strict=True) if len(w := folded(t)) >= LEAST]

    first = [group(0)] if groups == 1 else []  # kept where it is the only one

    def items():
        for g in range(groups):
            if texts := [t for _, t, _ in (first[0] if first else group(g))]:
                yield texts

    if next(items(), None) is None:
        return spark.createDataFrame([], schema)
    if fit_passages is not None:
        share = min(1.0, fit_passages / max(total, 1))
        pick = F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))
        words = stored(_words(rows.where(pick), features), "leaks-sample")
    table = space(words, items, idf, rank, block)
    out = None
    for g in range(groups):
        good = first[0] if first else group(g)
        if not good:
            continue
        whole = np.concatenate([[0], np.cumsum([len(w) for _, _, w in good])])
        feats, _ = featured([t for _, t, _ in good], features)
        query = np.add.reduceat(table[feats], whole[:-1], axis=0)
        query /= np.maximum(np.linalg.norm(query, axis=1, keepdims=True), 1e-9)
        known = [(i, len(w), places(w), places(a := answer_of(t)), len(a)) for i, t, w in good]
        sent = spark.sparkContext.broadcast((table, query, known))
        found = rows.mapInArrow(_search(sent, schema, features, block, cosine, verify), schema)
        out = found if out is None else out.unionAll(found)
    return out


def _search(sent, schema, features: int, block: int, cosine: float, verify: bool):
    def run(batches):
        table, query, known = sent.value
        table = padded(table)
        widest = max(max(block, size - block) for _, size, *_ in known)
        times = [{w: m.bit_count() for w, m in masks.items()} for _, _, masks, _, _ in known]  # of each word in the item
        for rows in pieces(batches, 1 << 19):
            texts, lists = texts_of(rows), {}
            feats, starts = featured(texts, features)
            text, at, v = placed(feats, starts, table, block)
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
            best: dict[tuple[int, int], tuple] = {}
            last, around = None, set()
            for lo in range(0, len(v), 8192):
                near = v[lo:lo + 8192] @ query.T
                hits = np.flatnonzero(near.ravel() >= cosine)
                for p, q in zip((hits // len(query)).tolist(), (hits % len(query)).tolist(), strict=True):
                    t, first = int(text[lo + p]), int(at[lo + p] - starts[text[lo + p]])
                    _, size, masks, answer, answer_size = known[q]
                    reach = max(block, size - block)
                    if t not in lists:
                        lists[t] = folded(texts[t])
                    window = lists[t][max(0, first - reach):first + 2 * block + reach]
                    if verify:
                        # no common subsequence is longer than the item's words that stand in the window, nor than the window's in the item
                        if (t, first) != last:
                            last, around = (t, first), set(lists[t][max(0, first - widest):first + 2 * block + widest])
                        if sum(map(times[q].__getitem__, around & times[q].keys())) < LCS_ANSWER * size:
                            continue
                        window = list(filter(masks.__contains__, window))
                        if len(window) < LCS_ANSWER * size:
                            continue
                    common = lcs(masks, size, window)
                    if verify and common < LCS_ANSWER * size:
                        continue
                    has = lcs(answer, answer_size, window) >= ANSWER * answer_size
                    if verify and not (common >= LCS * size or common >= LCS_ANSWER * size and has):
                        continue
                    like = float(near[p, q])
                    old = best.get((t, q))
                    if old is None or common > old[1]:
                        best[t, q] = (first, common, has, like if old is None else max(like, old[3]))
                    elif like > old[3]:
                        best[t, q] = (*old[:3], like)
            if best:
                keys = list(best)
                own = rows.select(["doc_id"]).take(pa.array([t for t, _ in keys]))["doc_id"]
                vals = [best[k] for k in keys]
                made = pa.Table.from_arrays([own, pa.array([known[q][0] for _, q in keys], pa.int64()), *(pa.array(c, k) for c, k in (
                    ([x[0] for x in vals], pa.int64()), ([x[1] for x in vals], pa.int64()), ([known[q][1] for _, q in keys], pa.int64()), ([x[2] for x in vals], pa.bool_()), ([x[3] for x in vals], pa.float64())))], names=schema.names)
                yield from made.combine_chunks().to_batches()

    return run


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text leaks an item; rows are told apart by id and text."""
    keyed = packed(docs, key=F.xxhash64(docs[id_col], docs[text_col]), text=docs[text_col])
    bad = stored(leaks(keyed, items, "key", "text", **options).select(F.col("doc_id").alias("key")).distinct(), "leaks")
    return keyed.join(bad, "key", "left_anti").select(*unpacked(docs.columns))
