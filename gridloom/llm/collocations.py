"""Phrase collocations by multikey quicksort of suffix pointers.

Every word that begins a suffix of its piece is a pointer; only the first ``most_words`` words of a
suffix matter.

1. Suffixes are routed by their leading words: the space of (language, word, word, ...) is cut
   into ranges of about equal load at keys read off a bounded sample, so a frequent leading word spreads
   over several ranges by the words behind it. A batch adds up its equal suffixes before it sends them.
2. Each range is sorted by a three-way multikey quicksort of pointers: a partition splits at
   a pivot symbol into smaller, equal and larger ones, and the equal ones go on with the next word. The weight
   of an equal partition is the count of the phrase read so far; a partition lighter than
   the least count is abandoned, as all suffixes with the same leading words are there.
3. The only phrases whose suffixes lie in several ranges are the beginnings of the keys at which the ranges
   were cut. These are counted in every range, whatever their weight, and added up.

The ranges decide on the work's division only; any sample gives the same counts. Scores
are joined from the counts and computed in whole numbers.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.words import Vocab, pieces, stored, tidy

# fixed values: characters that end a piece, and those that part words besides the space
ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x09"
FOLD = bytes(10 if c in ENDS else 32 if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))
END = b"\n"  # of a piece, as a word

MOST_WORDS = 3
LEAST = 10            # count of a phrase
INSIDE = 50           # percent of its count with which a longer phrase takes a shorter one's place
TOP = 2000            # phrases reported of each language
RANGE_WORDS = 1 << 20  # suffixes of a range, about
SAMPLE_BYTES = 8 << 20  # of text from which ranges are read, expected
SAMPLE_KEYS = 200_000  # suffixes of that sample looked at, expected


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of all texts on end, an END after each piece."""
    return [w for w in (END.join(texts) + END).translate(FOLD).replace(END, b" \n ").split(b" ") if w]


def chunk_words(most_words: int) -> int:
    """Words numbered at once, so that a suffix fits into 63 bits."""
    return min(1 << 19, (1 << 63 // most_words - 1) - 2 * most_words)


def suffixes(words: list[bytes], most_words: int):
    """(names, ranks) of chunks of the words: the distinct words in order, and ranks (suffixes x most_words), 0 past a piece's end."""
    step = chunk_words(most_words)
    for lo in range(0, len(words), step):
        own = words[lo:lo + step + most_words - 1]
        names = sorted({*own} - {END})
        rank = {w: i for i, w in enumerate(names, 1)}
        rank[END] = 0
        r = np.zeros(len(own) + most_words, np.int64)
        r[:len(own)] = np.fromiter(map(rank.__getitem__, own), np.int64, len(own))
        at = np.flatnonzero(r[:min(step, len(own))])
        cols = [r[at]]
        for k in range(1, most_words):
            cols.append(np.where(cols[-1] == 0, 0, r[at + k]))
        yield names, np.stack(cols, axis=1)


def packed(ranks: np.ndarray, names: int) -> np.ndarray:
    """One number for each suffix, in the order of its words; words have even digits, so that others fit in between."""
    out = np.zeros(len(ranks), np.int64)
    for col in ranks.T:
        out = out * (2 * names + 2) + 2 * col
    return out


def key_digits(key: tuple[bytes, ...], names: list[bytes]) -> int:
    """The number at which a key of any words stands among those of :func:`packed`."""
    out = 0
    for w in key:
        at = bisect_left(names, w) if w != END else -1
        out = out * (2 * len(names) + 2) + (0 if w == END else 2 * (at + 1) if at < len(names) and names[at] == w else 2 * at + 1)
    return out


def multikey_quicksort(symbols: np.ndarray, pointers: np.ndarray, weights: np.ndarray, depth: int, least: int):
    """(length, pointer, weight) arrays: every string of up to ``depth`` symbols that begins suffixes of a weight of ``least`` or more.

    Symbol 0 ends a suffix. All partitions split at the same time, each at the median of three of
    its symbols; partitions below ``least`` are abandoned.
    """
    size, at = np.array([len(pointers)]), np.zeros(1, np.int64)
    out = []
    if not len(pointers) or weights.sum() < least:
        size = size[:0]
    while len(size):
        start = np.cumsum(size) - size
        own = np.repeat(np.arange(len(size)), size)
        symbol = symbols[pointers + at[own]]
        a, b, c = symbol[start], symbol[start + size // 2], symbol[start + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        split = pivot[own]
        code = 3 * own + (symbol >= split) + (symbol > split)
        count = np.bincount(code, minlength=3 * len(size))
        weight = np.bincount(code, weights, minlength=3 * len(size)).astype(np.int64)
        first = np.cumsum(count) - count
        # every class keeps its order, so its members only need the shift of their partition
        to = np.empty(len(code), np.int64)
        for k, test in enumerate((np.less, np.equal, np.greater)):
            of, mine = np.flatnonzero(test(symbol, split)), count[k::3]
            to[of] = np.arange(len(of)) + (first[k::3] - (np.cumsum(mine) - mine))[own[of]]
        moved, heavy = np.empty_like(pointers), np.empty_like(weights)
        moved[to], heavy[to] = pointers, weights
        equal = np.arange(1, len(count), 3)
        told = equal[(weight[equal] >= least) & (pivot > 0)]
        out.append((at[told // 3] + 1, moved[first[told]], weight[told]))
        going = (weight >= least) & (count > 0)
        going[equal] &= (pivot > 0) & (at + 1 < depth)
        keep = np.repeat(going, count)
        pointers, weights = moved[keep], heavy[keep]
        live = np.flatnonzero(going)
        size, at = count[live], at[live // 3] + (live % 3 == 1)
    return tuple(np.concatenate([o[i] for o in out]) if out else np.empty(0, np.int64) for i in range(3))


def _rows(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].cast("string").alias("text")).where("text <> ''")


def _by_language(table: pa.Table):
    """(language, texts as bytes) of a table's rows."""
    groups: dict[str, list[bytes]] = {}
    for lang, text in zip(table["lang"].to_pylist(), table["text"].cast(pa.binary()).to_pylist(), strict=True):
        groups.setdefault(lang, []).append(text)
    return groups.items()


def range_keys(rows: DataFrame, most_words: int, range_words: int) -> list[tuple[str, tuple[bytes, ...]]]:
    """Keys (language, words) at which the ranges are cut, ascending, from a bounded sample."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = -(-total // (6 * range_words))
    if ranges < 2:
        return []
    whole = 1 << 30
    sample = rows.where(F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(whole)) < int(min(1.0, SAMPLE_BYTES / total) * whole))
    share = min(1.0, max(SAMPLE_KEYS, 32 * ranges) * 6 / min(total, SAMPLE_BYTES))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("key", T.ArrayType(T.BinaryType()))])

    def run(batches):
        draw = np.random.default_rng(11)
        for table in pieces(batches, 4 << 20):
            for lang, texts in _by_language(table):
                for names, ranks in suffixes(words_of(texts), most_words):
                    ranks = ranks[draw.random(len(ranks)) < share]
                    keys = [[names[i - 1] if i else END for i in r] for r in ranks.tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.list_(pa.binary()))], names=schema.names)

    keys = sorted((r["lang"].encode(), tuple(map(bytes, r["key"]))) for r in sample.mapInArrow(run, schema).collect())
    cuts = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    return [(lang.decode(), key) for lang, key in cuts]


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most_words: int = MOST_WORDS, least: int = LEAST, range_words: int = RANGE_WORDS) -> DataFrame:
    """(lang, phrase, words, n): every phrase of 1 to ``most_words`` words that occurs ``least`` times in its language, and
    one row of no words with the number of all words of each language."""
    rows = _rows(docs, lang_col, text_col)
    cuts = range_keys(rows, most_words, range_words)
    by_lang: dict[str, tuple[int, list]] = {}
    for i, (lang, key) in enumerate(cuts):
        by_lang.setdefault(lang, (i, []))[1].append(key)
    langs = sorted(by_lang, key=str.encode)
    routed = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("words", T.BinaryType()), T.StructField("times", T.BinaryType())])

    def route(batches):
        for table in pieces(batches, 4 << 20):
            for lang, texts in _by_language(table):
                if lang in by_lang:
                    base, keys = by_lang[lang]
                else:
                    later = bisect_left(langs, lang.encode(), key=str.encode)
                    base, keys = by_lang[langs[later]][0] if later < len(langs) else len(cuts), []
                for names, ranks in suffixes(words_of(texts), most_words):
                    key = packed(ranks, len(names))
                    by = np.argsort(key)
                    key = key[by]
                    new = np.ones(len(key), bool)
                    new[1:] = key[1:] != key[:-1]
                    head = np.flatnonzero(new)
                    times = np.diff(np.append(head, len(key)))
                    edges = np.searchsorted(key[head], np.array([key_digits(k, names) for k in keys], np.int64))
                    edges = np.concatenate([[0], edges, [len(head)]])
                    full = np.flatnonzero(np.diff(edges))
                    table_of = np.array([END, *names], object)
                    words, counts = [], []
                    for p in full.tolist():
                        one = slice(edges[p], edges[p + 1])
                        words.append(b" ".join(table_of[ranks[by[head[one]]].ravel()].tolist()))
                        counts.append(b"" if (times[one] == 1).all() else times[one].astype("<u4").tobytes())
                    cols = [pa.array((base + full).astype(np.int32)), pa.array([lang] * len(full), pa.string()), pa.array(words, pa.binary()), pa.array(counts, pa.binary())]
                    yield from pa.Table.from_arrays(cols, names=routed.names).to_batches(max_chunksize=256)

    counted = T.StructType([T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()), T.StructField("words", T.IntegerType()), T.StructField("n", T.LongType())])
    # beginnings of the keys: phrases whose suffixes may lie in several ranges
    shared = {(lang, key[:k]) for lang, key in cuts for k in range(1, most_words) if END not in key[:k]}

    def count(batches):
        held: dict[str, tuple[Vocab, list, list]] = {}
        for batch in batches:
            for lang, words, times in zip(batch.column("lang").to_pylist(), batch.column("words"), batch.column("times").to_pylist(), strict=True):
                if lang not in held:
                    held[lang] = (Vocab({END: 0}), [], [])
                vocab, symbols, weights = held[lang]
                own = words.as_py().split(b" ")
                symbols.append(np.fromiter(map(vocab.__getitem__, own), np.int32, len(own)))
                n = len(own) // most_words
                weights.append(np.frombuffer(times, "<u4").astype(np.int64) if times else np.ones(n, np.int64))
        for lang, (vocab, symbols, weights) in held.items():
            symbols, weights = np.concatenate(symbols), np.concatenate(weights)
            pointers = np.arange(len(weights)) * most_words
            length, pointer, weight = multikey_quicksort(symbols, pointers, weights, most_words, least)
            names = list(vocab)
            phrases, sizes, n = [b""], [0], [int(weights.sum())]
            for k, p, w in zip(length.tolist(), pointer.tolist(), weight.tolist(), strict=True):
                phrase = tuple(names[i] for i in symbols[p:p + k].tolist())
                if (lang, phrase) not in shared:
                    phrases.append(b" ".join(phrase))
                    sizes.append(k)
                    n.append(w)
            at_edge = np.zeros(len(vocab), bool)
            edges = {key: [vocab[w] for w in key] for of, key in shared if of == lang and all(w in vocab for w in key)}
            at_edge[[e[0] for e in edges.values()]] = True
            grid = symbols.reshape(-1, most_words)
            some = np.flatnonzero(at_edge[grid[:, 0]])
            for key, e in edges.items():
                mine = some[(grid[some, :len(e)] == e).all(axis=1)]
                if len(mine):
                    phrases.append(b" ".join(key))
                    sizes.append(len(e))
                    n.append(int(weights[mine].sum()))
            for lo in range(0, len(n), 1 << 14):
                own = slice(lo, lo + (1 << 14))
                cols = [pa.array([lang] * len(n[own]), pa.string()), pa.array([p.decode() for p in phrases[own]], pa.string()), pa.array(sizes[own], pa.int32()), pa.array(n[own], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=counted.names)
        held.clear()
        tidy()

    found = rows.mapInArrow(route, routed).repartitionById(len(cuts) + 1, "part").select("lang", "words", "times").mapInArrow(count, counted)
    return found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("words") == 0))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most_words: int = MOST_WORDS, least: int = LEAST, inside: int = INSIDE, top: int | None = TOP,
                 range_words: int = RANGE_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases of 2 to ``most_words`` words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at its weakest cut, ``score`` floor(1000000 a a / (l r)) there
    (ties: the first cut), ``n`` the language's words. A phrase inside a longer one of ``inside`` percent of its count or more is
    left out. Ranks follow score, count (both descending) and the phrase's bytes; ``top`` None reports all.
    A-Z are lower-cased; null and empty texts have no words; a null language is ``und``; repeated rows count each; other columns
    aren't read. Counts are exact; ``a`` must stay below 10**15.
    """
    if not 2 <= most_words <= 5:
        raise ValueError("phrases of 2 to 5 words at most")
    counts = stored(phrase_counts(docs, lang_col, text_col, most_words, least, range_words), "phrase-counts")
    words = F.split("phrase", " ")
    found = counts.where("words >= 2").withColumnRenamed("n", "a")
    part = lambda first, n: F.array_join(F.slice(F.col("w"), first, n), " ")
    cuts = found.select("lang", "phrase", "a", "words", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "words", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    known = counts.where("words >= 1")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    cuts = cuts.withColumns({"x": (exact("a") * exact("a")).cast("decimal(31,0)") * F.lit(1000000).cast("decimal(7,0)"), "y": exact("l") * exact("r")})
    weakest = cuts.withColumn("score", F.expr("x div y")).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    # phrases of two words or more inside longer ones
    longer = found.where("words >= 3").select("lang", "a", "words", words.alias("w"), F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    longer = longer.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("first"))
    taken = longer.groupBy("lang", part(F.col("first"), F.col("size")).alias("phrase")).agg(F.max("a").alias("most"))
    left = weakest.join(taken, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * F.col("most") < inside * F.col("a")))
    totals = counts.where("words = 0").select("lang", "n")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("m.score"), F.desc("a"), "phrase"))
    ranked = left.select("lang", rank.alias("rank"), "phrase", "a", "m")
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "m.l", "m.r", "n", "m.score")
