"""Token ids in files, coded by an adaptive context-mixing range coder.

A file holds the ids of documents in ascending order of id, each ended by ``end_id``. The
ids are cut into blocks of ``BLOCK``; each block starts from an empty model, has checksums of
its coded bytes and of its ids, and can be read alone. In a block every id is predicted
from the two ids before it (order 2), from the last one (order 1) and from what the block
has shown so far (order 0):

* orders 2 and 1 each name one id with a confidence, and the model learns how often a
  prediction of that order and confidence comes true. Both chances are mixed into one
  distribution: the id of order 2, the id of order 1, or neither;
* what neither names is coded by the adaptive frequencies of order 0: the id's
  magnitude and the four bits after its leading one. The rest is plain bits, which
  follow the block's coded ones.

An id is one step of the coder, whose chance is the product of these. All arithmetic is
exact, so every machine decodes what another one coded. The coder steps through many
blocks side by side, one id of each at a time, as arrays.

A file is written by Spark's own writer, one file a row, so retries and lost executors
leave whole files only. No document is split over files; memory is bounded by
``file_ids`` ids (or one document) and ``LANES`` blocks' models.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.words import kept, pieces, tidy

BLOCK = 1024          # ids of a block
LANES = 4096          # blocks coded side by side
FILE_IDS = 4 << 20    # ids of a file, at which it is closed
SLOTS = 10            # bits of the number of contexts that a block tells apart, each order
MAGIC, MARK = b"GTOK2\x00\x00\x00", b"\x00\xffGTOK\xff\n"
HEAD = "<8sqIIQII"  # magic, ordinal, block, blocks, ids, documents, checksum of the document table
HEAD_SIZE = struct.calcsize(HEAD)
LIMIT = 1 << 16       # ids below it can be coded

_WINDOW, _LEAST = 62, 1 << 46                      # bits of the coder's window; its width stays at this or above
_CDF = 12                                          # bits of an order-0 distribution
_MISS = 2 * _CDF                                   # bits of both that a step has besides the 16 of the orders 2 and 1
_RATE, _STEP = 4, 6
_BOUNDS = np.array([64, 64000], np.int32)          # of a learned chance, of 65536


def _targets() -> np.ndarray:
    """What a distribution of 16 symbols moves to once symbol s was seen: _STEP to each, the rest to s."""
    i = np.arange(16)
    return np.where(i <= i[:, None], i * _STEP, (1 << _CDF) - (16 - i) * _STEP).astype(np.int16)


def _split(limit: int = LIMIT) -> tuple[np.ndarray, ...]:
    """Of each id: its magnitude, the bits after the leading one (four at most), the other bits and their number."""
    x = np.arange(1, limit, dtype=np.int64)
    size = np.frexp(x.astype(np.float64))[1] - 1
    next_bits = np.minimum(size, 4)
    rest = size - next_bits
    return size.astype(np.uint8), (x >> rest & ((1 << next_bits) - 1)).astype(np.uint8), (x & ((1 << rest) - 1)).astype(np.uint16), rest.astype(np.uint8)


class Model:
    """The predictions of ``lanes`` blocks, all at the same place of their block; order 2 first, then order 1, end to end."""

    def __init__(self, lanes: int):
        self.lane, self.lanes = np.arange(lanes), lanes
        both = np.arange(2 * lanes)
        self.first, self.row = both << SLOTS, both << 4
        self.named = np.zeros(2 * lanes << SLOTS, np.uint32)  # id * 16 + confidence
        chance = np.concatenate([[1500], 65536 * np.arange(1, 16) // np.arange(3, 18)]).astype(np.int32)
        self.chance = np.tile(chance, 2 * lanes)
        flat = (np.arange(16) << (_CDF - 4)).astype(np.int16)
        self.size = np.tile(flat, (lanes, 1))
        self.next = np.tile(flat, (lanes * 16, 1))
        self.targets = _targets()
        self.context = np.zeros(2 * lanes, np.uint32)
        self.last = np.zeros(lanes, np.uint32)

    def predict(self):
        """(id of order 2, id of order 1, mass of the first, mass of the second of 65536)."""
        self.at = (self.context >> np.uint32(32 - SLOTS)) + self.first
        self.entry = self.named.take(self.at)
        self.sure = self.entry & np.uint32(15)
        self.trust = self.row + self.sure
        self.held = self.chance.take(self.trust)
        self.ids = self.entry >> np.uint32(4)
        two, one = self.ids[: self.lanes], self.ids[self.lanes:]
        h = self.held.view(np.uint32)
        a, b = h[: self.lanes], h[self.lanes:]
        both = a * b
        same = two == one
        p, q = (a - (both >> np.uint32(17))).astype(np.int64), (b - (both >> np.uint32(16))).astype(np.int64)
        rows = np.flatnonzero(same)
        p[rows] = q[rows] + a[rows]
        q[rows] = 0
        return two, one, p, q

    def learn(self, ids: np.ndarray) -> None:
        seen = np.concatenate([ids, ids])
        hit = self.ids == seen
        step = _BOUNDS.take(hit.view(np.uint8))
        step -= self.held
        step >>= 5
        step += self.held
        self.chance[self.trust] = step
        # a named id that came gains confidence; one that did not loses half of it, or its place
        seen <<= np.uint32(4)
        rows = np.flatnonzero(self.sure >= 4)
        seen[rows] = self.entry[rows] - (self.sure[rows] >> np.uint32(1))
        rows = np.flatnonzero(hit)
        seen[rows] = self.entry[rows] + (self.sure[rows] < 15)
        self.named[self.at] = seen
        hashed = ids * np.uint32(0x9E3779B1)
        self.context[self.lanes:] = hashed
        self.last *= np.uint32(0x85EBCA77)
        hashed += self.last
        self.context[: self.lanes] = hashed
        self.last[:] = ids

    def moved(self, table: np.ndarray, rows: np.ndarray, held: np.ndarray, symbol: np.ndarray) -> None:
        step = self.targets.take(symbol, 0)
        step -= held
        step >>= _RATE
        step += held
        table.view("V32").ravel().put(rows, step.view("V32"))  # 16 numbers at once


def _ends(held: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of each row's symbol in its distribution."""
    flat, at = held.ravel(), np.arange(0, 16 * len(symbol), 16) + symbol
    start = flat.take(at).astype(np.int64)
    end = flat.take(at + 1, mode="clip").astype(np.int64)
    end[symbol == 15] = 1 << _CDF
    return start, end - start


def _plain(values: np.ndarray, bits: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Plain bits of each block: its ``counts`` values one after the other, each in its number of bits (1 to 16)."""
    ends = np.concatenate([[0], np.cumsum(bits)])
    edges = ends[np.concatenate([[0], np.cumsum(counts)])]
    total = np.diff(edges)
    sizes = (total + 31 >> 5) + 1
    base = np.cumsum(sizes) - sizes
    words = np.zeros(int(sizes.sum()), np.uint32)
    if len(values):
        at = ends[:-1] + np.repeat((base << 5) - edges[:-1], counts)
        word = at >> 5
        parts = values.astype(np.uint64) << (64 - (at & 31) - bits).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        sums, word = np.add.reduceat(parts, first), word[first]
        words[word] += (sums >> np.uint64(32)).astype(np.uint32)
        words[word + 1] += sums.astype(np.uint32)
    raw = words.astype(">u4").tobytes()
    return [raw[a:a + n] for a, n in zip((base << 2).tolist(), (total + 7 >> 3).tolist(), strict=True)]


def encode_blocks(blocks: np.ndarray) -> list[bytes]:
    """Coded bytes of each row of ids (blocks x ids, below LIMIT): the size of the range-coded ones, these, the plain bits."""
    lanes, steps = blocks.shape
    model, kind = Model(lanes), np.min_scalar_type(lanes)
    size, following, rest, rest_bits = kept("token split", _split)
    columns = np.ascontiguousarray(blocks.T, np.uint32)
    left = np.zeros((steps, lanes), bool)  # neither order 2 nor order 1 named the id
    low, width = np.zeros(lanes, np.int64), np.full(lanes, 1 << _WINDOW, np.int64)
    # words of 16 bits in the order in which blocks give them; a block's last one is held back for carries, the first is a zero
    word, words, owners = np.zeros(lanes, np.int64), [], []
    for k in range(steps):
        ids = columns[k]
        two, one, p, q = model.predict()
        is_two = ids == two
        missed = np.logical_not(is_two | (ids == one), out=left[k])
        start = np.where(is_two, 0, p)
        part = np.where(is_two, p, q)
        start <<= _MISS
        part <<= _MISS
        rows = np.flatnonzero(missed)
        if len(rows):
            own = ids[rows]
            s, n = size.take(own).astype(np.int64), following.take(own).astype(np.int64)
            held = model.size.take(rows, 0)
            s_start, s_part = _ends(held, s)
            model.moved(model.size, rows, held, s)
            context = (rows << 4) + s
            held = model.next.take(context, 0)
            n_start, n_part = _ends(held, n)
            model.moved(model.next, context, held, n)
            named = p[rows] + q[rows]
            mass = (1 << 16) - named
            start[rows] = (named << _MISS) + mass * ((s_start << _CDF) + s_part * n_start)
            part[rows] = mass * s_part * n_part
        width >>= 16 + _MISS
        start *= width
        low += start
        width *= part
        over = np.flatnonzero(low >> _WINDOW)
        if len(over):
            word[over] += 1
            low[over] &= (1 << _WINDOW) - 1
        short = np.flatnonzero(width < _LEAST)
        while len(short):
            x = low[short]
            words.append(word[short])
            owners.append(short.astype(kind))
            word[short] = x >> (_WINDOW - 16)
            low[short] = (x & (_LEAST - 1)) << 16
            w = width[short] << 16
            width[short] = w
            short = short[w < _LEAST]
        model.learn(ids)
    # any number from low to low + width tells the block; one that ends in zero bits, which needn't be written
    every = model.lane.astype(kind)
    owner = np.concatenate([*owners, every, every])
    whole = np.concatenate([*words, word, low + (_LEAST - 1) >> (_WINDOW - 16)])[np.argsort(owner, kind="stable")]
    over = np.flatnonzero(whole >> 16)
    while len(over):  # carries go on to the word before
        whole[over] &= 0xFFFF
        over -= 1
        whole[over] += 1
        over = over[whole[over] >> 16 > 0]
    raw, ends = whole.astype(">u2").tobytes(), np.cumsum(np.bincount(owner, minlength=lanes)) << 1
    left = np.logical_and(left.T, rest_bits[blocks] > 0)
    own = blocks[left]
    plain = _plain(rest[own], rest_bits[own].astype(np.int64), left.sum(1))
    found = (raw[a + 2:b].rstrip(b"\x00") for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))
    return [struct.pack("<I", len(c)) + c + b for c, b in zip(found, plain, strict=True)]


def _words(parts: list[bytes], more: int) -> np.ndarray:
    """Big-endian 16-bit words of each part, filled up with zeros to the longest one and ``more``."""
    words = np.zeros((len(parts), (max(map(len, parts), default=0) + 1) // 2 + more), np.uint16)
    for i, c in enumerate(parts):
        own = np.frombuffer(c + b"\x00" * (len(c) & 1), ">u2")
        words[i, :len(own)] = own
    return words


def decode_blocks(coded: list[bytes], steps: int) -> np.ndarray:
    """The ids (blocks x ``steps``) of coded blocks; bytes beyond a block's end count as zero."""
    lanes = len(coded)
    model = Model(lanes)
    sizes = [4 + struct.unpack_from("<I", c)[0] for c in coded]
    words = _words([c[4:n] for c, n in zip(coded, sizes, strict=True)], 8).astype(np.int64)  # zeros are read past the end
    code = words[:, 0] << 46 | words[:, 1] << 30 | words[:, 2] << 14 | words[:, 3] >> 2
    # the window has 62 bits: the words' bits are met two late, so each word holds its last two and the next one's first 14
    words = ((words[:, :-1] & 3) << 14 | words[:, 1:] >> 2).astype(np.uint16)
    at, end = np.arange(0, words.size, words.shape[1]) + 3, np.arange(1, lanes + 1) * words.shape[1] - 1
    flat = words.ravel()
    plain = _words([c[n:] for c, n in zip(coded, sizes, strict=True)], 3).astype(np.uint32)
    plain = plain[:, :-1] << np.uint32(16) | plain[:, 1:]
    place, bits_of = np.arange(0, plain.size, plain.shape[1]) << 4, plain.ravel()
    width = np.full(lanes, 1 << _WINDOW, np.int64)
    out = np.empty((steps, lanes), np.uint32)

    def find(held, value):
        seen = np.bitwise_count((held <= value.astype(np.int16)[:, None]).view(np.uint64))
        symbol = (seen[:, 0] + seen[:, 1]).astype(np.int64) - 1
        return symbol, *_ends(held, symbol)

    for k in range(steps):
        two, one, p, q = model.predict()
        width >>= 16 + _MISS
        value = (code.view(np.uint64) // width.view(np.uint64)).view(np.int64)
        named = p + q
        is_two = value < p << _MISS
        rows = np.flatnonzero(value >= named << _MISS)
        start = np.where(is_two, 0, p)
        part = np.where(is_two, p, q)
        start <<= _MISS
        part <<= _MISS
        ids = np.where(is_two, two, one)
        if len(rows):
            named = named[rows]
            mass = (1 << 16) - named
            # quotients of numbers of 40 bits by such of 16 are exact: their error is far below one part of the divisor
            value = ((value[rows] - (named << _MISS)) / mass).astype(np.int64)
            held = model.size.take(rows, 0)
            s, s_start, s_part = find(held, value >> _CDF)
            model.moved(model.size, rows, held, s)
            value = ((value - (s_start << _CDF)) / s_part).astype(np.int64)
            context = (rows << 4) + s
            held = model.next.take(context, 0)
            n, n_start, n_part = find(held, value)
            model.moved(model.next, context, held, n)
            start[rows] = (named << _MISS) + mass * ((s_start << _CDF) + s_part * n_start)
            part[rows] = mass * s_part * n_part
            known = np.minimum(s, 4)
            bits = s - known
            x = place[rows]
            place[rows] = x + bits
            tail = bits_of.take(x >> 4) >> (32 - (x & 15) - bits).astype(np.uint32)
            ids[rows] = (((1 << known) | n) << bits | (tail & ((1 << bits) - 1))) - 1
        start *= width
        code -= start
        width *= part
        short = np.flatnonzero(width < _LEAST)
        while len(short):
            x = at[short]
            code[short] = code[short] << 16 | flat.take(np.minimum(x, end[short]))
            at[short] = x + 1
            w = width[short] << 16
            width[short] = w
            short = short[w < _LEAST]
        model.learn(ids)
        out[k] = ids
    return out.T


def pack(ids: np.ndarray, doc_ids: list, sizes: np.ndarray, ordinal: int, block: int = BLOCK) -> bytes:
    """One file without its end mark: head, block table, coded blocks, document table."""
    if len(ids) and int(ids.max()) >= LIMIT:
        raise ValueError(f"ids must be below {LIMIT}")
    coded, table = [], []
    for lo in range(0, len(ids), block * LANES):
        part = ids[lo:lo + block * LANES]
        full = len(part) // block
        made = encode_blocks(part[: full * block].reshape(full, block)) if full else []
        if len(part) > full * block:
            made += encode_blocks(part[None, full * block:])
        coded += made
        for i, c in enumerate(made):
            own = part[i * block:(i + 1) * block].astype("<u4")
            table.append((len(own), len(c), zlib.crc32(c), zlib.crc32(own.tobytes())))
    known = np.array([d is not None for d in doc_ids], np.uint8)
    docs = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + known.tobytes() + sizes.astype("<u8").tobytes()
    head = struct.pack(HEAD, MAGIC, ordinal, block, len(table), len(ids), len(doc_ids), zlib.crc32(docs))
    return b"".join([head, np.array(table, "<u4").tobytes(), *coded, docs])


def unpack(raw: bytes) -> tuple[int, np.ndarray, list, np.ndarray]:
    """(ordinal, ids, document ids, their numbers of ids) of one file; a broken checksum is an error."""
    magic, ordinal, block, blocks, count, documents, check = struct.unpack_from(HEAD, raw)
    if magic != MAGIC or not raw.endswith(MARK):
        raise ValueError("not a whole token file")
    table = np.frombuffer(raw, "<u4", 4 * blocks, HEAD_SIZE).reshape(blocks, 4).astype(np.int64)
    starts = HEAD_SIZE + 16 * blocks + np.concatenate([[0], np.cumsum(table[:, 1])])
    ids = np.empty(count, np.uint32)
    for lo in range(0, blocks, LANES):
        coded = [raw[starts[i]:starts[i + 1]] for i in range(lo, min(lo + LANES, blocks))]
        for i, c in enumerate(coded, lo):
            if zlib.crc32(c) != table[i, 2]:
                raise ValueError(f"block {i}: its bytes aren't the ones that were written")
        full = [c for i, c in enumerate(coded, lo) if table[i, 0] == block]
        parts = [decode_blocks(full, block).ravel()] if full else []
        if len(full) < len(coded):
            parts.append(decode_blocks(coded[-1:], int(table[lo + len(coded) - 1, 0])).ravel())
        at = lo * block
        for part in parts:
            ids[at:at + len(part)] = part
            at += len(part)
        for i in range(lo, lo + len(coded)):
            if zlib.crc32(ids[i * block:i * block + table[i, 0]].astype("<u4").tobytes()) != table[i, 3]:
                raise ValueError(f"block {i}: its ids aren't the ones that were written")
    docs = raw[starts[-1]:len(raw) - len(MARK)]
    if zlib.crc32(docs) != check:
        raise ValueError("the document table isn't the one that was written")
    known = np.frombuffer(docs, np.uint8, documents, 8 * documents)
    doc_ids = [d if k else None for d, k in zip(np.frombuffer(docs, "<i8", documents).tolist(), known, strict=True)]
    return ordinal, ids, doc_ids, np.frombuffer(docs, "<u8", documents, 9 * documents).astype(np.int64)


class Coder:
    """Ids of texts by the tokenizers library, which is asked once for each stretch between spaces.

    Byte-level pre-tokenisation always cuts before a space that a character other than white
    space follows, so a text's ids are those of its stretches, one after the other. Equal
    stretches of a call are found by Arrow, those of earlier calls are looked up; two
    generations of ``size`` of them are remembered. New ones are put to the library in lines of
    ``LINE``; where each of them begins is told by the ids that begin with a space.
    """

    LINE = 64

    def __init__(self, path: str, size: int = 600_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        own = self.library.pre_tokenizer.__getstate__() if hasattr(self.library.pre_tokenizer, "__getstate__") else b""
        self.cuts = b'"ByteLevel"' in own and b'"use_regex":true' in own and b'"add_prefix_space":false' in own and self.library.normalizer is None
        words = self.library.get_vocab()
        self.begins = np.zeros(max(words.values(), default=0) + 1, bool)
        self.begins[[i for w, i in words.items() if w.startswith("Ġ")]] = True
        self.size = size
        self.young: dict[str, int] = {}  # stretch -> its place in sizes
        self.old: dict[str, int] = {}
        self.held, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def library_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and the number of each text's."""
        found = [array("I", e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.frombuffer(b"".join(found), np.uintc).astype(np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def ask(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches on end, those with a space inside first, and the number of each one's."""
        alone = [p for p in stretches if not p or " " in p]
        line = [p for p in stretches if p and " " not in p]
        ids, sizes = self.library_ids([p[1:] if p[:1] == " " else " " + p for p in alone])
        more, _ = self.library_ids([" " + " ".join(line[i:i + self.LINE]) for i in range(0, len(line), self.LINE)])
        starts = np.flatnonzero(self.begins[more])
        n = np.diff(starts, append=len(more))
        if len(starts) != len(line):  # a tokenizer without ids for some bytes
            more, n = self.library_ids([" " + p for p in line])
        return np.concatenate([ids, more]), np.concatenate([sizes, n])

    def places(self, stretches: list[str]) -> np.ndarray:
        """Where ``sizes`` has each of these different stretches; one that begins with a space is a text's first, others have a space before them."""
        if len(self.young) >= self.size or len(self.held) >= 16 * self.size:
            at = np.fromiter(self.young.values(), np.int64, len(self.young))
            self.held, self.sizes = _gathered(self.held, self.sizes, at), self.sizes[at]
            self.old, self.young = dict(zip(self.young, range(len(at)))), {}
        found = np.fromiter(map(self.young.get, stretches, repeat(-1)), np.int64, len(stretches))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            names = [stretches[i] for i in missing.tolist()]
            at = np.fromiter(map(self.old.get, names, repeat(-1)), np.int64, len(names))
            new = np.flatnonzero(at < 0)
            asked = [names[i] for i in new.tolist()]
            ids, sizes = self.ask(asked)
            inside = np.fromiter((not p or " " in p for p in asked), bool, len(asked))
            at[np.concatenate([new[inside], new[~inside]])] = np.arange(len(self.sizes), len(self.sizes) + len(new))
            self.held, self.sizes = np.concatenate([self.held, ids]), np.concatenate([self.sizes, sizes])
            self.young.update((p, k) for p, k in zip(names, at.tolist(), strict=True) if len(p) <= 64)
            found[missing] = at
        return found

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (an array of their bytes in UTF-8) on end, and the number of each text's."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not self.cuts:
            return self.library_ids(_strings(texts))
        lists = pc.split_pattern(texts, pattern=b" ")
        counts = lists.value_lengths().to_numpy().astype(np.int64)
        parts = lists.flatten()
        at = np.cumsum(counts) - counts
        later = np.ones(len(parts), bool)
        later[at] = False
        coded, first = parts.filter(pa.array(later)).dictionary_encode(), parts.take(pa.array(at)).dictionary_encode()
        words = _strings(coded.dictionary)
        # no other stretch begins with a space: these are the texts' first
        stretches = words + [" " + p for p in _strings(first.dictionary)]
        number = np.empty(len(parts), np.int64)
        number[later] = coded.indices.to_numpy()
        number[at] = first.indices.to_numpy().astype(np.int64) + len(words)
        initial = pa.array([p[:1] for p in words], pa.string()).dictionary_encode()
        whole = np.array([not c or c.isspace() for c in initial.dictionary.to_pylist()], bool)[initial.indices.to_numpy()]  # no cut before these
        if whole.any():
            # texts with white space behind a space are cut one by one
            odd = np.logical_or.reduceat(np.append(whole, np.zeros(len(first.dictionary), bool))[number], at)
            names = dict(zip(stretches, range(len(stretches))))
            own = [re.split(r" (?=\S)", t) for t in _strings(texts.filter(pa.array(odd)))]
            cut = [names.setdefault(" " * (k == 0) + p, len(names)) for line in own for k, p in enumerate(line)]
            left, counts = np.repeat(~odd, counts), counts.copy()
            counts[odd] = list(map(len, own))
            mixed, is_odd = np.empty(int(counts.sum()), np.int64), np.repeat(odd, counts)
            mixed[~is_odd] = number[left]
            mixed[is_odd] = cut
            stretches, at = list(names), np.cumsum(counts) - counts
            used = np.bincount(mixed, minlength=len(stretches)) > 0
            stretches = list(compress(stretches, used.tolist()))
            number = (np.cumsum(used) - 1)[mixed]
        place = self.places(stretches)[number]
        return _gathered(self.held, self.sizes, place), np.add.reduceat(self.sizes[place], at)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, sizes = self.ids(pa.array([t.encode("utf-8") for t in texts], pa.binary()))
        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes)
        return [raw[4 * a:4 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def _gathered(values: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs of ``values``, whose sizes are ``sizes``, at these places, end to end."""
    n = sizes[at]
    place = np.repeat((np.cumsum(sizes) - sizes)[at] - np.cumsum(n) + n, n)
    place += np.arange(len(place))
    return values[place]


def _strings(column: pa.Array) -> list[str]:
    """Strings of bytes in UTF-8; what isn't is replaced."""
    try:
        return column.cast(pa.string()).to_numpy(zero_copy_only=False).tolist()
    except pa.ArrowInvalid:  # not UTF-8
        return [t.decode("utf-8", "replace") for t in column.to_pylist()]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS, block: int = BLOCK) -> None:
    """Write the ids of every text, each text's followed by ``end_id``, as token files below ``path``.

    Files are in ascending order of the id (an integer; null first; ties by the text's hash, then as they come).
    A null text is empty and has its end only. Repeated rows are written each. Empty input: no file. Other
    columns aren't read. ``tokenizer`` names a file that every executor can read.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.monotonically_increasing_id()).withColumn("h", F.xxhash64("text"))
    order = ["doc_id", "h", "tie"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept(f"token coder {tokenizer}", lambda: Coder(tokenizer))
        task, files = TaskContext.get().partitionId(), 0
        held, names, sizes, size = [], [], [], 0

        def close():
            nonlocal held, names, sizes, size, files
            raw = pack(np.concatenate(held), names, np.array(sizes), (task << 31) + files, block)
            held, names, sizes, size = [], [], [], 0
            files += 1
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["value"])

        for table in pieces(batches, 4 << 20):
            ids, counts = coder.ids(table["text"].cast(pa.binary()).combine_chunks())
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id)
            ends += np.arange(1, len(ends) + 1)
            for name, n, to in zip(table["doc_id"].to_pylist(), (counts + 1).tolist(), ends.tolist(), strict=True):
                if size and size + n > file_ids:
                    yield close()
                held.append(ids[to - n:to])
                names.append(name)
                sizes.append(n)
                size += n
        if names:
            yield close()
        tidy()

    packed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, T.StructType([T.StructField("value", T.BinaryType())]))
    (packed.select(F.col("value").cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", MARK.decode("latin-1")).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    return spark.read.format("binaryFile").schema(schema).load(path).where("length > 0")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, path, first_id, ids, documents) of every file: its place in the order and the ids in all files before it."""
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("ordinal", T.LongType()), T.StructField("ids", T.LongType()), T.StructField("documents", T.LongType())])

    def run(batches):
        for batch in batches:
            heads = [struct.unpack(HEAD, h) for h in batch.column("head").to_pylist()]
            cols = [batch.column("path"), *(pa.array([h[i] for h in heads], pa.int64()) for i in (1, 4, 5))]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    heads = _files(spark, path).select("path", F.substring("content", 1, HEAD_SIZE).alias("head")).mapInArrow(run, schema).withColumn("task", F.shiftright("ordinal", 31))
    # two short sums: the files of a task, and the tasks
    before = lambda by: by.rowsBetween(Window.unboundedPreceding, -1)
    tasks = heads.groupBy("task").agg(F.sum("ids").alias("n")).select("task", F.coalesce(F.sum("n").over(before(Window.orderBy("task"))), F.lit(0)).alias("first"))
    joined = heads.join(tasks, "task")
    return joined.select("ordinal", "path", (F.col("first") + F.coalesce(F.sum("ids").over(before(Window.partitionBy("task").orderBy("ordinal"))), F.lit(0))).alias("first_id"), "ids", "documents")


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in the files below ``path``.

    ``start`` counts the ids of all documents before it, over all files; ``ids`` are little-endian unsigned
    32-bit integers, their checksum that of the same bytes.
    """
    fields = [("doc_id", T.LongType()), ("ordinal", T.LongType()), ("first", T.LongType()), ("n_tokens", T.LongType()), ("ids_crc32", T.LongType())]
    schema = T.StructType([*(T.StructField(n, t) for n, t in fields), *([T.StructField("ids", T.BinaryType())] if ids else [])])

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                ordinal, values, names, sizes = unpack(content.as_py())
                ends = np.cumsum(sizes)
                raw = memoryview(values.astype("<u4").tobytes())
                step = 1 << 12
                for lo in range(0, len(names), step):
                    n, to = sizes[lo:lo + step], ends[lo:lo + step]
                    own = [raw[4 * (b - a):4 * b] for a, b in zip(n.tolist(), to.tolist(), strict=True)]
                    cols = [pa.array(names[lo:lo + step], pa.int64()), pa.array(np.full(len(n), ordinal)), pa.array(to - n), pa.array(n), pa.array([zlib.crc32(x) for x in own], pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols + ([pa.array([bytes(x) for x in own], pa.binary())] if ids else []), names=schema.names)
        tidy()

    docs = _files(spark, path).select("content").mapInArrow(run, schema)
    joined = docs.join(manifest(spark, path).select("ordinal", "first_id"), "ordinal")
    return joined.select("doc_id", (F.col("first_id") + F.col("first")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))
