"""SentencePiece encoding and decoding by backtracking (merge-type models).

A byte-pair encoding is the one segmentation in which every two neighbouring
pieces survive being merged again from their characters. The encoder walks the
text with the longest piece at each place (all pieces found by one Aho-Corasick
scan), accepts it when it is compatible with the piece before it, and otherwise
falls back to shorter ones or gives the last piece back. A bitfield remembers
the places from which no segmentation goes on, so no place is tried twice and
the work stays linear.

The model file is read here directly; the sentencepiece library is not used.
Models that this reading can't express exactly are refused when loaded.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridloom.llm.words import kept, tidy

SPACE = "▁"
UNKNOWN = "�"
NORMAL, UNK, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE = 1 << 17  # entries of each generation of a memo table; some 60 MB in all


def _fields(raw: bytes):
    """(number, value) of each field of one protocol-buffer message."""
    at, end = 0, len(raw)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            size = varint()
            yield key >> 3, raw[at:at + size]
            at += size
        else:
            size = 8 if key & 7 == 1 else 4
            yield key >> 3, raw[at:at + size]
            at += size


class Memo:
    """A bounded memory: when the young generation is full it becomes the old one, whose entries live on if asked for."""

    def __init__(self, size: int = CACHE):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        got = self.young.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class PieceModel:
    """Pieces, merge ranks and the exact encoder and decoder of one model file."""

    def __init__(self, path: str):
        import struct

        with open(path, "rb") as f:
            raw = f.read()
        self.pieces, kinds, scores, trainer, norm = [], [], [], {}, {}
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                norm = dict(_fields(value))
        self.kinds = kinds
        normal = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == NORMAL}
        chars = {c for p in normal for c in p}
        wrong = [
            ("a merge-type model", trainer.get(3, 1) == 2),
            ("byte fallback", trainer.get(35, 0) == 1),
            ("no normalisation rules", not norm.get(2) and norm.get(3, 1) == 1 and norm.get(4, 1) == 0 and norm.get(5, 1) == 1),
            ("no user-defined or unused pieces", not {USER, UNUSED} & set(kinds)),
            ("characters that are pieces", all(c in normal for c in chars)),
            ("space marks only at the start of pieces", not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal)),
        ]
        if missing := [what for what, holds in wrong if not holds]:
            raise ValueError(f"{path}: this encoder needs {', '.join(missing)}")
        self.ids, self.chars = normal, chars
        self.scores = {p: scores[i] for p, i in normal.items()}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == BYTE}
        self.id_bytes = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.scan = ahocorasick.Automaton()
        for p, i in normal.items():
            if self.merged(p) == [p]:  # others never come out of merging
                self.scan.add_word(p, (len(p), i))
        self.scan.make_automaton()
        self.plain = [b"" if k == CONTROL else " ⁇ ".encode() if k == UNK else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, kinds, strict=True)]
        for i, b in self.id_bytes.items():
            self.plain[i] = b
        self.decimal = [b"%d" % i for i in range(len(self.pieces))]
        # Merges never cross a place whose two characters stand side by side in no piece, so a text is
        # encoded unit by unit: before a space, around a line feed, and before the characters (points, digits
        # and the like) that follow none but each other inside pieces.
        pairs = {p[k:k + 2] for p in normal for k in range(len(p) - 1)}
        apart = {c for c in chars if not c.isalpha() and c not in (SPACE, "\n")}
        while bad := {p[1] for p in pairs if p[1] in apart and p[0] != SPACE and p[0] not in apart}:
            apart -= bad
        some = "".join(map(re.escape, sorted(apart))) or "\n"
        lone = "\n" if "\n" not in chars else " "
        self.units = re.compile(f" *[^ {lone}{some}]+| *[{some}]+[^ {lone}{some}]*|\n| +")
        self._fits = Memo()   # (left piece, right piece) -> compatible
        self._units = Memo()  # unit -> ids

    def rest(self) -> None:
        """Between tasks: keep the young generations only."""
        for memo in (self._fits, self._units):
            memo.old = {}
        tidy()

    def merged(self, text: str) -> list[str]:
        """Merge from characters: always the pair with the best score, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, left: int, right: int) -> bool:
        known = self._fits.get((left, right))
        if known is None:
            a, b = self.pieces[left], self.pieces[right]
            known = self.merged(a + b) == [a, b]
            self._fits.put((left, right), known)
        return known

    def _run(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces, by backtracking."""
        size = len(text)
        found: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for end, match in self.scan.iter(text):
            found[end - match[0] + 1].append(match)  # shorter ones come first
        failed = bytearray(size // 8 + 1)  # bit p: no segmentation goes on from p
        out: list[int] = []
        ends, left = [0], [len(found[0])]  # open places and how many of their options are untried
        at = 0
        while at < size:
            options, k = found[at], left[-1]
            before = out[-1] if out else -1
            while k:
                k -= 1
                length, piece = options[k]
                end = at + length
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                if before >= 0:
                    good = self._fits.young.get((before, piece))
                    if not (self._compatible(before, piece) if good is None else good):
                        continue
                left[-1] = k
                out.append(piece)
                ends.append(end)
                at = end
                left.append(len(found[at]) if at < size else 0)
                break
            else:
                # nothing fits behind the piece that ends here: give it back
                if not out:
                    raise ValueError("no segmentation")
                failed[at >> 3] |= 1 << (at & 7)
                out.pop()
                ends.pop()
                left.pop()
                at = ends[-1]
        return out

    def _unit(self, text: str) -> tuple[int, ...]:
        """Ids of one unit; characters outside the model become bytes."""
        if self.chars.issuperset(text):
            return tuple(self._run(text))
        ids, known = [], ""
        for c in text:
            if c in self.chars:
                known += c
                continue
            if known:
                ids += self._run(known)
                known = ""
            ids += [self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")]
        return tuple(ids + self._run(known) if known else ids)

    def units_of(self, text: str) -> list[tuple[int, ...]]:
        """Ids of each unit of a text."""
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, " ")
        units = self.units.findall(" " + text)
        memo = self._units
        out = list(map(memo.young.get, units))
        if None in out:
            for k, got in enumerate(out):
                if got is None:
                    unit = units[k]
                    if (got := memo.get(unit)) is None:
                        got = self._unit(unit.replace(" ", SPACE))
                        if len(unit) <= 64:
                            memo.put(unit, got)
                    out[k] = got
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; null counts as empty."""
        return list(chain.from_iterable(self.units_of(text or "")))

    def decode(self, ids) -> str:
        """Text of ids: byte pieces are read as UTF-8 (each faulty byte becomes U+FFFD), one leading space goes."""
        raw = b"".join(map(self.plain.__getitem__, ids))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._mended(ids)
        if text.startswith(" "):
            first = next(i for i in ids if self.kinds[i] != CONTROL)
            if self.pieces[first].startswith(SPACE):
                text = text[1:]
        return text

    def _mended(self, ids) -> str:
        """Byte pieces that aren't UTF-8: each run is read by itself, fault by fault."""
        out: list[str] = []
        raw = b""
        for i in [*ids, -1]:
            if i in self.id_bytes:
                raw += self.id_bytes[i]
                continue
            while raw:
                size = next((n for n in (1, 2, 3, 4) if _is_char(raw[:n])), 0)
                out.append(raw[:size].decode() if size else UNKNOWN)
                raw = raw[size or 1:]
            if i >= 0:
                out.append(self.plain[i].decode())
        return "".join(out)


def _is_char(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def encode(docs: DataFrame, model_path: str, text_col: str = "text", keep: list[str] | None = None, ids: bool = True, digests: bool = False) -> DataFrame:
    """Columns ``keep`` of every row plus its tokens; no shuffle, rows stay where they are.

    ``ids`` adds ``ids`` (the token ids) and ``decoded`` (the text that they give
    back); ``digests`` adds ``n_tokens``, ``ids_sha256`` (of the decimal ids joined
    by commas) and ``decoded_sha256``. A null or empty text has no tokens and
    decodes to the empty text. Repeated rows and null ids don't matter, other columns
    aren't read, and a column of ``keep`` with the name of an added one gives way to it.
    Texts of any length are encoded whole.
    """
    keep = ["doc_id"] if keep is None else keep
    added = [("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())] if ids else []
    added += [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())] if digests else []
    keep = [k for k in keep if k.lower() not in {n for n, _ in added}]
    source = docs.select(*[docs[k].alias(f"k{i}") for i, k in enumerate(keep)], docs[text_col].alias("text"))
    schema = T.StructType([T.StructField(f"k{i}", docs.schema[k].dataType) for i, k in enumerate(keep)] + [T.StructField(n, t) for n, t in added])

    def run(batches):
        model = kept(f"pieces {model_path}", lambda: PieceModel(model_path))
        for batch in batches:
            step = 256
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                cols: dict[str, list] = {n: [] for n, _ in added}
                for text in part.column("text").to_pylist():
                    flat = model.encode(text)
                    back = model.decode(flat)
                    if ids:
                        cols["ids"].append(flat)
                        cols["decoded"].append(back)
                    if digests:
                        cols["n_tokens"].append(len(flat))
                        cols["ids_sha256"].append(hashlib.sha256(b",".join(map(model.decimal.__getitem__, flat))).hexdigest())
                        cols["decoded_sha256"].append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                made = [pa.array(cols[n], {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}.get(n, pa.string())) for n, _ in added]
                yield pa.RecordBatch.from_arrays([*(part.column(f"k{i}") for i in range(len(keep))), *made], names=schema.names)
        model.rest()

    return source.mapInArrow(run, schema).toDF(*keep, *(n for n, _ in added))
