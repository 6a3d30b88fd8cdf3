"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about ``frame_bytes``;
each bundle file ends in a seek table (a skippable frame that lists the size of
each frame, read from the end of the file). The index maps a record's identifier to
file, frame and the offset inside the frame, so one record costs one frame.

Files are written by Spark's own writer, one bundle a file, so the commit
protocol keeps whole files only, retries and lost executors leave nothing
behind, and any Hadoop file system will do: the text writer puts the row's bytes
and then its line separator, and the separator is the last field of the seek table.
Each bundle is bounded by ``bundle_bytes``; no task holds more than one.
"""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.words import stored

# fixed values of the seekable format
SKIPPABLE = 0x184D2A5E
SEEKABLE = bytes([0xB1, 0xEA, 0x92, 0x8F])  # 0x8F92EAB1, little-endian

FRAME_BYTES = 1 << 20    # of records, before compression
BUNDLE_BYTES = 16 << 20  # of a file, at which it is closed
REVISIT_BYTES = 1000     # smaller payloads are always stored
ID_PREFIX = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # of all records, where the pages have none


def _clean(value: str) -> str:
    """A header's value: controls can't stand in it."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str = DATE) -> bytes:
    """One WARC record; a revisit has the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID_PREFIX}{'' if refers_to is None else refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Footer of frames (compressed, plain size) without the four bytes of its end mark."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IB", len(frames), 0)
    return struct.pack("<II", SKIPPABLE, len(body) + 4) + body


def frames_of(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed, plain size) of each frame, from the footer."""
    if bundle[-4:] != SEEKABLE:
        raise ValueError("no seek table at the end")
    count, flags = struct.unpack("<IB", bundle[-9:-4])
    width = 12 if flags & 128 else 8
    at, out = len(bundle) - 9 - width * count, []
    start = 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", bundle, at + width * i)
        out.append((start, packed, plain))
        start += packed
    return out


def records_in(frame: bytes):
    """(offset, length, headers, block) of each record of one frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        first, size = end + 4, int(headers["Content-Length"])
        yield at, first + size + 4 - at, headers, frame[first:first + size]
        at = first + size + 4


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest (SHA-1), refers_to, revisit of every row.

    Of rows with equal payloads of ``least`` bytes or more, those with the largest id
    stay, the others refer to it. A null payload is empty; a row without an id can only
    be a revisit; where no row of a group has an id, all stay. Copies are found on
    digests alone: that table is aggregated before it is shuffled, stored, and its
    known size lets Spark choose how to join it.
    """
    rows = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"),
        F.coalesce(pages[payload_col].cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    groups = (
        rows.where(F.octet_length("payload") >= least).groupBy(F.col("digest").alias("_d"))
        .agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and _top is not null").select("_d", "_top"))
    joined = rows.join(stored(groups, "warc-groups"), (F.col("digest") == F.col("_d")) & (F.octet_length("payload") >= least), "left")
    other = F.col("_top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top"))
    return joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("_top")).alias("refers_to"), other.alias("revisit"))


def write_bundles(rows: DataFrame, path: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = 3) -> None:
    """Write the rows of :func:`with_revisits` as bundle files below ``path``.

    A record larger than a frame has a frame of its own. Empty input: no bundle file.
    """

    def pack(batches):
        press = zstandard.ZstdCompressor(level=level)
        held, size, done, frames, written = [], 0, [], [], 0

        def close_frame():
            nonlocal held, size, written
            plain = b"".join(held)
            packed = press.compress(plain)
            done.append(packed)
            frames.append((len(packed), len(plain)))
            written += len(packed)
            held, size = [], 0

        def bundle():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(done) + seek_table(frames)], pa.binary())], names=["value"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit")), strict=True):
                made = record(*row)
                if held and size + len(made) > frame_bytes:
                    close_frame()
                    if written >= bundle_bytes:
                        yield bundle()
                        done, frames, written = [], [], 0
                held.append(made)
                size += len(made)
        if held:
            close_frame()
        if done:
            yield bundle()

    packed = rows.mapInArrow(pack, T.StructType([T.StructField("value", T.BinaryType())]))
    (packed.select(F.col("value").cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", SEEKABLE.decode("latin-1")).text(path))


def _bundles(spark: SparkSession, path) -> DataFrame:
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    return spark.read.format("binaryFile").schema(schema).load(path).where("length > 0").select("path", "content")


def _plain(bundle: bytes, start: int, packed: int, plain: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(bundle[start:start + packed], max_output_size=max(plain, 1))


def _id_of(value: str | None) -> str | None:
    """The page's id inside a record identifier, as text."""
    if value is None:
        return None
    return value[len(ID_PREFIX) + 1:-1] or None


RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType())])


def _parsed(headers: dict, block: bytes, payloads: bool) -> tuple:
    """A RECORD; the payload read is held against the digest in its header."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?im)^Content-Length: (\d+)", http)[1])
    response = headers["WARC-Type"] == "response"
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: its payload isn't the one that was written")
    return (_id_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), headers["WARC-Type"], _id_of(headers.get("WARC-Refers-To")), size, digest,
            payload if response and payloads else None)


def _rows(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[f.dataType.simpleString()]) for i, f in enumerate(schema)], names=schema.names)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the bundles below ``path``; a revisit has no payload of its own."""

    def unpack(batches):
        for batch in batches:
            for content in batch.column("content"):
                bundle = content.as_py()
                for frame in frames_of(bundle):
                    got = [_parsed(headers, block, payloads) for _, _, headers, block in records_in(_plain(bundle, *frame))]
                    yield _rows(RECORD, got)

    return _bundles(spark, path).mapInArrow(unpack, RECORD)


INDEX = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("path", T.StringType()), T.StructField("frame", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])


def index(spark: SparkSession, path: str) -> DataFrame:
    """Record identifier -> file, frame, offset in the frame and length, read from what was written."""

    def scan(batches):
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                bundle = content.as_py()
                for k, frame in enumerate(frames_of(bundle)):
                    yield _rows(INDEX, [(_id_of(h["WARC-Record-ID"]), file, k, at, size) for at, size, h, _ in records_in(_plain(bundle, *frame))])

    return _bundles(spark, path).mapInArrow(scan, INDEX)


def fetch(spark: SparkSession, entries: DataFrame, record_ids: list[str]) -> DataFrame:
    """The records with these identifiers (a short list), by way of the index ``entries``.

    Only the files that hold them are opened and only their frames unpacked.
    """
    hits = entries.where(F.col("record_id").isin(record_ids)).collect()  # a few rows for each identifier asked for
    wanted: dict[str, dict[int, list[tuple[int, int]]]] = {}
    for h in hits:
        wanted.setdefault(h["path"], {}).setdefault(h["frame"], []).append((h["offset"], h["length"]))
    if not wanted:
        return spark.createDataFrame([], RECORD)

    def seek(batches):
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                bundle = content.as_py()
                frames = frames_of(bundle)
                for k, places in wanted.get(file, {}).items():
                    plain = _plain(bundle, *frames[k])
                    yield _rows(RECORD, [_parsed(h, block, True) for at, size in places for _, _, h, block in records_in(plain[at:at + size])])

    return _bundles(spark, list(wanted)).mapInArrow(seek, RECORD)
