import glob
import hashlib
import os

import zstandard

from gridloom.llm import warc_bundles as W
from gridloom.llm.queries import oracle_sql, op3_seekable_warc
from gridloom.llm.words import scratch
from tests.llm import data
from tests.oracle import compare, duck

PAGES = [
    (1, "http://a/1", "x" * 2000), (5, "http://a/5", "x" * 2000), (3, "http://a/3", "x" * 2000), (9, "u", "y" * 999), (8, "u", "y" * 999), (4, None, None), (6, "a\r\nWARC-Type: b", ""),
    (None, "n", "x" * 2000), (None, "n", "z" * 1500), (None, "n", "z" * 1500), (7, "r", "q" * 1200), (7, "r", "q" * 1200), (10, "é", "é\r\n\r\n😀" * 9000), (11, "b", "WARC/1.1\r\n\r\n" * 200)]


def written(spark, rows, **options):
    df = data.clashing(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), ["digest", "payload", "_d"])
    folder = scratch(spark, "test-warc")
    W.write_bundles(W.with_revisits(df), folder, **options)
    return folder


def local(folder):
    return sorted(p for p in glob.glob(f"{folder.removeprefix('file:')}/part-*") if os.path.getsize(p))


def test_round_trip(spark):
    for options in ({}, {"frame_bytes": 3000, "bundle_bytes": 500}):
        folder = written(spark, PAGES, **options)
        got = W.read_records(spark, folder).collect()
        assert len(got) == len(PAGES)
        for r in got:
            if r.record_type == "response":
                assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
        by = {}
        for r in got:
            by.setdefault(r.record_id, []).append(r)
        assert {k: [x.refers_to for x in by[k]] for k in ("1", "3", "5")} == {"1": ["5"], "3": ["5"], "5": [None]}
        assert [x.record_type for x in by["9"] + by["8"] + by["4"] + by["6"] + by["7"]] == ["response"] * 6
        assert sorted((x.record_type, x.refers_to) for x in by[None]) == [("response", None), ("response", None), ("revisit", "5")]
        assert by["10"][0].payload.decode() == PAGES[12][2] and by["4"][0].payload == b""
    assert len(local(folder)) > 3


def test_bundles_are_plain_zstandard_with_a_seek_table(spark):
    for path in local(written(spark, PAGES, frame_bytes=3000)):
        with open(path, "rb") as f:
            raw = f.read()
        frames = W.frames_of(raw)
        assert sum(p for _, p, _ in frames) + 8 * len(frames) + 17 == len(raw)
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        assert whole == b"".join(W._plain(raw, *f) for f in frames) and whole.startswith(b"WARC/1.1\r\n")


def test_index_and_fetch(spark):
    folder = written(spark, PAGES, frame_bytes=3000, bundle_bytes=500)
    entries = W.index(spark, folder)
    assert entries.count() == len(PAGES)
    got = W.fetch(spark, entries, ["10", "7", "1", "no such"]).collect()
    assert sorted(r.record_id for r in got) == ["1", "10", "7", "7"]
    assert next(r for r in got if r.record_id == "10").payload.decode() == PAGES[12][2]
    assert W.fetch(spark, entries, ["no such"]).collect() == []


def test_empty(spark):
    assert W.read_records(spark, written(spark, [])).collect() == []


def test_query(spark, sf_dir):
    ok, why = compare(op3_seekable_warc(spark, sf_dir), duck(sf_dir), oracle_sql()["op3_seekable_warc"])
    assert ok, why
