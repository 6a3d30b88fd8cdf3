import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridloom.llm import queries
from gridloom.llm import token_files as K
from tests.llm import data

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def awkward(n=400):
    r = random.Random(8)
    bits = [" ", "  ", "\t", "\n", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "it's", "We'LL", "abc", "Zürich", "😀", "한국", "1234", "!?", "<|endoftext|>", "​", "é", "\x00", "ﷺ"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(n)] + ["", " ", "\n", "x" * 5000, " a", "a ", "  a"]


def test_stretches_give_the_ids_of_whole_texts(library):
    texts = awkward() + [t or "" for _, t in data.documents() + data.hard_texts()]
    coder = K.Coder(PATH, size=300)  # so that generations change
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.cuts
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in coder(texts)] == want


def test_new_stretches_are_put_to_the_library_together(library):
    """Each once, in lines of many: a call of the library for every stretch took most of the tokenizer's time."""
    asked = []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)

    coder = K.Coder(PATH)
    coder.library = Counting()
    texts = [" ".join(f"w{(i * 7 + k) % 3000}x" for k in range(300)) for i in range(50)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in coder(texts)] == want
    assert 0 < len(asked) <= 80 + 50 and sum(len(t.split()) for t in asked) <= 3000 + 50


def test_stretches_remembered_are_bounded(library):
    coder = K.Coder(PATH, size=100)
    for k in range(30):
        texts = [" ".join(f"{k} v{k}{j} " for j in range(90)), "z" * 300 + f"{k}", "", " \n a  b "]
        assert [np.frombuffer(x, "<u4").tolist() for x in coder(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert max(len(coder.young), len(coder.old), len(coder.sizes)) <= 500


def test_broken_utf8(library):
    raw = [b"a \xff\xe2 \x82 b", b"\xf0\x9f", b"ok ok"]
    ids, sizes = K.Coder(PATH).ids(K.pa.array(raw, K.pa.binary()))
    want = [e.ids for e in library.encode_batch([t.decode("utf-8", "replace") for t in raw], add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


@pytest.mark.parametrize("kind", ["random", "equal", "ends", "periodic", "words", "rising"])
def test_blocks_come_back(kind):
    r = np.random.default_rng(3)
    ids = {"random": lambda: r.integers(0, K.LIMIT - 1, (7, 300)), "equal": lambda: np.full((5, 700), 9), "ends": lambda: r.choice([0, K.LIMIT - 2], (6, 400)),
           "periodic": lambda: np.tile([5, 60000, 5, 7, 31, 50256], (4, 200)), "words": lambda: (r.pareto(0.4, (9, 900)) % 50000).astype(int),
           "rising": lambda: np.arange(4 * 512).reshape(4, 512) * 31}[kind]()
    coded = K.encode_blocks(ids)
    assert (K.decode_blocks(coded, ids.shape[1]) == ids).all()
    assert (K.decode_blocks(coded[2:3], ids.shape[1]) == ids[2:3]).all()  # a block is read alone
    if kind in ("equal", "periodic"):
        assert sum(map(len, coded)) < ids.size / 8


def test_predictions_pay():
    """Ids that follow from the last two cost less than ids that don't."""
    r = np.random.default_rng(5)
    chain = r.integers(0, 50000, (300, 2))
    ids, state = np.empty((2, 4000), int), 0
    for k in range(4000):
        state = (state * 31 + 7 + (r.random() < 0.1)) % 300
        ids[0, k] = chain[state, 0]
    ids[1] = r.permutation(ids[0])
    a, b = map(len, K.encode_blocks(ids))
    assert a < b / 2 and b < 2 * 4000


def test_files(library):
    ids = np.array(library.encode("one two three " * 3000).ids + [0], np.uint32)
    raw = K.pack(ids, [None, -5], np.array([1, len(ids) - 1]), 77, block=256) + K.MARK
    ordinal, got, names, sizes = K.unpack(raw)
    assert (ordinal, names, sizes.tolist()) == (77, [None, -5], [1, len(ids) - 1]) and (got == ids).all()
    for at in (K.HEAD_SIZE + 16 * -(-len(ids) // 256) + 3, len(raw) - len(K.MARK) - 4):  # a block's bytes, the document table
        with pytest.raises(ValueError):
            K.unpack(raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1:])
    with pytest.raises(ValueError):
        K.unpack(raw[:-3])
    with pytest.raises(ValueError):
        K.pack(np.array([K.LIMIT], np.uint32), [1], np.array([1]), 0)


def expected(rows, library):
    """Rows in ascending order of id; ties in either order, so starts of equal ids are compared as a whole."""
    out, start = [], 0
    for d, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_whole_table(spark, tmp_path, library):
    r = random.Random(1)
    rows = [(i, t) for i, t in enumerate(awkward())] + [(5000 + d, t) for d, t in data.documents(60)] + [(9000, "y" * 100_000), (-3, " ".join(r.choices(["a", "bb", "ccc"], k=200_000))), (None, "no id")]
    rows.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    mixed = r.sample(rows, len(rows))
    df = data.clashing(data.frame(spark, mixed, parts=7), ["h", "tie", "value", "start", "ids"])
    K.write_tokens(df, f"{tmp_path}/f", PATH, file_ids=20_000, block=512)
    got = K.read_tokens(spark, f"{tmp_path}/f")
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    found = got.collect()
    want = expected(rows, library)
    assert sorted(tuple(x)[:4] for x in found if x.doc_id is not None) == sorted(x for x in want if x[0] is not None)
    assert [tuple(x)[:4] for x in found if x.doc_id is None] == [x for x in want if x[0] is None]
    assert all(zlib.crc32(x.ids) == x.ids_crc32 and len(x.ids) == 4 * x.n_tokens for x in found)
    files = K.manifest(spark, f"{tmp_path}/f").orderBy("ordinal").collect()
    assert len(files) > 5 and [f.first_id for f in files] == [sum(f.ids for f in files[:i]) for i in range(len(files))]


def test_repeated_ids_and_empty(spark, tmp_path, library):
    rows = [(1, "a b c"), (1, "a b c"), (1, "d"), (2, None), (2, ""), (None, "x"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/t/documents.parquet")
    got = sorted(map(tuple, queries.op12_token_files(spark, f"{tmp_path}/t").collect()), key=lambda x: x[1])
    ends = [x[1] + x[2] for x in got]
    assert [x[1] for x in got] == [0, *ends[:-1]] and [x[0] for x in got] == [None, None, 1, 1, 1, 2, 2]
    assert sorted((x[2], x[3]) for x in got) == sorted((x[2], x[3]) for x in expected(rows, library))
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert queries.op12_token_files(spark, f"{tmp_path}/e").collect() == []
