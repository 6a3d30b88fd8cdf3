import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from gridloom.llm import piece_bpe
from gridloom.llm.queries import TOKENIZER, op8_sentencepiece
from tests.llm import data


@pytest.fixture(scope="module")
def pair():
    return piece_bpe.PieceModel(TOKENIZER), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_encodes_as_the_library(pair):
    own, lib = pair
    r = random.Random(1)
    texts = ["", " ", "  a  b ", "a\nb", "\n", "▁a", "a▁b", "\x00", "<s>", "<unk>", "<0x0A>", "é", "�", "🏳️‍🌈 x", " " * 50, "a" * 3000, "ab" * 900, "=" * 99, "𐍈 x"]
    texts += ["".join(r.choice("aabcdet  \n▁éñ😀𐍈\x01=.,") for _ in range(r.randint(1, 60))) for _ in range(1000)]
    texts += [t or "" for _, t in data.documents() + data.hard_texts()]
    for t in texts:
        assert own.encode(t) == lib.encode(t)


def test_decodes_as_the_library(pair):
    own, lib = pair
    r = random.Random(2)
    for _ in range(1500):
        ids = [r.randint(3, 300) if r.random() < 0.5 else r.randint(3, 31_999) for _ in range(r.randint(0, 12))]
        assert own.decode(ids) == lib.decode(ids)


def test_query(spark, sf_dir, pair):
    _, lib = pair
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op8_sentencepiece(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id] or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))


def test_hard_cases(spark):
    rows = data.hard_texts()
    df = data.clashing(data.frame(spark, rows), ["ids", "k0", "n_tokens"])
    got = piece_bpe.encode(df, TOKENIZER, keep=["doc_id", "k0", "ids"]).collect()
    assert len(got) == len(rows) and all(r.k0 == "clash" for r in got)
    assert [r.ids for r in got if r.doc_id in (6002, 6003)] == [[], []]
    assert piece_bpe.encode(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER).collect() == []


def test_unfit_model_is_refused(tmp_path):
    path = tmp_path / "m.model"
    path.write_bytes(b"")
    with pytest.raises(ValueError, match="needs"):
        piece_bpe.PieceModel(str(path))
