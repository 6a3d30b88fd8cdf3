import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gridloom.llm import katz as K
from gridloom.llm.queries import op6_katz
from tests.llm import data


def plain(rows):
    """(id, held out, tokens, known, N, base, score) of every row, and the model's conditional distributions."""
    tokens = lambda t: (t or "").encode().lower().split() + [0]
    uni, bi, ctx = Counter(), Counter(), Counter()
    for _, t, held in rows:
        if not held:
            last = 1
            for w in tokens(t):
                uni[w] += 1
                bi[last, w] += 1
                ctx[last] += 1
                last = w
    n, v = sum(uni.values()), len(uni)

    def discounts(counts):
        of = Counter(counts.values())
        r = sorted(of)
        return K.Discounts(np.array(r, float), np.array([of[x] for x in r], float))

    d1, d2 = discounts(uni), discounts(bi)
    word = {w: float(d1(c)) * c / n for w, c in uni.items()}
    unknown = 1 - sum(word.values()) if n else 1.0
    after = defaultdict(list)
    for (h, w), r in bi.items():
        after[h].append((w, r))
    alpha = {h: (1 - sum(float(d2(r)) * r for _, r in f) / ctx[h]) / (1 - sum(word[w] for w, _ in f)) for h, f in after.items()}

    def p(h, w):
        if (h, w) in bi:
            return float(d2(bi[h, w])) * bi[h, w] / ctx[h]
        return alpha.get(h, 1.0) * word.get(w, unknown)

    out = []
    for d, t, held in rows:
        last, score, base, known = 1, 0.0, 0.0, 0
        for w in tokens(t):
            base += math.log10((uni[w] + 1) / (n + v + 1))
            known += uni[w] > 0
            score += math.log10(p(last, w))
            last = w
        out.append((d, held, len(tokens(t)), known, n, base, score))
    return out, (alpha, ctx, bi, uni, p, unknown)


def check(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 3))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-6) and a[6] == pytest.approx(b[6], rel=1e-7, abs=1e-5)


def rows_of(rows):
    return [(d, t, zlib.crc32(str(d).encode()) % 7 == 2) for d, t in rows]


def test_scores_and_tables(spark, monkeypatch):
    rows = rows_of(data.documents(120) + data.hard_texts()) + [(1, "ZZZ qqq zzz", True), (2, "the " * 500, False)]
    want, (alpha, ctx, bi, _, _, _) = plain(rows)
    for size in (24 << 20, 150_000):  # one bucket; many, with frequent words apart
        monkeypatch.setattr(K, "BUCKET_BYTES", size)
        monkeypatch.setattr(K, "BATCH_BYTES", 2 * size)
        df = data.clashing(data.frame(spark, rows, "doc_id long, text string, h boolean"), ["held", "kind", "slot"])
        got, path = K.train_and_score(df, F.col("h"))
        check(got.collect(), want)
        name = lambda w: np.uint64(K.END if w == 0 else K.START if w == 1 else xxhash.xxh64_intdigest(w)).astype(np.int64)
        stored = {(r.context, r.word): r.n for r in K.bigram_rows(spark, path).collect()}
        assert stored == {(name(h), name(w)): r for (h, w), r in bi.items()}
        weights = {r.context: (r.n, r.alpha) for r in K.context_rows(spark, path).collect()}
        assert set(weights) == {name(h) for h in alpha}
        for h, a in alpha.items():
            assert weights[name(h)] == (ctx[h], pytest.approx(a, rel=1e-9))


def test_one_bigram_or_context_does_not_fill_a_bucket(spark, monkeypatch):
    """Places by bucket, for a bigram with a third of the rows, one found only in held-out texts, and a context with many unseen words."""
    rows = [(i, "the " * 60 + " ".join(f"w{i}x{j}" for j in range(60)), False) for i in range(60)]
    rows += [(100 + i, "qq rr " * 60 + " ".join(f"the v{i}x{j}" for j in range(60)), True) for i in range(30)]
    rows += [(200, None, False), (None, "the the w1x1", True)]
    monkeypatch.setattr(K, "BUCKET_BYTES", 4_000)
    real_counted, real_weighed, places = K._counted, K._weighed, {}

    def counted(dealt, *rest):
        for r in dealt.where("kind = 'occ'").select("p", "blob").collect():
            places["w", r.p] = places.get(("w", r.p), 0) + len(K.unpack(bytes(r.blob))[4])
        return real_counted(dealt, *rest)

    def weighed(met, *rest):
        for r in met.where("kind = 'unseen'").select("q", "blob").collect():
            places["h", r.q] = places.get(("h", r.q), 0) + len(K.unpack(bytes(r.blob))[3])
        return real_weighed(met, *rest)

    monkeypatch.setattr(K, "_counted", counted)
    monkeypatch.setattr(K, "_weighed", weighed)
    got, path = K.train_and_score(data.frame(spark, rows, "doc_id long, text string, h boolean"), F.col("h"))
    want, (alpha, _, bi, _, _, _) = plain(rows)
    check(got.collect(), want)
    assert sum(r.n for r in K.bigram_rows(spark, path).collect()) == sum(bi.values())
    assert K.bigram_rows(spark, path).count() == len(bi) and K.context_rows(spark, path).count() == len(alpha)
    tokens = sum(r[2] for r in want)
    assert max(places.values()) < tokens / 12


def test_every_context_sums_to_one():
    _, (alpha, _, _, uni, p, _) = plain(rows_of(data.documents(60)))
    for h in list(alpha)[:40] + [b"never seen"]:
        assert sum(p(h, w) for w in uni) + p(h, b"no such word") == pytest.approx(1, abs=1e-9)


def test_held_out_text_is_likelier_than_under_the_base(spark):
    got, _ = K.train_and_score(data.frame(spark, rows_of(data.documents()), "doc_id long, text string, h boolean"), F.col("h"))
    held = [r for r in got.collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_small_cases(spark):
    for rows in ([], [(1, "a b", True)], [(1, None, False)], [(1, "a b", False), (2, "c", True), (None, "a", None)]):
        got, _ = K.train_and_score(spark.createDataFrame(rows, "doc_id long, text string, h boolean"), F.col("h"))
        check(got.collect(), [(d, bool(h), *x) for d, h, *x in plain([(d, t, bool(h)) for d, t, h in rows])[0]])


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(op6_katz(spark, sf_dir).collect(), plain(rows_of(rows))[0])
