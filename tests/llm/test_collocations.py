import random
import re
from collections import Counter

import numpy as np
import pytest

from gridloom.llm import collocations as C
from tests.llm import data

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, most=3, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und" if lang is None else lang] += len(w)
            f.update((lang if lang is not None else "und", tuple(w[i:i + k])) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    taken = Counter()
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                taken[lang, w[i:i + k]] = max(taken[lang, w[i:i + k]], a)
    out = {}
    for (lang, w), a in found.items():
        if 100 * taken[lang, w] >= inside * a and taken[lang, w]:
            continue
        score, _, le, r = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), le, r))
    for lang, x in out.items():
        for rank, (s, a, w, le, r) in enumerate(sorted(x)[:top], 1):
            yield lang, rank, w.decode(), -a, le, r, n[lang], -s


def some(seed=2, n=150):
    r = random.Random(seed)
    words = ["the", "of", "New", "york", "CITY", "é", "😀", "a\x01b", "a", "it's", "x" * 80, "\x00", "z z"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "?!"]
    out = []
    for i in range(n):
        t = "".join(r.choice(words[:r.choice([3, 6, len(words)])]) + r.choice(marks) for _ in range(r.randint(0, 60)))
        out.append((i, t, r.choice(["en", "en", "en", "fr", None, "und", ""])))
    hot = [(1000 + i, "the the the the of the the " * 20, "en") for i in range(60)]
    return out + hot + [(None, None, "en"), (1, "", "xx"), (2, " . ", "xx"), *([(3, "same words again and again", "de")] * 12)]


@pytest.mark.parametrize(("most", "range_words"), [(3, 1 << 20), (3, 40), (2, 100), (4, 60)])
def test_against_counting(spark, most, range_words):
    rows = some() + [(d, t, "hard") for d, t in data.hard_texts()]
    df = data.clashing(data.frame(spark, rows, SCHEMA), ["phrase", "n", "words", "part"])
    out = C.collocations(df, most_words=most, range_words=range_words)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == sorted(plain(rows, most))
    if range_words < 1000:
        assert len(C.range_keys(C._rows(df, "lang", "text"), most, range_words)) > 20


def test_top_and_large_counts(spark):
    rows = some(5)
    got = sorted(map(tuple, C.collocations(data.frame(spark, rows, SCHEMA), top=3, least=4, inside=80).collect()))
    assert got == sorted(plain(rows, top=3, least=4, inside=80))
    big = spark.sql("select 700000000000001L as a, 700000000000003L as l").selectExpr("(cast(a as decimal(15,0)) * cast(a as decimal(15,0))) as x", "cast(l as decimal(15,0)) * cast(l as decimal(15,0)) as y")
    x = big.selectExpr("(cast(x as decimal(31,0)) * cast(1000000 as decimal(7,0))) div y as s").first().s
    assert x == 1000000 * 700000000000001 ** 2 // 700000000000003 ** 2


def test_quicksort():
    r = np.random.default_rng(1)
    for n, width, least in ((0, 3, 1), (1, 5, 1), (3000, 4, 1), (3000, 9, 25), (5000, 400, 3)):
        grid = r.integers(0, width, (n, 3)) * (r.random((n, 3)) < 0.9)
        grid[:, 1:] *= np.cumprod(grid > 0, axis=1)[:, :-1]
        w = r.integers(1, 4, n)
        want = Counter()
        for row, x in zip(grid.tolist(), w.tolist(), strict=True):
            for k in range(1, 4):
                if row[k - 1]:
                    want[tuple(row[:k])] += x
        flat = grid.ravel().astype(np.int32)
        got = [(tuple(flat[p:p + k].tolist()), x) for k, p, x in zip(*(a.tolist() for a in C.multikey_quicksort(flat, np.arange(n) * 3, w, 3, least)), strict=True)]
        assert len(got) == len(dict(got)) and dict(got) == {k: v for k, v in want.items() if v >= least}


def test_empty_and_long(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.collocations(spark.createDataFrame([(1, None, None)], SCHEMA)).collect() == []
    r = random.Random(4)
    text = " ".join(f"w{int(r.paretovariate(0.6))}" for _ in range(1_000_000))
    rows = [(1, text, "en"), (2, "w1 w2 " * 50_000, "en")]
    got = sorted(map(tuple, C.collocations(data.frame(spark, rows, SCHEMA, 2)).collect()))
    assert got == sorted(plain(rows))
