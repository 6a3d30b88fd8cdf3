import re
from collections import Counter

import numpy as np

from gridloom.llm import repetition as R
from tests.llm import data


def window_cover(words, size):
    """Words in windows of ``size`` that are found twice or more, as flags."""
    seen = Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    flags = [False] * len(words)
    for i in range(len(words) - size + 1):
        if seen[tuple(words[i:i + size])] > 1:
            flags[i:i + size] = [True] * size
    return flags


def longest(words, least):
    size = 0
    for n in range(least, len(words)):
        if len({tuple(words[i:i + n]) for i in range(len(words) - n + 1)}) == len(words) - n + 1:
            break
        size = n
    return size


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n, repeat = len(words), sum(window_cover(words, 8))
    own, far = sum(window_cover(words, R.REPEAT_WORDS)), longest(words, R.REPEAT_WORDS)
    failed = n < 20 or 100 * repeat > 30 * n
    kept = not failed and own <= R.MAX_COVERED * n and far <= R.MAX_LONGEST * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeat, own, far, failed, kept


def test_against_windows(spark):
    rows = data.documents(120) + [r for r in data.hard_texts() if r[0] not in (6007, 6008)] + [(7000, "#*$%&|<> a\n\n \na\n" * 9)]
    got = R.measure(data.frame(spark, rows), keep=["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[2:9] + (r.base_failed, r.kept) == expected(r.text), r.doc_id
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        flags = window_cover(words, R.REPEAT_WORDS)
        spans = [False] * len(words)
        for s in r.repeat_spans:
            spans[s.first_word:s.first_word + s.n] = [True] * s.n
        assert spans == flags


def test_suffix_array_and_lcp():
    rng = np.random.default_rng(1)
    for n, letters in ((1, 1), (2, 1), (50, 1), (200, 2), (300, 5)):
        x = rng.integers(0, letters, n)
        sa, levels = R.suffix_array(x)
        plain = sorted(range(n), key=lambda i: x[i:].tolist())
        assert sa.tolist() == plain
        a, b, lcp = R.neighbour_lcp(sa, levels, 1)
        want = []
        for i, j in zip(plain, plain[1:], strict=False):
            k = 0
            while max(i, j) + k < n and x[i + k] == x[j + k]:
                k += 1
            if k:
                want.append((i, j, k))
        assert list(zip(a.tolist(), b.tolist(), lcp.tolist(), strict=True)) == want


def test_long_empty_and_clashing(spark):
    rows = [(1, "x" * 200_000), (2, " ".join(str(i) for i in range(30_000))), (3, None)]
    df = data.clashing(data.frame(spark, rows), ["kept", "n_words", "k0"])
    got = {r.doc_id: r for r in R.measure(df, keep=["doc_id", "kept", "k0"]).collect()}
    assert (got[1].n_words, got[2].n_words, got[3].n_words) == (1, 30_000, 0)
    assert got[2].kept and not got[1].kept and got[3].base_failed and got[2].k0 == "clash"
    assert R.measure(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_each_limit_rejects_what_the_others_let_through(spark):
    """The limits as literals: 30 % covered by repeats of five words or more, 15 % in the longest repeat."""
    assert (R.MAX_COVERED, R.MAX_LONGEST, R.REPEAT_WORDS) == (0.30, 0.15, 5)
    fresh = iter(f"w{i}" for i in range(100_000))
    some = lambda n: [next(fresh) for _ in range(n)]
    short = []  # forty phrases of six words, each standing twice between other words: no window of eight repeats
    phrases = [some(6) for _ in range(40)]
    for p in phrases * 2:
        short += p + some(6)
    run = some(420) + ["spam"] * 100 + some(80)  # 16.5 % in one repeat that overlaps itself, 16.7 % covered
    under = some(430) + ["spam"] * 85 + some(85)
    rows = [(1, " ".join(short)), (2, " ".join(run)), (3, " ".join(under)), (4, " ".join(some(300)))]
    got = {r.doc_id: r for r in R.measure(data.frame(spark, rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {d: r.kept for d, r in got.items()} == {1: False, 2: False, 3: True, 4: True}
    assert got[1].n_covered > 0.30 * got[1].n_words and got[1].longest_repeat <= 0.15 * got[1].n_words
    assert got[2].n_covered <= 0.30 * got[2].n_words and got[2].longest_repeat > 0.15 * got[2].n_words
