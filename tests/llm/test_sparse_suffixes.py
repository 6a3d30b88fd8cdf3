from collections import defaultdict

import numpy as np
import pytest

from gridloom.llm import sparse_suffixes as S
from tests.llm import data


def places(rows, least):
    """Windows that every document loses and keeps, by brute force."""
    at = defaultdict(list)
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        words = (t or "").encode().split()
        for i in range(len(words) - least + 1):
            at[tuple(words[i:i + least])].append((d, i))
    lose, keep = defaultdict(set), defaultdict(set)
    for v in at.values():
        if len(v) > 1:
            keep[v[0][0]].add(v[0][1])
            for d, i in v[1:]:
                lose[d].add(i)
    return lose, keep


def spans(starts, least):
    out = []
    for i in sorted(starts):
        if out and i <= sum(out[-1]):
            out[-1] = (out[-1][0], i + least - out[-1][0])
        else:
            out.append((i, least))
    return out


@pytest.mark.parametrize(("least", "k"), [(50, 10), (12, 3)])
def test_against_all_windows(spark, least, k):
    rows = data.documents() + data.hard_texts()
    lose, keep = places(rows, least)
    want = {(d, *s, f) for m, f in ((lose, False), (keep, True)) for d, x in m.items() for s in spans(x, least)}
    got = [tuple(r) for r in S.repeated_passages(data.frame(spark, rows), least=least, k=k).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_runs_that_are_not_held(spark, monkeypatch):
    monkeypatch.setattr(S, "HOLD", 3)
    rows = data.hard_texts() + [(9000 + i, "one line that very many texts have " * 9 + f"and {i}") for i in range(60)]
    lose, keep = places(rows, 12)
    want = {(d, *s, f) for m, f in ((lose, False), (keep, True)) for d, x in m.items() for s in spans(x, 12)}
    assert {tuple(r) for r in S.repeated_passages(data.frame(spark, rows), least=12, k=3).collect()} == want


def test_cutting(spark):
    rows = data.hard_texts()
    lose, _ = places(rows, 50)
    df = data.clashing(data.frame(spark, rows), ["key", "_row", "lose", "_k"])
    out = S.without_repeats(df)
    assert out.columns == df.columns
    got = defaultdict(list)
    for r in out.collect():
        assert r.key == r._row == r.lose == r._k == "clash"
        got[r.doc_id].append(r.text)
    for d, t in rows:
        if t is None or d not in lose:
            assert t in got[d]
            continue
        words = t.encode().split()
        gone = {j for i in lose[d] for j in range(i, i + 50)}
        left = [w for i, w in enumerate(words) if i not in gone]
        assert left in [x.encode().split() for x in got[d]]
    assert sum(map(len, got.values())) == len(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.repeated_passages(df).collect() == [] and S.without_repeats(df).collect() == []


def test_batch_without_spans():
    """A batch whose documents only keep passages has none that they lose."""
    none = S.spans_of(np.array([0, 1]), np.array([3, 70]), np.zeros(2, np.int64), 2, 50)
    assert none.to_pylist() == [[], []]
    assert S.spans_of(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), 0, 50).to_pylist() == []
    some = S.spans_of(np.array([0, 1]), np.array([3, 70]), np.array([0, 5], np.int64), 2, 50)
    assert some.to_pylist() == [[], [{"first_word": 70, "n": 52}]]
