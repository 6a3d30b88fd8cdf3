import numpy as np
import pytest
import xxhash

from gridloom.llm import simhash_trie as S
from tests.llm import data


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def near_values(seed=1, n=150):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
    out = [base, np.array([0, 2**64 - 1], np.uint64)]
    for _ in range(6):
        flip = np.zeros(n, np.uint64)
        for _ in range(int(rng.integers(1, 6))):
            flip ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        out.append(base ^ flip)
    return np.unique(np.concatenate(out))


def test_trie_join_finds_all_pairs():
    v = near_values()
    x = v[:, None] ^ v[None, :]
    near = (np.bitwise_count(x) <= 4) & (np.bitwise_count(x >> np.uint64(32)) <= 2)
    i, j = np.nonzero(near)
    want = {(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if a < b}
    got = [(a, b) for p, q in S.joined(v, v, True, 4) for a, b in zip(p.tolist(), q.tolist(), strict=True)]
    assert len(got) == len(want) and set(got) == want
    left, right = v[::2], v[1::2]
    got = {(int(left[a]), int(right[b])) for p, q in S.joined(left, right, False, 4) for a, b in zip(p.tolist(), q.tolist(), strict=True)}
    assert got == {(int(v[a]), int(v[b])) for a, b in zip(i.tolist(), j.tolist(), strict=True) if a % 2 == 0 and b % 2 == 1}


@pytest.mark.parametrize("leaf", [40, 100_000])
def test_links_have_the_components_of_all_pairs(spark, leaf):
    v = near_values(2)
    place = {int(k): i for i, k in enumerate(v.view(np.int64))}
    got = S.links(spark.createDataFrame([(k,) for k in place], "fp long"), 4, leaf).collect()
    own = S.forest(len(v), [(np.array([place[r.u] for r in got]), np.array([place[r.v] for r in got]))])
    i, j = np.nonzero(np.bitwise_count(v[:, None] ^ v[None, :]) <= 4)
    assert (own == S.forest(len(v), [(i, j)])).all()


def test_documents(spark):
    base = "one two three four five six seven eight nine ten eleven twelve " * 20
    rows = data.documents(80) + data.hard_texts() + [(8000 + i, base + f"end{i % 7}") for i in range(60)] + [(None, base), (9, "Tie Tie")]
    fps = [plain_fingerprint(t) for _, t in rows]
    values = sorted(set(fps))
    v = np.array(values, np.uint64)
    i, j = np.nonzero(np.bitwise_count(v[:, None] ^ v[None, :]) <= 4)
    root = S.forest(len(v), [(i, j)])
    of = {f: int(root[k]) for k, f in enumerate(values)}
    least = {}
    for (d, _), f in zip(rows, fps, strict=True):
        if d is not None:
            least[of[f]] = min(d, least.get(of[f], d))
    want = sorted(((d, f, least.get(of[f])) for (d, _), f in zip(rows, fps, strict=True)), key=str)
    df = data.clashing(data.frame(spark, rows), ["fp", "label", "component_id"])
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in S.near_duplicates(df).collect()), key=str)
    assert got == want


def test_empty(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
