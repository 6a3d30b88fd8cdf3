import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.llm import merkle, queries
from tests.llm import data

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def steps(tree, at):
    """(siblings before, siblings after) from the leaf to the root."""
    for level in tree[:-1]:
        run = level[at // 2 * 2:at // 2 * 2 + 2]
        yield "".join(run[:at % 2]), "".join(run[at % 2 + 1:])
        at //= 2


def plain(rows):
    """The contract's rows by recursion; rows are tuples in the order of FIELDS."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = levels([x[2] for x in groups[g]])
    top = levels([trees[g][-1][0] for g in langs])
    for k, g in enumerate(langs):
        for at, (_, _, h, r) in enumerate(groups[g]):
            path = [*steps(trees[g], at), *steps(top, k)]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            now = leaf((*r[:3], r[3] + 1, r[4])) if changed else h
            for before, after in path:
                now = H(before, now, after)
            yield r[0], h, trees[g][-1][0], top[-1][0], H(*(a + b for a, b in path)), now, now == top[-1][0]


def rows():
    r = random.Random(3)
    langs = [None, "", "en", "en", "en", "de", "é", "zz", "\U0001f600", "～"]
    hard = [(d, "s", r.choice(langs), r.choice([None, len(t or "")]), t) for d, t in data.hard_texts()]
    many = [(i, None if i % 5 == 0 else "web", r.choice(langs), i, f"text {i}") for i in range(-40, 400)]
    return hard + many + [many[0]] * 3 + [(None, None, None, None, None)] * 2


@pytest.mark.parametrize("digits", [2, 10])
def test_against_recursion(spark, tmp_path, digits, monkeypatch):
    monkeypatch.setattr(merkle.prove, "__defaults__", (digits,))
    own = rows()
    df = data.clashing(spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in own], SCHEMA), ["leaf", "other", "g", "at", "last"]).repartition(5)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op13_merkle_rollup(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(own)))


def test_small_tables(spark, tmp_path):
    for k, own in enumerate([[], [(5, "s", None, 3, "abc")], [(5, "s", "a", 3, "abc"), (6, "s", "b", None, None)]]):
        spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in own], SCHEMA).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        got = [tuple(r) for r in queries.op13_merkle_rollup(spark, f"{tmp_path}/{k}").collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, plain(own)))


def test_other_columns_pass_through(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], H(str(i))) for i in range(9)], "id long, path string, h string")
    out = merkle.prove(df, "id", "path", "h", digits=2)
    assert out.columns == ["id", "h", "subroot", "root", "path"]
    folded = out.select(merkle.fold(F.col("h"), F.col("path")).alias("f"), "root").collect()
    assert len(folded) == 9 and all(r.f == r.root for r in folded)
