"""Small tables with the hard cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

import duckdb

SF = "/root/testdata/sf0.001"


def documents(n: int = 200) -> list[tuple]:
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id limit {n}").fetchall()


def hard_texts() -> list[tuple]:
    r = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    passages = [r.choices(words, k=r.randint(40, 120)) for _ in range(8)]
    out = []
    for i in range(80):
        t = []
        for _ in range(r.randint(1, 4)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 2)
            t += r.choices(words, k=r.randint(0, 30)) + p[a:a + r.randint(10, len(p))]
        out.append((5000 + i, " ".join(t)))
    return [
        *out, (6000, "a " * 200), (6001, "a b\n" * 100), (6002, None), (6003, ""), (6005, " \n\t "), (None, "x y z " * 40),
        (6004, out[0][1]), (6004, out[0][1]), (6006, "é😀▁ ñ " * 300), (6007, "x" * 30_000), (6008, "the cat\x00\x0b\x1f sat " * 2000)]


def frame(spark, rows, columns="doc_id long, text string", parts=4):
    return spark.createDataFrame(rows, columns).repartition(parts)


def clashing(df, names):
    """The frame with further columns of these names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in names})
