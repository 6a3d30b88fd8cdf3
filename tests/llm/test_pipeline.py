import corpus_pipeline as P
from gridloom.llm import latent_leaks
from tests.llm import data, test_latent_leaks, test_repetition, test_simhash_trie, test_sparse_suffixes

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(d, t, None, "s", len(t or "")) for d, t in rows], COLUMNS).repartition(3)


def test_stages(spark, tmp_path, sf_dir):
    docs, items, _ = test_latent_leaks.planted()
    docs = docs + data.hard_texts()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = table(spark, docs)
    kept = P.quality_rules(spark, df, str(tmp_path))
    own = [(d, t) for d, t in docs if len(t or "") < 20_000 or d is not None and d < 5000]
    want = sorted(str(d) for d, t in own if test_repetition.expected(t)[-1])
    assert sorted(str(r.doc_id) for r in kept.collect() if r.doc_id not in (6007, 6008)) == want and kept.columns == df.columns

    single = P.near_duplicates(spark, kept, str(tmp_path))
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    near = {}
    for d, c in ((r.doc_id, r.component_id) for r in __import__("gridloom.llm.simhash_trie", fromlist=["x"]).near_duplicates(kept).collect()):
        near[str(c)] = near.get(str(c), 0) + 1
    assert single.count() == len(near) and sum(near.values()) == len(rows) and single.columns == df.columns
    assert test_simhash_trie.plain_fingerprint("") == 0

    rows = [(r.doc_id, r.text) for r in single.collect()]
    cut = {r.doc_id: r.text for r in P.repeated_passages(spark, table(spark, rows), str(tmp_path)).collect()}
    lose, _ = test_sparse_suffixes.places(rows, 50)
    for d, t in rows:
        gone = {j for i in lose.get(d, ()) for j in range(i, i + 50)}
        left = [w for i, w in enumerate(t.encode().split()) if i not in gone]
        assert cut[d].encode().split() == left if left else d not in cut

    rows = sorted(cut.items(), key=str)
    clean = {r.doc_id for r in P.decontaminate(spark, table(spark, rows), str(tmp_path)).collect()}
    bad = {d for d, _ in test_latent_leaks.brute(rows, items)}
    assert {d for d, _ in rows} - clean <= bad and len(bad - clean) >= 0.9 * len(bad)
    assert latent_leaks.LEAST == 8

    coded = P.tokens(spark, table(spark, rows), str(tmp_path)).collect()
    assert {r.doc_id: r.decoded for r in coded} == {d: t.replace("▁", " ") for d, t in rows}


def test_whole_run_and_empty_documents(spark, sf_dir, tmp_path):
    out = P.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in docs.select("doc_id").collect()} and len(ids) > 0.6 * docs.count()
    for name, rows in (("documents", docs.limit(0)), ("benchmark", spark.read.parquet(f"{sf_dir}/benchmark.parquet"))):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_repeated_rows_leave_one(spark, tmp_path):
    text = "some plain words that stand here in a row and never come again in quite this order at all so nothing repeats"
    got = P.near_duplicates(spark, table(spark, [(1, text), (1, text), (2, text), (None, text + " x")] * 2 + [(1, "quite another text with none of it")]), str(tmp_path)).collect()
    assert len(got) == 2
