"""Documents to tokens: quality, near-duplicates, repeated passages, leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns
of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import latent_leaks, piece_bpe, repetition, simhash_trie, sparse_suffixes
from gridloom.llm.queries import TOKENIZER
from gridloom.llm.words import lean, packed, stored, unpacked


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the suffix-array repetition rules reject."""
    lean(spark)
    judged = repetition.measure(packed(docs, text=docs["text"]), id_col="_row", keep=["_row"], spans=False)
    return judged.where("kept").select(*unpacked(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id (null first; ties: by row hash)."""
    lean(spark)
    key = F.struct(docs["doc_id"].alias("id"), F.xxhash64(*[docs[c] for c in docs.columns]).alias("row"))
    keyed = docs.select(key.alias("_id"), docs["text"].alias("_text"))
    found = stored(simhash_trie.near_duplicates(keyed, "_id", "_text"), "pipeline-components")
    # what goes is the smaller table: where it is small, Spark needs no shuffle of texts
    gone = stored(found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id.row").alias("row")).distinct(), "pipeline-gone")
    kept = packed(docs, row=key["row"]).join(gone, "row", "left_anti")
    if found.groupBy("doc_id").count().where("count > 1").limit(1).count():  # the same row several times: one of them
        kept = kept.dropDuplicates(["row"])
    return kept.select(*unpacked(docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every passage of 50 words or more that repeats, but at its first place; a text with no word left goes."""
    lean(spark)
    cut = sparse_suffixes.without_repeats(docs)
    left = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))  # in its place
    return left.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that leak a benchmark item."""
    lean(spark)
    return latent_leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the text they decode to, with counts and digests."""
    lean(spark)
    return piece_bpe.encode(docs, TOKENIZER, digests=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]

ORACLE_SQL = None  # SimHash components, latent retrieval and merges are beyond SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
