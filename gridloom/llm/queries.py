"""The registered queries of this subpackage and their SQL.

``opN_<name>`` applies operator N with production parameters to its whole table
and derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import (
    collocations,
    katz,
    latent_leaks,
    licence_rules,
    merkle,
    piece_bpe,
    repetition,
    sharding,
    simhash_trie,
    sparse_suffixes,
    token_files,
    url_rules,
    warc_bundles,
)
from gridloom.llm.words import lean, scratch

TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 8


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return lean(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def op1_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard by jump hashing of doc_id, its slot there, and the shard once a ninth is added."""
    docs = _read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"))
    placed = sharding.assign(docs, "doc_id", SHARDS, "shard", "grown_shard")
    return sharding.with_slots(placed, "shard", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it leaks."""
    return latent_leaks.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into seekable bundles, then read back from them."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = scratch(spark, "warc")
    warc_bundles.write_bundles(warc_bundles.with_revisits(pages), folder)
    return warc_bundles.read_records(spark, folder, payloads=False).select(
        F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"))


def op4_suffix_array_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document by the suffix-array repetition rules."""
    return repetition.measure(_read(spark, sf_dir, "documents"), spans=False)


def op5_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence rules that each document matches."""
    return licence_rules.recognise(_read(spark, sf_dir, "documents"))


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a Katz model of those whose crc32(doc_id) mod 7 isn't 2."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return katz.train_and_score(_read(spark, sf_dir, "documents"), held_out)[0]


def op7_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash fingerprint and near-duplicate component."""
    found = simhash_trie.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by backtracking and decoded again, as counts and digests."""
    return piece_bpe.encode(_read(spark, sf_dir, "documents"), TOKENIZER, ids=False, digests=True)


def op9_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that repeats, at each of its places."""
    return sparse_suffixes.repeated_passages(_read(spark, sf_dir, "documents"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: given rules, then rules mined from all labelled pages (bad: toxic or of low quality)."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    labels = _read(spark, sf_dir, "labels")
    bad = labels.groupBy("doc_id").agg(F.max((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)).alias("bad"))
    labelled = pages.join(bad, pages["page_id"] == bad["doc_id"]).select("url", "bad")
    return url_rules.judge(pages, labelled)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best phrases of two and three words."""
    return collocations.collocations(_read(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to range-coded files, then read back from them."""
    folder = scratch(spark, "token-files")
    token_files.write_tokens(_read(spark, sf_dir, "documents"), folder, BYTE_TOKENIZER)
    return token_files.read_tokens(spark, folder, ids=False)


def op13_merkle_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and the root that the leaf leads to where a seventh are tampered with."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [docs[c] for c in docs.columns]
    changed = [docs[c] + 1 if c == "n_chars" else docs[c] for c in docs.columns]
    tampered = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0, F.lit(False))
    leaves = docs.select("doc_id", "lang", merkle.leaf(fields).alias("leaf"), F.when(tampered, merkle.leaf(changed)).alias("other"))
    proved = merkle.prove(leaves, "doc_id", "lang", "leaf")
    folded = merkle.fold(F.coalesce("other", "leaf"), F.col("path"))
    out = proved.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


OP3_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
     d as (select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, sha1(html) as payload_digest from p),
     g as (select *, payload_bytes >= 1000 and page_id < max(page_id) over (partition by payload_digest) as again,
                  max(page_id) over (partition by payload_digest) as top from d)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
       case when again then top end as refers_to from g
"""

OP11_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, row_number() over () as d,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
numbered as (select lang, row_number() over () as p, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
words as (select lang, p, unnest(w) as w1, unnest(range(len(w))) as i from numbered),
ahead as (select lang, w1, lead(w1) over s as w2, lead(w1, 2) over s as w3 from words window s as (partition by p order by i)),
one as (select lang, w1 as phrase, count(*) as n from ahead group by all),
two as (select lang, w1, w2, count(*) as n from ahead where w2 is not null group by all),
three as (select lang, w1, w2, w3, count(*) as n from ahead where w3 is not null group by all having count(*) >= 10),
cuts as (
    select lang, w1 || ' ' || w2 as phrase, 2 as words, w1, w2, null as w3, t.n as a, 1 as k, x.n as l, y.n as r
    from two t join one x using (lang) join one y using (lang) where t.n >= 10 and x.phrase = t.w1 and y.phrase = t.w2
    union all
    select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 3, t.w1, t.w2, t.w3, t.n, 1, x.n, y.n
    from three t join one x on x.lang = t.lang and x.phrase = t.w1 join two y on y.lang = t.lang and y.w1 = t.w2 and y.w2 = t.w3
    union all
    select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 3, t.w1, t.w2, t.w3, t.n, 2, x.n, y.n
    from three t join two x on x.lang = t.lang and x.w1 = t.w1 and x.w2 = t.w2 join one y on y.lang = t.lang and y.phrase = t.w3),
scored as (
    select *, (1000000::hugeint * a * a) // (l::hugeint * r) as score from cuts),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_parts as (
    select lang, w1, w2, max(n) as most from (select lang, w1, w2, n from three union all select lang, w2, w3, n from three) group by all),
kept as (
    select s.* from weakest s left join inner_parts i on i.lang = s.lang and s.words = 2 and i.w1 = s.w1 and i.w2 = s.w2
    where i.most is null or 100 * i.most < 50 * s.a),
totals as (select lang, sum(n)::bigint as n from one group by lang)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, t.n, score::bigint as score
from kept k join totals t using (lang)
qualify rank <= 2000
"""

OP13_SQL = """
with recursive
bits(b, k, c) as (
    select b, 0, b from range(256) t(b)
    union all select b, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where k < 8),
crc_table as (select b, c from bits where k = 8),
d as (
    select row_number() over () as r, doc_id, lang, cast(doc_id as varchar) as id_text,
           coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as head,
           coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-') as chars,
           coalesce(strlen(cast(n_chars + 1 as varchar)) || ':' || cast(n_chars + 1 as varchar), '-') as chars_more,
           coalesce(strlen(text) || ':' || text, '-') as body
    from documents),
crc(r, i, c) as (
    select r, 0, 4294967295 from d where id_text is not null
    union all
    select crc.r, crc.i + 1, xor(crc.c >> 8, t.c)
    from crc join d using (r) join crc_table t on t.b = xor(crc.c, ascii(substr(d.id_text, cast(crc.i + 1 as int), 1))) & 255
    where crc.i < length(d.id_text)),
hit as (select crc.r from crc join d using (r) where crc.i = length(d.id_text) and xor(crc.c, 4294967295) % 7 = 0),
leaves as (
    select r, doc_id, lang, sha256(head || chars || body) as leaf,
           case when r in (select r from hit) then sha256(head || chars_more || body) else sha256(head || chars || body) end as seen from d),
ranked as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as p, count(*) over (partition by lang) as n from leaves),
tree(k, lang, p, h, n) as (
    select 0, lang, p, leaf, n from ranked
    union all
    select k + 1, lang, p // 2, sha256(string_agg(h, '' order by p)), (n + 1) // 2 from tree where n > 1 group by k, lang, p // 2, (n + 1) // 2),
subroots as (
    select lang, h, row_number() over (order by encode(lang) nulls first) - 1 as p, count(*) over () as n from tree where n = 1),
upper_tree(k, p, h, n) as (
    select 0, p, h, n from subroots
    union all
    select k + 1, p // 2, sha256(string_agg(h, '' order by p)), (n + 1) // 2 from upper_tree where n > 1 group by k, p // 2, (n + 1) // 2),
walk(r, k, p, path, h) as (
    select r, 0, p, '', seen from ranked
    union all
    select w.r, w.k + 1, w.p // 2, w.path || coalesce(s.h, ''),
           sha256(case when w.p % 2 = 0 then w.h || coalesce(s.h, '') else s.h || w.h end)
    from walk w join ranked d using (r) join tree t on t.k = w.k and t.lang is not distinct from d.lang and t.p = w.p and t.n > 1
    left join tree s on s.k = w.k and s.lang is not distinct from d.lang and s.p = w.p + 1 - 2 * (w.p % 2)),
up(r, k, p, path, h) as (
    select w.r, 0, s.p, w.path, w.h from (select * from walk qualify row_number() over (partition by r order by k desc) = 1) w
    join ranked d using (r) join subroots s on s.lang is not distinct from d.lang
    union all
    select w.r, w.k + 1, w.p // 2, w.path || coalesce(s.h, ''),
           sha256(case when w.p % 2 = 0 then w.h || coalesce(s.h, '') else s.h || w.h end)
    from up w join upper_tree t on t.k = w.k and t.p = w.p and t.n > 1 left join upper_tree s on s.k = w.k and s.p = w.p + 1 - 2 * (w.p % 2))
select d.doc_id, d.leaf, s.h as subroot, t.h as root, sha256(u.path) as proof_sha256, u.h as folded_root, u.h = t.h as verified
from (select * from up qualify row_number() over (partition by r order by k desc) = 1) u
join ranked d using (r) join subroots s on s.lang is not distinct from d.lang join upper_tree t on t.n = 1
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_jump_sharding, op2_latent_leaks, op3_seekable_warc, op4_suffix_array_repetition, op5_licence_rules, op6_katz, op7_simhash_trie, op8_sentencepiece, op9_sparse_suffixes, op10_url_rules,
        op11_collocations, op12_token_files, op13_merkle_rollup)}


def oracle_sql() -> dict[str, str]:
    return {"op3_seekable_warc": OP3_SQL, "op5_licence_rules": licence_rules.sql(), "op11_collocations": OP11_SQL, "op13_merkle_rollup": OP13_SQL}
