"""URL filters: given host rules first, mined association rules for the rest.

Spark's FP-growth mines combinations of URL tokens that go with the label "bad";
rules below the asked support or confidence, and rules that contain a shorter
one, are pruned. A rule is filed in an inverted index under its rarest token; an
URL meets the rules filed under its tokens and matches those of which it has all.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.words import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "\x01bad"  # the label's item; no token has that character

# Rules as (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MIN_SUPPORT = 0.002    # of the labelled URLs
MIN_CONFIDENCE = 0.9


def host(url: Column) -> Column:
    """After the first :// up to / ? # or end, A-Z lower-cased; empty where there is no :// or no URL."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ? # or end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens of an URL: its host's labels, path's parts, query's pairs and fragment, each with its kind."""
    low = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    query = F.regexp_extract(low, r"(?s)\A[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(low, r"(?s)\A[^#]*#(.*)\z", 1)
    name = F.split(host(url), r"\.")
    words = F.split(F.translate(path(url), UPPER, LOWER), r"[/._-]+")
    tagged = lambda kind, items: F.transform(items, lambda x: F.concat(F.lit(kind), x))
    both = F.concat(
        tagged("h:", F.filter(F.concat(name, F.flatten(F.transform(name, lambda x: F.split(x, "-")))), lambda x: x != "")),
        tagged("p:", F.filter(words, lambda x: x != "")), tagged("q:", F.filter(F.split(query, "&"), lambda x: x != "")),
        F.when(fragment != "", F.array(F.concat(F.lit("f:"), fragment))).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(both)


def matching(urls: DataFrame, rules: DataFrame, strict: bool = False) -> DataFrame:
    """(key, rule) for each row of ``urls`` (key, tokens) and rule of ``rules`` (rule, tokens, filed) of which it has all tokens.

    ``strict`` asks for more tokens than the rule's. A rule is met by way of one token only, the one it is filed under.
    """
    met = urls.select("key", "tokens", F.explode("tokens").alias("_t")).join(
        rules.select("rule", F.col("tokens").alias("_need"), F.col("filed").alias("_t")), "_t")
    fits = F.forall("_need", lambda x: F.array_contains(F.col("tokens"), x))
    if strict:
        fits = fits & (F.size("tokens") > F.size("_need"))
    return met.where(fits).select("key", "rule")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (rule, tokens, filed, confidence, support) from all rows of ``labelled`` (url, bad).

    Null URLs have no tokens; null labels aren't bad. Without a bad row there are no
    rules.
    """
    rows = labelled.select(tokens(F.col("url")).alias("tokens"), F.coalesce(F.col("bad"), F.lit(False)).alias("bad"))
    baskets = stored(rows.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items")), "url-baskets")
    empty = baskets.sparkSession.createDataFrame([], "rule string, tokens array<string>, filed string, confidence double, support double")
    if baskets.limit(1).count() == 0:
        return empty
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    counts = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("freq"))
    rules = (
        model.associationRules.where(F.col("consequent")[0] == BAD)
        .select(F.array_join(F.array_sort("antecedent"), "\x02").alias("rule"), F.col("antecedent").alias("tokens"), "confidence", "support"))
    rarest = (
        rules.select("rule", F.explode("tokens").alias("token")).join(counts, "token")
        .groupBy("rule").agg(F.min(F.struct("freq", "token"))["token"].alias("filed")))
    rules = stored(rules.join(rarest, "rule").select("rule", "tokens", "filed", "confidence", "support"), "url-rules")
    longer = matching(rules.select(F.col("rule").alias("key"), "tokens"), rules, strict=True).select(F.col("key").alias("rule")).distinct()
    return rules.join(longer, "rule", "left_anti")


def ruled(host_col: Column, path_col: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host_col == h) | host_col.endswith(f".{h}")) & path_col.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block) of every page.

    ``labelled`` (url, bad) is what the association rules are mined from; they decide
    where no given rule fits: block if one matches, else allow. Distinct URLs are
    matched once, so a frequent one costs no more than a rare one. A null URL has an empty host
    and path. Repeated rows are judged alike; null ids stay null.
    """
    mined = mine(labelled, min_support, min_confidence)
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("_url"))
    rows = rows.withColumns({"host": host(F.col("_url")), "path": path(F.col("_url"))})
    name, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "_v": verdict})
    open_urls = rows.where("_v is null and _url is not null").select(F.col("_url").alias("key")).distinct().withColumn("tokens", tokens(F.col("key")))
    hits = matching(open_urls, mined).select(F.col("key").alias("_bad")).distinct()
    out = rows.join(hits, rows["_url"] == hits["_bad"], "left")
    decided = F.coalesce("_v", F.when(F.col("_bad").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", decided.alias("verdict"))
