import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from gridloom.llm import url_rules as R
from gridloom.llm.queries import op10_url_rules
from tests.llm import data


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def given(host, path):
    fits = [r for r in R.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def urls():
    r = random.Random(2)
    hosts = ["a.example.net", "example.net", "notnet", "net", "x.example.com", "EXAMPLE.com", "k.org", "spam-site.info", "good.info"]
    paths = ["", "/", "/en/1", "/de/2", "/fr/3", "/win/big", "/en", "/a//b?x=/de/#y", "?q=1", "#f", "/EN/2"]
    out = [f"{r.choice(['http', 'https', 'HTTP'])}://{r.choice(hosts)}{r.choice(paths)}" for _ in range(600)]
    return out + [None, "", "no scheme/net/", "://net/", "http://a://net/", "x" * 20_000, "http://net\n/a", "http://net:80/"]


def brute_rules(labelled, tokens, support, confidence):
    """All antecedents of enough support and confidence that have no shorter one inside."""
    baskets = [(frozenset(tokens[u]), bad) for u, bad in labelled]
    need = support * len(baskets)
    names = sorted({t for b, bad in baskets if bad for t in b})
    names = [t for t in names if sum(t in b for b, bad in baskets if bad) >= need]
    found = []
    for size in range(1, 8):
        for c in combinations(names, size):
            own = [bad for b, bad in baskets if b.issuperset(c)]
            if sum(own) >= need and sum(own) >= confidence * len(own) and not any(set(f) < set(c) for f in found):
                found.append(c)
    return {frozenset(f) for f in found}


def test_judging_against_brute_force(spark):
    all_urls = urls()
    r = random.Random(4)
    labelled = [(u, bool(u and "spam" in u and "/win" in u) or r.random() < 0.1) for u in all_urls]
    label_df = spark.createDataFrame(labelled, "url string, bad boolean")
    tokens = {row.url: row.t for row in label_df.select("url", R.tokens(F.col("url")).alias("t")).distinct().collect()}
    pages = data.clashing(spark.createDataFrame([(i, u) for i, u in enumerate(all_urls)] + [(None, all_urls[0]), (3, all_urls[3])], "page_id long, url string"), ["rule", "_v", "tokens", "_bad"])
    support, confidence = 0.005, 0.8
    mined = {frozenset(x.tokens) for x in R.mine(label_df, support, confidence).collect()}
    want = brute_rules(labelled, tokens, support, confidence)
    assert want and mined == want
    got = R.judge(pages, label_df, min_support=support, min_confidence=confidence).collect()
    assert len(got) == len(all_urls) + 2
    for x in got:
        if x.page_id is None:
            continue
        url = all_urls[x.page_id]
        host, path = parts(url)
        rule, verdict = given(host, path)
        if verdict is None:
            verdict = "block" if url is not None and any(f <= set(tokens[url]) for f in want) else "allow"
        assert (x.host, x.path, x.rule, x.verdict) == (host, path, rule, verdict), url


def test_nothing_to_mine(spark):
    pages = spark.createDataFrame([(1, "http://a.info/x")], "page_id long, url string")
    for rows in ([], [("http://a.info/x", False), (None, None)]):
        got = R.judge(pages, spark.createDataFrame(rows, "url string, bad boolean")).collect()
        assert [tuple(r) for r in got] == [(1, "a.info", "/x", None, "allow")]
    assert R.judge(pages.limit(0), spark.createDataFrame([], "url string, bad boolean")).collect() == []


def test_query(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = op10_url_rules(spark, sf_dir).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        host, path = parts(pages[r.page_id])
        rule, verdict = given(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (r.verdict == verdict if verdict else r.verdict in ("allow", "block"))
