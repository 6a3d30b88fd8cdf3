import textwrap
from collections import Counter

import duckdb

from gridloom.llm import licence_rules as R
from gridloom.llm.queries import op5_licence_rules, oracle_sql
from tests.llm import data
from tests.oracle import compare, duck

MIT = R.SENTENCES[4] + "\n\n" + R.SENTENCES[5] + "\n\nTHE SOFTWARE IS PROVIDED."
TEXTS = [
    (1, "Text.\nReleased under the MIT License.\nMore"), (2, f"MIT License\n\nCopyright (c) 2020 Some One\n\n{MIT}"), (3, "released UNDER the   mit -- license"), (4, "not Released under the MIT License."),
    (5, "Licensed under the Apache License, Version 2.0. Licensed under the Apache License, Version 2.0!\nLicensed under CC BY-NC 4.0"), (6, None), (7, ""), (8, R.SENTENCES[21] + "\n" + R.SENTENCES[22]), (9, R.SENTENCES[21]),
    (10, R.SENTENCES[17] + " " + R.SENTENCES[19] + "  " + R.SENTENCES[20]), (11, "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991"), (12, "Version 2, June 1991\nGNU GENERAL PUBLIC LICENSE"),
    (None, "Licensed under CC BY 4.0."), (1, "Text.\nReleased under the MIT License.\nMore"), (13, "filler. " * 50_000 + "Licensed under CC BY-SA 4.0."), (14, "\x01Licensed under CC BY 4.0.\x01"),
    (15, "MIT License\n\n" + "\n\n".join("\n".join(textwrap.wrap(p, 60)) for p in MIT.split("\n\n"))),
    (16, R.SENTENCES[7] + "\n" + R.SENTENCES[8] + "\nYou may obtain a copy of the License at\n\n  http://x/y\n\n" + R.SENTENCES[10] + "\n" + R.SENTENCES[11])]
WANT = [
    (1, "mit-released"), (2, "mit-text"), (2, "mit-title"), (3, "mit-released"), (5, "apache-2.0-line"), (5, "cc-by-nc-line"), (8, "bsd-3-text"), (9, "bsd-2-text"), (10, "gpl-3.0-or-later-notice"), (11, "gpl-2.0-title"),
    (None, "cc-by-line"), (1, "mit-released"), (13, "cc-by-sa-line"), (14, "cc-by-line"), (15, "mit-text"), (15, "mit-title"),
    (16, "apache-2.0-notice"), (16, "apache-2.0-notice-by-line")]


def test_rules_and_sql(spark):
    df = data.clashing(data.frame(spark, TEXTS), ["rule", "_low", "_n0"])
    got = R.recognise(df).collect()
    assert Counter((r.doc_id, r.rule) for r in got) == Counter(WANT)
    assert {r.matches for r in got if r.doc_id == 5} == {1, 2}
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", TEXTS)
    assert Counter(con.sql(R.sql()).fetchall()) == Counter(map(tuple, got))


def test_native_plan(spark):
    plan = R.recognise(data.frame(spark, TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan.split("Exchange")[0] for x in ("Python", "Pandas", "Arrow", "Join"))


def test_empty(spark):
    assert R.recognise(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark, sf_dir):
    ok, why = compare(op5_licence_rules(spark, sf_dir), duck(sf_dir), oracle_sql()["op5_licence_rules"])
    assert ok, why
