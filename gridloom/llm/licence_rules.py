"""Licence recognition by sentences and rules, in DataFrame functions only.

A text is cut into sentences, each normalised (A-Z lower-cased, everything but
letters and digits one space) and looked up among known licence sentences; the
identifiers found, in order, are matched against the licence rules, each a
sequence of identifiers. Rules are tried in their order, the longest first, and a
rule takes the identifiers that it matches, so a full licence text isn't
reported a second time by its title.

Everything happens inside the row: no shuffle, no join, no group.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, with their identifiers by place (1, 2, ...).
SENTENCES = [
    "Released under the MIT License.",
    "Licensed under the MIT License.",
    "MIT License",
    "The MIT License (MIT)",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Licensed under the Apache License, Version 2.0.",
    "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "you may not use this file except in compliance with the License.",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "See the License for the specific language governing permissions and limitations under the License.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the GNU General Public License, version 3.",
    "GNU GENERAL PUBLIC LICENSE",
    "Version 3, 29 June 2007",
    "Version 2, June 1991",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "See the GNU General Public License for more details.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "This is free and unencumbered software released into the public domain.",
    "Licensed under CC BY 4.0.",
    "Licensed under CC BY-SA 4.0.",
    "Licensed under CC BY-NC 4.0.",
    "Licensed under CC BY-ND 4.0.",
    "Licensed under CC BY-NC-SA 4.0.",
    "Licensed under CC BY-NC-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
]

# Rule, licence, sequence of sentence identifiers. In order of precedence.
RULES = [
    ("mit-text", "MIT", (5, 6)),
    ("apache-2.0-notice", "Apache-2.0", (10, 11, 12)),
    ("apache-2.0-notice-by-line", "Apache-2.0", (8, 9, 11, 12)),
    ("apache-2.0-short-notice", "Apache-2.0", (10,)),
    ("gpl-3.0-or-later-notice", "GPL-3.0-or-later", (18, 20, 21)),
    ("gpl-2.0-or-later-notice", "GPL-2.0-or-later", (19, 20, 21)),
    ("gpl-3.0-or-later-grant", "GPL-3.0-or-later", (18,)),
    ("gpl-2.0-or-later-grant", "GPL-2.0-or-later", (19,)),
    ("gpl-3.0-title", "GPL-3.0-only", (15, 16)),
    ("gpl-2.0-title", "GPL-2.0-only", (15, 17)),
    ("bsd-3-text", "BSD-3-Clause", (22, 23)),
    ("bsd-2-text", "BSD-2-Clause", (22,)),
    ("isc-text", "ISC", (24,)),
    ("mpl-2.0-notice", "MPL-2.0", (25,)),
    ("unlicense-text", "Unlicense", (26,)),
    ("mit-released", "MIT", (1,)),
    ("mit-licensed", "MIT", (2,)),
    ("mit-title", "MIT", (3,)),
    ("mit-long-title", "MIT", (4,)),
    ("apache-2.0-line", "Apache-2.0", (7,)),
    ("gpl-3.0-work", "GPL-3.0-only", (13,)),
    ("gpl-3.0-line", "GPL-3.0-only", (14,)),
    ("cc-by-line", "CC-BY-4.0", (27,)),
    ("cc-by-sa-line", "CC-BY-SA-4.0", (28,)),
    ("cc-by-nc-line", "CC-BY-NC-4.0", (29,)),
    ("cc-by-nd-line", "CC-BY-ND-4.0", (30,)),
    ("cc-by-nc-sa-line", "CC-BY-NC-SA-4.0", (31,)),
    ("cc-by-nc-nd-line", "CC-BY-NC-ND-4.0", (32,)),
    ("cc-by-deed", "CC-BY-4.0", (33,)),
    ("cc-by-sa-deed", "CC-BY-SA-4.0", (34,)),
    ("cc-by-nc-deed", "CC-BY-NC-4.0", (35,)),
]

# Each known sentence has one of these words, so a text without any has no known sentence.
ANCHORS = ["licen", "software", "redistribut", "permission", "version", "warrant", "copyright"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOISE = r"[^a-z0-9\x{80}-\x{10FFFF}\x01]+"  # \x01 marks the end of a sentence
ENDS = {  # where sentences end; the second joins wrapped lines
    "lines": r"[.!?]+[ \t\r\f]*\n|[.!?]+[ \t\r\f]+|[.!?]+\z|\n",
    "wrapped": r"[.!?]+[ \t\r\f\n]+|[.!?]+\z|\n[ \t\r\f]*\n",
}


def normalised(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip()


KNOWN = [normalised(s) for s in SENTENCES]
if loose := [s for s in KNOWN if not any(a in s for a in ANCHORS)]:
    raise ValueError(f"no anchor in {loose}")
if torn := [s for s in SENTENCES if re.search(r"[.!?]\s", s)]:
    raise ValueError(f"more than one sentence: {torn}")


def identifiers(low: Column, ends: str) -> Column:
    """Identifiers of the known sentences of a lower-cased text, in order, as text like <7><3>."""
    marked = F.regexp_replace(F.regexp_replace(low, "\x01", " "), ends, "\x01")
    sentences = F.split(F.regexp_replace(marked, NOISE, " "), "\x01")
    known = F.array(*[F.lit(s) for s in KNOWN])
    places = F.filter(F.transform(sentences, lambda s: F.array_position(known, F.trim(s))), lambda i: i > 0)
    return F.array_join(F.transform(places, lambda i: F.concat(F.lit("<"), i.cast("string"), F.lit(">"))), "")


def recognise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text and rule that it matches: doc_id, rule, licence, matches.

    Sentences are read line by line and with wrapped lines joined; ``matches`` is the
    larger count of the two. Texts that are null, empty or without a known sentence give no
    row. Repeated rows are judged each; null ids stay null; other columns aren't read.
    """
    low = F.translate(docs[text_col], UPPER, LOWER)
    rows = docs.select(docs[id_col].alias("doc_id"), low.alias("_low"))
    hint = F.lit(False)
    for anchor in ANCHORS:
        hint = hint | F.col("_low").contains(anchor)
    rows = rows.where(hint).select("doc_id", *[identifiers(F.col("_low"), e).alias(f"_{k}") for k, e in ENDS.items()])
    rows = rows.where(F.greatest(F.length("_lines"), F.length("_wrapped")) > 0)
    for n, (_, _, ids) in enumerate(RULES):
        # one select a rule: the ids that it matched are gone for those after it
        run = "".join(f"<{i}>" for i in ids)
        counted, left = [], []
        for k in ENDS:
            rest = F.replace(F.col(f"_{k}"), F.lit(run), F.lit(""))
            cut = F.replace(F.col(f"_{k}"), F.lit(run), F.lit("|"))
            counted.append((F.length(f"_{k}") - F.length(rest)) / F.lit(len(run)))
            left.append(cut.alias(f"_{k}"))
        rows = rows.select("doc_id", *[f"_n{i}" for i in range(n)], F.greatest(*counted).cast("bigint").alias(f"_n{n}"), *left)
    found = F.filter(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(lic).alias("licence"), F.col(f"_n{n}").alias("matches")) for n, (r, lic, _) in enumerate(RULES)]),
        lambda x: x["matches"] > 0)
    return rows.select("doc_id", F.explode(found).alias("_f")).select("doc_id", "_f.rule", "_f.licence", "_f.matches")


def sql(docs: str = "documents") -> str:
    """The same rows in DuckDB's SQL."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = "[" + ", ".join(q(s) for s in KNOWN) + "]"
    low = f"translate(text, {q(UPPER)}, {q(LOWER)})"
    ids = {
        k: f"list_aggregate(list_transform(list_filter(list_transform(string_split(regexp_replace(regexp_replace(replace(low, chr(1), ' '), {q(e)}, chr(1), 'g'), {q(NOISE)}, ' ', 'g'), chr(1)), lambda s: list_position({known}, trim(s))), lambda i: i > 0), lambda i: '<' || i || '>'), 'string_agg', '')"
        for k, e in ENDS.items()
    }
    parts = [f"t as (select doc_id, {low} as low from {docs})", f"s0 as (select doc_id, coalesce({ids['lines']}, '') as a, coalesce({ids['wrapped']}, '') as b from t)"]
    unions = []
    for n, (rule, lic, seq) in enumerate(RULES):
        run = q("".join(f"<{i}>" for i in seq))
        count = lambda c, run=run: f"(length({c}) - length(replace({c}, {run}, ''))) / length({run})"
        parts.append(f"s{n + 1} as (select doc_id, replace(a, {run}, '|') as a, replace(b, {run}, '|') as b, cast(greatest({count('a')}, {count('b')}) as bigint) as n from s{n})")
        unions.append(f"select doc_id, {q(rule)} as rule, {q(lic)} as licence, n as matches from s{n + 1} where n > 0")
    return "with " + ",\n".join(parts) + "\n" + "\nunion all\n".join(unions)
