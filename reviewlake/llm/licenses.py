"""License scans by sentence rules (native columns only).

A text is cut into sentences, each sentence is normalised and looked up among the known
licence sentences; the text becomes a string with one sign per sentence (a letter per
known sentence, a dot for any other).  A licence rule is an ordered sequence of known
sentences with at most ``GAP`` other sentences between neighbours; it is matched
against the sign string.  A rule whose match is part of a longer rule's is dropped, so a
header is not also reported by its first sentence alone.

A notice may be wrapped, indented and commented.  Where the parts between line ends make up
a known sentence together, they count as that sentence; to the rules, other parts between two
sentence ends or blank lines are one sentence, and a list number is none.

Everything happens inside the row: no join, no shuffle, no Python.  Patterns that begin with a
run of characters start only where the run does, so time grows in proportion to the text.

Edge cases, all defined: null and empty texts have no sentence and no licence; texts are
scanned whole; repeated rows are scanned once each; a sentence ends at . ! ? ; or : and
white space of any kind, or at a line end unless the next line goes on in lower case; extra columns
are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = 2

# Sentences of public licence notices, by sign.
SENTENCES = {
    "a": "Licensed under the Apache License, Version 2.0.",
    "b": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "c": "you may not use this file except in compliance with the License.",
    "d": "You may obtain a copy of the License at",
    "e": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
         '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "f": "Released under the MIT License.",
    "g": "Licensed under the MIT License.",
    "h": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
         "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
         "whom the Software is furnished to do so, subject to the following conditions:",
    "i": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "j": "This work is licensed under the GNU General Public License, version 3.",
    "k": "This program is free software:",
    "l": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
         "Foundation, either version 3 of the License, or (at your option) any later version.",
    "m": "Licensed under CC BY-NC 4.0.",
    "n": "Licensed under CC BY 4.0.",
    "o": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "p": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
         "conditions are met:",
    "q": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
         "from this software without specific prior written permission.",
    "r": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "s": "All rights reserved.",
}
# Licence and rule, longest rules first within a licence.
RULES = [
    ("Apache-2.0", "bcde"), ("Apache-2.0", "bcd"), ("Apache-2.0", "bc"), ("Apache-2.0", "a"),
    ("MIT", "hi"), ("MIT", "h"), ("MIT", "f"), ("MIT", "g"),
    ("GPL-3.0-or-later", "kl"), ("GPL-3.0", "j"),
    ("CC-BY-NC-4.0", "m"), ("CC-BY-4.0", "n"), ("CC-BY-4.0", "o"),
    ("BSD-3-Clause", "pq"), ("BSD-2-Clause", "p"),
    ("MPL-2.0", "r"), ("Proprietary", "s"),
]


def normal(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip(" ")


KNOWN = {normal(s): sign for sign, s in SENTENCES.items()}


def pattern(rule: str) -> str:
    return (r"\.{0,%d}" % GAP).join(rule)


def spread(sentence: str) -> str:
    """Matches a normalised sentence, whole or cut at line ends."""
    return sentence.replace(" ", "[ \u0001]")


def wrapped(sentence: str) -> str:
    return "(?<=[\u0001\u0002])(?:%s)(?=[\u0001\u0002])" % sentence


def joined(text):
    """``text`` with every known sentence in one part; the longest first, as one may begin another."""
    for s in sorted(KNOWN, key=len, reverse=True):
        text = F.regexp_replace(text, wrapped(spread(s)), s)
    return text


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_sentences, n_known, signs, licences): signs has a letter per known sentence in
    order, with the gaps between them; licences are joined by commas in rule order."""
    # a comment mark that looks like a sentence end; then sentence ends and blank lines (2), other line ends (1)
    marked = F.regexp_replace(F.col("t"), r"(\n[ \t]*)[;!]+(?=[ \t])", "$1#")
    marked = F.regexp_replace(marked, r"([.!?;:])[ \t\r\n]+", "$1\u0002")
    marked = F.regexp_replace(marked, r"(?<![ \t\r])[ \t\r]*+\n[\s\p{Punct}]*\n", "\u0002")
    marked = F.regexp_replace(marked, r"(?<![ \t\r])[ \t\r]*+\n+([^a-z]|\z)", "\u0001$1")
    clean = F.concat(F.lit("\u0002"), F.regexp_replace(F.lower(marked), "[^a-z0-9\u0001\u0002]+", " "), F.lit("\u0002"))
    clean = F.regexp_replace(F.regexp_replace(clean, "[ \u0001]*\u0001[ \u0001]*", "\u0001"), "[ \u0001]?\u0002[ \u0001\u0002]*", "\u0002")
    known = F.create_map(*[F.lit(v) for kv in KNOWN.items() for v in kv])
    number = lambda s: F.when(s.rlike(r"^([0-9]{1,2}|[a-z]|[ivx]+)\z"), F.lit(",")).otherwise(F.lit("."))
    sign = lambda s: F.coalesce(F.element_at(known, s), number(s))
    signs = lambda s: F.array_join(F.transform(F.filter(F.split(s, "\u0001"), lambda x: x != ""), sign), "")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    rows = rows.select("id", clean.alias("t"))
    rows = rows.select("id", F.when(F.col("t").rlike(wrapped("|".join(map(spread, KNOWN)))), joined(F.col("t"))).otherwise(F.col("t")).alias("t"))
    rows = rows.select("id", F.transform(F.split("t", "\u0002"), signs).alias("p"))
    rows = rows.select(
        "id", F.replace(F.array_join("p", ""), F.lit(","), F.lit(".")).alias("s"),
        F.array_join(F.transform("p", lambda x: F.regexp_replace(F.replace(x, F.lit(","), F.lit("")), r"\.+", ".")), "").alias("rest"),
    )
    # what a rule matches is taken out before the shorter rules look
    for i, (_, rule) in enumerate(RULES):
        rows = rows.withColumn(f"r{i}", F.col("rest").rlike(pattern(rule)))
        rows = rows.withColumn("rest", F.regexp_replace("rest", pattern(rule), "."))
    licences = F.array_distinct(F.array(*[F.when(F.col(f"r{i}"), F.lit(n)) for i, (n, _) in enumerate(RULES)]))
    return rows.select(
        F.col("id").alias(id_col), F.length("s").cast("long").alias("n_sentences"),
        F.length(F.replace(F.col("s"), F.lit("."), F.lit(""))).cast("long").alias("n_known"),
        F.regexp_replace(F.regexp_replace("s", r"^\.+|(?<!\.)\.++\z", ""), r"\.{3,}", "...").alias("signs"),
        F.array_join(F.filter(licences, lambda x: x.isNotNull()), ",").alias("licences"),
    )
