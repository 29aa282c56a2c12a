"""License scans by diagonal voting, in DataFrame functions only.

Every rolling word pair of every document is hashed and joined to the pairs of the license templates (a fixed, small
table). A match at document word p and template word t votes for diagonal p - t: an undisturbed copy of a template puts
all its votes on one diagonal, and an inserted or missing word moves the rest to a neighbouring one. Votes are
aggregated per document, template and diagonal; diagonals at most `slack` apart are merged into one run, but no run drifts
by more than a quarter of its template. A run is verified: the words themselves were compared (not only the hashes), it
holds `share` of the template's voting pairs, among them all pairs that tell the license from its relatives (NEED), and
its span is no longer than the template and the drift allow.

Nothing is gathered per phrase: the only shuffles are on (document, template) with a handful of rows for each document
that holds license words, so a phrase in a third of all documents spreads like the documents.

Defined results: null or empty text has no words and no labels; ids may be null; repeated rows each get the result of
their text; the words are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z as a-z; of several
copies with one label the label is given once; `score` is the largest share of a verified run (1.0 for base phrases), 0.0
without one; a very long text is scanned whole; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import row_keys

SLACK, SHARE = 2, 0.6

# The base phrases, whose every place is counted.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices of public licenses, with the word pairs that tell each from its relatives.
_GPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu {0}general public license as published by the free software foundation either version {1} of the license or at your option any later version"
_CC = "this work is licensed under a creative commons attribution {0}4 0 international license"
TEMPLATES: list[tuple[str, str, tuple[str, ...]]] = [
    ("apache-2.0", "licensed under the apache license version 2 0", ("the apache", "2 0")),
    ("apache-2.0", "apache license version 2 0 january 2004", ("apache license", "2 0")),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ("the apache", "2 0")),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ("hereby granted", "granted free")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("without fee",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("binary forms",)),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("promote products",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general", "version 2")),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general", "version 3")),
    ("gpl-2.0", _GPL.format("", 2), ("gnu general", "version 2")),
    ("gpl-3.0", _GPL.format("", 3), ("gnu general", "version 3")),
    ("lgpl", "gnu lesser general public license", ("gnu lesser", "lesser general")),
    ("agpl", "gnu affero general public license", ("gnu affero", "affero general")),
    ("mpl-2.0", "mozilla public license version 2 0", ("mozilla public", "2 0")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ("mozilla public", "2 0")),
    ("epl-2.0", "eclipse public license version 2 0", ("eclipse public", "2 0")),
    *((label, f"licensed under cc {kind} {version} 0", (*need, f"{kind.split()[-1]} {version}")) for version in (3, 4) for label, kind, need in (
        ("cc-by", "by", ("cc by",)), ("cc-by-nc", "by nc", ("by nc",)), ("cc-by-sa", "by sa", ("by sa",)), ("cc-by-nd", "by nd", ("by nd",)),
        ("cc-by-nc-sa", "by nc sa", ("by nc", "nc sa")), ("cc-by-nc-nd", "by nc nd", ("by nc", "nc nd")),
    )),
    ("cc-by", _CC.format(""), ("attribution 4",)),
    ("cc-by-nc", _CC.format("noncommercial "), ("attribution noncommercial", "noncommercial 4")),
    ("cc-by-sa", _CC.format("sharealike "), ("attribution sharealike", "sharealike 4")),
    ("cc-by-nc-sa", _CC.format("noncommercial sharealike "), ("attribution noncommercial", "noncommercial sharealike", "sharealike 4")),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1", "public domain")),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ("express or", "held liable")),
]
COMMON = {"a", "any", "are", "as", "at", "by", "for", "in", "is", "it", "may", "of", "or", "the", "this", "to", "under", "and", "with", "you"}


def templates() -> list[tuple[int, str, bool, list[str], dict[int, str], list[int], int]]:
    """(number, label, base, words, voting pairs by position, positions that must be held, drift) of each template.

    Pairs of two common words don't vote outside base phrases, unless they tell the license.
    """
    out = []
    every = [(label, phrase, None) for phrase, label in BASE.items()] + TEMPLATES
    for number, (label, phrase, need) in enumerate(every):
        words = phrase.split()
        pairs = {t: f"{a} {b}" for t, (a, b) in enumerate(zip(words, words[1:], strict=False))}
        if need is not None:
            pairs = {t: x for t, x in pairs.items() if x in need or not set(x.split()) <= COMMON}
        must = [t for t, x in pairs.items() if need is None or x in need]
        out.append((number, label, need is None, words, pairs, must, 0 if need is None else max(2, len(words) // 4)))
    return out


def template_pairs(spark: SparkSession) -> DataFrame:
    """(template, t, pair): one row for each voting word pair of each template."""
    values = ", ".join(f"({n}, {t}, '{pair}')" for n, _, _, _, pairs, _, _ in templates() for t, pair in pairs.items())
    return spark.sql(f"SELECT * FROM VALUES {values} AS x(template, t, pair)")


def template_table(spark: SparkSession) -> DataFrame:
    """(template, label, base, length, size, must, drift): words and voting pairs of each template."""
    values = ", ".join(f"({n}, '{label}', {str(base).lower()}, {len(words)}, {len(pairs)}, array({', '.join(map(str, must))}), {drift})" for n, label, base, words, pairs, must, drift in templates())
    return spark.sql(f"SELECT * FROM VALUES {values} AS x(template, label, base, length, size, must, drift)")


def words_of(text: Column) -> Column:
    # U+212A is the one non-ASCII character whose lower case is ASCII; it stays a non-ASCII word character
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    return F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slack: int = SLACK, share: float = SHARE) -> DataFrame:
    """(did, th, label, base, start, end, share): verified template copies; base ones are exact places."""
    spark = docs.sparkSession
    words = row_keys(docs, id_col, text_col).select("did", "th", words_of(F.col("text")).alias("words"))
    pairs = words.select("did", "th", F.posexplode(F.transform("words", lambda w, i: F.concat_ws(" ", w, F.get("words", i + 1)))).alias("p", "pair"))
    votes = pairs.withColumn("h", F.xxhash64("pair")).join(F.broadcast(template_pairs(spark).withColumn("h", F.xxhash64("pair"))), ["h", "pair"])
    # a template's position votes once on a diagonal, so a set is no longer than the template
    diagonals = votes.groupBy("did", "th", "template", (F.col("p") - F.col("t")).alias("d")).agg(F.collect_set("t").alias("seen")).join(F.broadcast(template_table(spark)), "template")
    place = Window.partitionBy("did", "th", "template").orderBy("d")
    # base phrases count place by place; other templates merge neighbouring diagonals, as far as their drift
    fresh = F.coalesce((F.col("d") - F.lag("d").over(place) > slack) | F.col("base"), F.lit(True))
    runs = diagonals.withColumn("run", F.sum(fresh.cast("int")).over(place))
    first = F.min("d").over(Window.partitionBy("did", "th", "template", "run"))
    runs = runs.withColumn("part", F.floor((F.col("d") - first) / (F.col("drift") + 1)))
    merged = runs.groupBy("did", "th", "template", "label", "base", "length", "size", "must", "drift", "run", "part").agg(
        F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"), F.min(F.col("d") + F.array_min("seen")).alias("start"), F.max(F.col("d") + F.array_max("seen") + 2).alias("end")
    )
    whole = (F.size(F.array_except("must", "seen")) == 0) & (F.size("seen") >= share * F.col("size")) & (F.col("end") - F.col("start") <= F.col("length") + F.col("drift"))
    return merged.filter(whole).select("did", "th", "label", "base", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), (F.size("seen") / F.col("size")).alias("share"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """(did, th, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of docs."""
    found = spans(docs, id_col, text_col, share=share)
    joined = lambda on: F.array_join(F.array_sort(F.collect_set(F.when(on, F.col("label")))), ",")
    base = F.col("base")
    per_doc = found.groupBy("did", "th").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.lit(True)).alias("labels"),
        F.max("share").alias("score"),
    )
    rows = row_keys(docs, id_col, text_col).select("did", "th", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    return rows.join(per_doc, ["did", "th"], "left").select(
        "did", "th", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
