"""License scans: MinHash bands over overlapping windows, then exact containment (operator 6).

Texts and templates are words without case and punctuation, cut into shingles of five words.  For each template size of t
shingles, texts are read in windows of t shingles that start every t // 4 places.  A window and a template are held against
each other if they agree in one of ``BANDS`` MinHash values.  A window at most an eighth out of step with a whole copy has a
Jaccard similarity of 0.77 or more, which all bands miss less than once in 100,000 times; at a containment of 0.8 all bands
miss about three times in 1,000.  Exact containment of the template's shingles in the window, widened by what it may be out
of step, then decides.

A window's MinHash value can only equal a template's if the window holds the template's least shingle.  So the shingles of all
texts are first joined with these telling ones, of which there are templates * BANDS, whatever the size of the data.  Texts
with a hit then meet their hits by a hash of the text, are cut into the windows around them, and the windows' bands are joined
with the templates' bands; the result is the same as if all windows were signed.  A window carries its own slice of the text
and no more, so a long text with many notices costs its length.  Tables of templates, not literals, take part in the joins.

A template of fewer than five words is one shingle, its whole sequence of words, which a text holds or doesn't; at_word is
where it stands first.  A template without a word is an error.

Cases: a null or empty text matches nothing, and one of fewer than five words only such short templates.  Matches of rows with the same doc_id count
as one document's; a null doc_id is a document.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.scratch import keep, likely

WORDS_A_SHINGLE = 5
BANDS = 8
CONTAINMENT = 0.8
#: Notices by which texts say what licence they are under.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-rights-reserved", "All rights reserved."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal "
        "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
        "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles_of(words: Column) -> Column:
    """The shingles of a list of words, as strings, in order."""
    places = F.sequence(F.lit(1), F.size(words) - (WORDS_A_SHINGLE - 1))
    return F.when(F.size(words) >= WORDS_A_SHINGLE, F.transform(places, lambda i: F.array_join(F.slice(words, i, WORDS_A_SHINGLE), " "))).otherwise(F.array().cast("array<string>"))


def hashes_of(words: Column) -> Column:
    """A hash of each shingle, in order, without building it."""
    places = F.sequence(F.lit(1), F.size(words) - (WORDS_A_SHINGLE - 1))
    return F.when(F.size(words) >= WORDS_A_SHINGLE, F.transform(places, lambda i: F.xxhash64(*[F.get(words, i - 1 + k) for k in range(WORDS_A_SHINGLE)])))


def _valued(band: int):
    """A hash's value in a band.  (A second parameter would be taken for the place in the list.)"""
    return lambda h: F.xxhash64(h, F.lit(band))


def _ranked(band: int):
    return lambda h: F.struct(_valued(band)(h).alias("value"), h.alias("hash"))


def signature(hashes: Column) -> Column:
    """MinHash values of a list of hashes, one for each band."""
    return F.array(*[F.array_min(F.transform(hashes, _valued(band))) for band in range(BANDS)])


def _template_rows(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(license, wanted, size, bands, least) of the templates that have a shingle of full length."""
    rows = spark.createDataFrame(templates, "license string, notice string")
    worded = rows.withColumn("words", words_of(F.col("notice")))
    hashed = worded.select("license", F.array_distinct(shingles_of(F.col("words"))).alias("wanted"), F.array_distinct(hashes_of(F.col("words"))).alias("hashes"))
    least = F.array(*[F.array_min(F.transform("hashes", _ranked(band)))["hash"] for band in range(BANDS)])
    return keep(hashed.filter(F.size("hashes") > 0).select("license", "wanted", F.size("hashes").alias("size"), signature(F.col("hashes")).alias("bands"), least.alias("least")), "templates")


def _matched(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, license, containment, begin): the windows that contain enough of a template."""
    text = F.col("text").cast("string")
    telling = templates.select("size", F.explode("least").alias("h")).distinct()
    # inline() makes words and hashes once a row; as plain columns they would be put into the lambdas that use them
    worded = F.transform(F.array(words_of(text)), lambda w: F.struct(w.alias("words"), hashes_of(w).alias("hashes")))
    placed = docs.select(F.xxhash64(text).alias("key"), F.inline(worded)).select("key", F.posexplode("hashes").alias("place", "h"))
    hits = keep(placed.join(telling, "h").groupBy("key").agg(F.collect_set(F.struct("size", "place")).alias("hits")), "hits")
    holding = likely(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key")), F.col("key"), hits.select("key"), "holds").filter("holds")
    read = holding.join(hits, "key").select("doc_id", "hits", F.inline(worded))

    def around(hit: Column) -> Column:
        """The windows of a hit's size that hold its place, by where they begin."""
        pace = F.greatest(F.lit(1), F.floor(hit["size"] / 4).cast("int"))
        first, last = F.ceil(F.greatest(F.lit(0), hit["place"] - hit["size"] + 1) / pace).cast("int"), F.floor(hit["place"] / pace).cast("int")
        nth = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.transform(nth, lambda n: F.struct(hit["size"].alias("size"), (n * pace).alias("start")))

    def cut(window: Column) -> Column:
        """A window with its hashes, and with the words that it is widened to by what it may be out of step."""
        slip = F.floor(F.greatest(F.lit(1), F.floor(window["size"] / 4)) / 2).cast("int")
        begin = F.greatest(F.lit(0), window["start"] - slip)
        words = F.slice("words", begin + 1, window["start"] + window["size"] + slip - begin + (WORDS_A_SHINGLE - 1))
        return F.struct(window["size"].alias("size"), begin.alias("begin"), F.slice("hashes", window["start"] + 1, window["size"]).alias("hashes"), words.alias("words"))

    windows = read.select("doc_id", "words", "hashes", F.array_distinct(F.flatten(F.transform("hits", around))).alias("windows"))
    sliced = windows.select("doc_id", F.inline(F.transform("windows", cut)))
    signed = sliced.select("doc_id", "size", "begin", "words", F.posexplode(signature(F.col("hashes"))).alias("band", "value"))
    known = templates.select("license", "wanted", "size", F.posexplode("bands").alias("band", "value"))
    met = signed.join(known, ["size", "band", "value"])
    share = F.size(F.array_intersect("wanted", shingles_of(F.col("words")))) / F.size("wanted")
    return met.select("doc_id", "license", share.cast("double").alias("containment"), F.col("begin").cast("long").alias("begin")).filter(F.col("containment") >= CONTAINMENT)


def _short_matched(docs: DataFrame, name: str, wanted: list[str]) -> DataFrame:
    """The same for a template of fewer words than a shingle has: the first place of its words in a row."""
    text = F.col("text").cast("string")
    possible = docs.filter(reduce(and_, [F.contains(F.lower(text), F.lit(w)) for w in wanted]))
    read = possible.select(F.col("doc_id").cast("long").alias("doc_id"), F.inline(F.array(F.struct(words_of(text).alias("words")))))
    words, places = F.array(*map(F.lit, wanted)), F.sequence(F.lit(1), F.size("words") - (len(wanted) - 1))
    held = F.filter(places, lambda i: F.slice("words", i, len(wanted)) == words)
    begin = F.when(F.size("words") >= len(wanted), F.get(held, F.lit(0)) - 1).cast("long")
    return read.select("doc_id", F.lit(name).alias("license"), F.lit(1.0).alias("containment"), begin.alias("begin")).filter("begin is not null")


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, license, containment, at_word): the best match of each licence in each of docs (doc_id, text).

    at_word: where the first window that contains that much begins.
    """
    templates = TEMPLATES if templates is None else templates
    found = []
    if templates:
        spark = docs.sparkSession
        notices = spark.createDataFrame(templates, "license string, notice string").select("license", "notice", words_of(F.col("notice")).alias("words")).collect()  # as many as there are templates
        for r in notices:
            if not r["words"]:
                raise ValueError(f"a template of {r['license']} has no word: {r['notice']!r}")
        if any(len(r["words"]) >= WORDS_A_SHINGLE for r in notices):
            found.append(_matched(docs, _template_rows(spark, templates)))
        found += [_short_matched(docs, r["license"], r["words"]) for r in notices if len(r["words"]) < WORDS_A_SHINGLE]
    if found:
        best = F.min(F.struct((-F.col("containment")).alias("lacks"), F.col("begin").alias("begin")))
        grouped = reduce(DataFrame.unionByName, found).groupBy("doc_id", "license").agg(best.alias("best"))
        return grouped.select("doc_id", "license", (-F.col("best.lacks")).alias("containment"), F.col("best.begin").alias("at_word"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("at_word")).filter(F.lit(False))


def reference_sql(templates: list[tuple[str, str]] = TEMPLATES) -> str:
    """The same for DuckDB, with every window held against every template of its size."""
    words = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')".format
    cut = f"list_transform(range(1, len(words) - {WORDS_A_SHINGLE - 2}), lambda i: array_to_string(words[i:i + {WORDS_A_SHINGLE - 1}], ' '))"
    rows = ", ".join(f"('{name}', '{text}')" for name, text in templates)
    return f"""
WITH notices AS (SELECT license, {words("notice")} AS words FROM (VALUES {rows}) AS v(license, notice)),
templates AS (SELECT license, wanted, len(wanted) AS size, greatest(1, len(wanted) // 4) AS pace FROM (SELECT license, list_distinct({cut}) AS wanted FROM notices WHERE len(words) >= {WORDS_A_SHINGLE})),
worded AS (SELECT doc_id, {words("coalesce(text, '')")} AS words FROM documents),
read AS (SELECT doc_id, {cut} AS shingles FROM worded),
short AS (
    SELECT doc_id, license, list_filter(range(1, len(w.words) - len(n.words) + 2), lambda i: w.words[i:i + len(n.words) - 1] = n.words)[1] - 1 AS begin
    FROM worded w JOIN notices n ON len(n.words) < {WORDS_A_SHINGLE} AND list_has_all(w.words, n.words)
),
near AS (SELECT DISTINCT doc_id, shingles, license, wanted, size, pace FROM read JOIN templates ON list_has_any(shingles, wanted)),
windows AS (SELECT doc_id, license, wanted, shingles, size, pace, unnest(range(0, len(shingles), pace)) AS start FROM near),
held AS (
    SELECT doc_id, license, greatest(0, start - pace // 2) AS begin,
           len(list_intersect(wanted, list_distinct(shingles[greatest(0, start - pace // 2) + 1:start + size + pace // 2])))::DOUBLE / len(wanted) AS containment
    FROM windows
)
SELECT doc_id, license, max(containment) AS containment, arg_min(begin, (-containment, begin))::BIGINT AS at_word
FROM (SELECT * FROM held WHERE containment >= {CONTAINMENT}::DOUBLE UNION ALL SELECT doc_id, license, begin, 1.0::DOUBLE FROM short WHERE begin IS NOT NULL) GROUP BY doc_id, license
"""
