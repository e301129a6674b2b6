"""License scans in Spark expressions: MinHash bands over overlapping word windows find templates, shingle containment confirms them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: License notices as their licenses or common practice word them.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "CC-BY-ND-4.0": ["This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "Licensed under CC BY-ND 4.0."],
    "CC-BY-NC-SA-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-NC-ND-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "Licensed under CC BY-NC-ND 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Proprietary": ["All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means"],
}
SHINGLE, PERCENT = 5, 80
#: Bands of the sketch, and its coordinates a band. A window that lies within an eighth of its length of a template which it holds to 80 percent has a Jaccard similarity of 0.8 * 7/8 / (2 - 0.8 * 7/8) > 0.53 with it, and shares a band with probability 1 - (1 - 0.53)^16 > 0.99999.
BANDS, ROWS = 16, 1
MARKS = ".,;:!?\"'()[]{}…«»“”‘’*#/"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.translate(F.coalesce(text, F.lit("")), MARKS, " " * len(MARKS))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _shingles(words: Column, width: int = SHINGLE) -> Column:
    """64-bit hashes of the shingles of words, in order, repeats kept; of the whole sequence if it is shorter; none without words."""
    n = F.size(words)
    return F.when(n >= width, F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - width + 1)), lambda i: F.xxhash64(F.slice(words, i, width)))).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<long>"))


def _bands(items: Column) -> Column:
    """Band keys of a nonempty set of hashes: each coordinate is the smallest of the items hashed with its own seed."""
    def coordinate(k: int) -> Column:
        return F.array_min(F.transform(items, lambda x: F.xxhash64(x, F.lit(k))))

    return F.array(*[F.xxhash64(F.lit(b), *[coordinate(b * ROWS + r) for r in range(ROWS)]) for b in range(BANDS)])


def _needed(words: list[str]) -> set[str]:
    """Words of a template such that every text holding PERCENT percent of its shingles holds one of them.

    The shingles without a needed word are fewer than PERCENT percent of all; words are taken from the longest on.
    """
    width = min(SHINGLE, len(words))
    grams = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    needed: set[str] = set()
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        if sum(not needed & set(g) for g in grams) * 100 < len(grams) * PERCENT:
            break
        needed.add(w)
    return needed


def _plain_words(text: str) -> list[str]:
    return text.translate({ord(c): " " for c in MARKS}).lower().split()


def templates(spark: SparkSession, notices: dict[str, list[str]] | None = None) -> DataFrame:
    """One row a notice: license, notice, n (shingles), items (distinct shingles), keys (bands)."""
    rows = [(name, i, text) for name, texts in (notices or TEMPLATES).items() for i, text in enumerate(texts)]
    made = spark.createDataFrame(rows, "license string, notice int, text string").select("license", "notice", _shingles(_words(F.col("text"))).alias("all"))
    sets = made.where(F.size("all") > 0).select("license", "notice", F.size("all").alias("span"), F.array_distinct("all").alias("items"))
    return sets.select("license", "notice", "span", "items", _bands(F.col("items")).alias("keys"))


def license_scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", notices: dict[str, list[str]] | None = None) -> DataFrame:
    """License notices held by documents: doc_id, license, containment (percent of the notice's shingles, rounded down), position (first word, from 0, of the first of the notice's shingles in the best window).

    For each length of notice, windows of as many shingles begin at every eighth of that length;
    windows and notices that share a MinHash band are compared by their shingle sets, over the
    window and an eighth before and after it. A notice is held if PERCENT percent of its shingles
    are there; of a document and license the fullest, then first, window is returned. Documents
    without any word that a notice needs cannot hold it and are passed over, whole texts are read
    for that, and so are windows without such a word. The notices are a parameter of bounded size, so their table is broadcast. Null and
    wordless texts hold nothing; rows equal in id and text give one row; null ids are kept; other
    columns are ignored, whatever their names; an empty table of documents gives an empty result.
    """
    spark = docs.sparkSession
    known = templates(spark, notices)
    spans = sorted(r.span for r in known.select("span").distinct().collect())
    needed = sorted(set().union(*[_needed(_plain_words(t)) for ts in (notices or TEMPLATES).values() for t in ts if _plain_words(t)]))
    lowered = F.lower(F.col("text"))
    may = reduce(lambda a, b: a | b, [lowered.contains(w) for w in needed], F.lit(False))
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where(may)
    d = d.select("doc_id", F.xxhash64("text").alias("tkey"), _words(F.col("text")).alias("words")).withColumn("all", _shingles(F.col("words")))

    marked = F.filter(F.transform("words", lambda w, i: F.when(w.isin(*needed), i)), lambda i: i.isNotNull())
    d = d.withColumn("marked", marked)

    def windows(span: int) -> Column:
        step = max(1, span // 8)
        last = F.greatest(F.lit(0), F.size("all") - span)
        begins = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(step)), F.array(last)))
        begins = F.filter(begins, lambda a: F.exists("marked", lambda i: (i >= a - step) & (i < a + span + step + SHINGLE)))
        return F.transform(begins, lambda a: F.struct(F.lit(span).alias("span"), a.alias("at"), F.slice("all", a + 1, span).alias("near"), F.greatest(F.lit(0), a - step).alias("from"), F.slice("all", F.greatest(F.lit(0), a - step) + 1, span + 2 * step).alias("wide")))

    # No filter on these columns: pushed down, it would spell the words out again for every shingle.
    cut = d.select("doc_id", "tkey", F.explode(F.concat(*[windows(s) for s in spans])).alias("w"))
    keyed = cut.select("doc_id", "tkey", "w.span", "w.at", "w.from", "w.wide", F.explode(_bands(F.col("w.near"))).alias("key"))
    bands = known.select("license", "notice", F.col("span").alias("k_span"), "items", F.explode("keys").alias("key"))
    met = keyed.join(F.broadcast(bands), "key").where("span = k_span").dropDuplicates(["doc_id", "tkey", "license", "notice", "at"])
    held = met.withColumn("n", F.size(F.array_intersect("items", "wide"))).where(F.col("n") * 100 >= F.size("items") * PERCENT)
    scored = held.select("doc_id", "tkey", "license", F.floor(F.col("n") * 100 / F.size("items")).cast("long").alias("containment"), (F.col("from") + F.array_min(F.filter(F.transform("items", lambda x: F.array_position("wide", x)), lambda i: i > 0)) - 1).cast("long").alias("position"))
    best = scored.groupBy("doc_id", "tkey", "license").agg(F.max("containment").alias("containment"), F.min_by("position", F.struct(-F.col("containment"), F.col("position"))).alias("position"))
    return best.drop("tkey")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all notices."""
    return license_scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    rows = ", ".join(f"('{name}', {i}, '{t.replace(chr(39), chr(39) * 2)}')" for name, ts in TEMPLATES.items() for i, t in enumerate(ts))
    marks = MARKS.replace("'", "''")
    words = f"list_filter(string_split_regex(lower(translate(coalesce(text, ''), '{marks}', '{' ' * len(MARKS)}')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    grams = f"CASE WHEN len(w) >= {SHINGLE} THEN list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: w[i : i + {SHINGLE - 1}]) WHEN len(w) > 0 THEN [w] ELSE [] END"
    return f"""
WITH t0(license, notice, text) AS (VALUES {rows}), t1 AS (SELECT license, notice, {words} AS w FROM t0), t AS (SELECT license, notice, {grams} AS g FROM t1),
d0 AS (SELECT DISTINCT doc_id, text FROM documents), d1 AS (SELECT doc_id, text, {words} AS w FROM d0), d AS (SELECT doc_id, text, {grams} AS g FROM d1),
s AS (SELECT DISTINCT len(g) AS span, greatest(1, len(g) // 8) AS step FROM t),
-- Documents that share no shingle with any notice hold none.
h AS (SELECT DISTINCT doc_id, text FROM (SELECT doc_id, text, unnest(g) AS x FROM d) JOIN (SELECT DISTINCT unnest(g) AS x FROM t) USING (x)),
w AS (SELECT d.doc_id, d.text, d.g, span, step, unnest(list_distinct(list_append(range(0, greatest(0, len(d.g) - span) + 1, step), greatest(0, len(d.g) - span)))) AS p FROM d JOIN h ON h.doc_id = d.doc_id AND h.text = d.text, s WHERE len(d.g) > 0),
m AS (SELECT w.doc_id, w.text, t.license, p, len(list_intersect(list_distinct(t.g), w.g[greatest(0, p - step) + 1 : greatest(0, p - step) + span + 2 * step])) AS n, len(list_distinct(t.g)) AS k, t.g AS tg, w.g[greatest(0, p - step) + 1 : greatest(0, p - step) + span + 2 * step] AS wide, greatest(0, p - step) AS lo FROM w JOIN t ON len(t.g) = w.span),
c AS (SELECT doc_id, text, license, lo + list_min(list_filter(list_transform(tg, lambda x: list_position(wide, x)), lambda i: i > 0)) - 1 AS q, CAST(n * 100 // k AS BIGINT) AS containment FROM m WHERE n * 100 >= k * {PERCENT})
SELECT doc_id, license, containment, CAST(q AS BIGINT) AS position FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, text, license ORDER BY containment DESC, q) AS r FROM c) WHERE r = 1
"""


ORACLE_SQL = _oracle()
