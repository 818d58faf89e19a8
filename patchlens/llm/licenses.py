"""License scan with MinHash bands over overlapping text windows, by DataFrame functions alone.

1. Words are lower-case runs of letters and digits, hashed to 64 bits; a shingle
   is five words.  A template of fewer words is one shingle of its own length.
2. A text is cut into windows of WINDOW words that start every STEP words, so
   neighbours overlap and every shingle lies in exactly one window.
3. BANDS hash functions give each window its MinHash bands of one row each: the
   least hash of its shingles.  A template's bands are those of each of its
   shingles, so a window that holds m of a template's shingles among its at
   most STEP meets the template in a band with probability 1 - (1 - m / STEP) ** BANDS:
   0.99998 for one shingle of two, the least there is.  A template that lies in a text in
   full meets it in at least one window that often, longer ones in several.
   For shorter templates a window is one shingle of their length, at every word:
   it is its own band, so they are retrieved with certainty.
4. Templates so retrieved are verified exactly: containment is the share of the
   template's shingles that the text holds, and matches reach CONTAINMENT.

The band table is broadcast in parts of at most PART_SHINGLES template shingles,
one pass each, so its size is bounded for any number of templates.  Candidates
are (text, template) pairs, never pairs of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import bounded_broadcast, settle

SHINGLE = 5
WINDOW = 6
STEP = WINDOW - SHINGLE + 1
BANDS = 16
CONTAINMENT = 0.8
PART_SHINGLES = 50_000

# --- fixed values: public license notices (id, text) ---
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
     "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
#: Notices of fewer than five words.
SHORT_NOTICES = [
    ("All-rights-reserved", "All rights reserved."),
    ("SPDX-tag", "SPDX-License-Identifier:"),
]


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES + SHORT_NOTICES, "template_id string, text string")


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words, in order."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _hash_at(hashes: Column, i, size: int = SHINGLE) -> Column:
    """The hash of the shingle that starts at ``i``; null if the text ends before it does."""
    parts = [F.get(hashes, i + k) for k in range(size)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(*parts))


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of all shingles of ``size`` words of a text, repeats included; none for fewer words."""
    return F.transform(F.array(word_hashes(text)), lambda h: F.when(F.size(h) >= size, F.transform(
        F.sequence(F.lit(0), F.size(h) - size), lambda i: _hash_at(h, i, size))).otherwise(F.array().cast("array<bigint>")))[0]


def _window(i) -> Column:
    return F.slice(F.col("_words"), i * STEP + 1, WINDOW)


def windows(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and the array ``w`` of word hashes of each window (the last may be shorter)."""
    n = F.size("_words")
    hashed = rows.select(*keys, word_hashes(F.col(text)).alias("_words")).filter(n >= SHINGLE)
    starts = F.sequence(F.lit(0), F.floor((n - SHINGLE) / STEP).cast("int"))
    return hashed.select(*keys, F.explode(F.transform(starts, _window)).alias("w"))


def bands(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and each band value of each window."""
    parts = [_hash_at(F.col("w"), F.lit(i)).alias(f"s{i}") for i in range(STEP)]
    hashed = rows.select(*keys, *parts)

    def band(j):
        values = [F.when(F.col(f"s{i}").isNotNull(), F.xxhash64(F.col(f"s{i}"), F.lit(j))) for i in range(STEP)]
        return F.least(*values) if STEP > 1 else values[0]

    return hashed.select(*keys, F.explode(F.array(*[band(j) for j in range(BANDS)])).alias("band"))


def template_table(templates: DataFrame) -> DataFrame:
    """template_id, its shingle length and distinct shingles; repeated templates once, those without a word left out."""
    size = F.least(F.size(word_hashes(F.col("text"))), F.lit(SHINGLE))
    mine = F.coalesce(*[F.when(F.col("size") == k, shingles(F.col("text"), k)) for k in range(1, SHINGLE + 1)])
    return settle(templates.select("template_id", "text", size.alias("size")).filter("size > 0")
                  .select("template_id", "size", F.array_distinct(mine).alias("shingles")).distinct())


def short_bands(rows: DataFrame, keys: list[str], text: str, sizes: list[int]) -> DataFrame:
    """``keys`` and the band value of each window of one shingle, for each of the ``sizes``."""
    values = F.transform(F.concat(*[shingles(F.col(text), k) for k in sizes]), lambda s: F.xxhash64(s, F.lit(0)))
    return rows.select(*keys, F.explode(F.array_distinct(values)).alias("band"))


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, template_id, matched, containment, first_word per text and template it holds.

    containment = matched / the template's distinct shingles, at least 0.8;
    first_word counts words before the first matching shingle.  Null and empty
    texts, and those shorter than a template's shingle, do not match it; rows that agree in doc_id and text are one
    text.  Empty tables give an empty result.
    """
    table = template_table(templates)
    counts = {r["size"]: r["n"] for r in table.groupBy("size").agg(F.sum(F.size("shingles")).alias("n")).collect()}
    total, sizes = sum(counts.values()), sorted(counts) or [SHINGLE]
    parts = max(1, -(-total // PART_SHINGLES))
    short = [k for k in sizes if k < SHINGLE]
    rows = docs.select("doc_id", F.col("text").alias("_text")).withColumn("_row", F.xxhash64("_text"))
    found = None
    for part in range(parts):
        mine = table.withColumn("s", F.explode("shingles")).filter(F.pmod("s", F.lit(parts)) == part)
        probe = mine.filter(F.col("size") == SHINGLE).select(
            "template_id", F.explode(F.array(*[F.xxhash64(F.col("s"), F.lit(j)) for j in range(BANDS)])).alias("band")).distinct()
        hits = [bands(windows(rows, ["doc_id", "_row"], "_text"), ["doc_id", "_row"]).join(F.broadcast(probe), "band")]
        if short:
            probe = mine.filter(F.col("size") < SHINGLE).select("template_id", F.xxhash64("s", F.lit(0)).alias("band")).distinct()
            hits.append(short_bands(rows, ["doc_id", "_row"], "_text", short).join(F.broadcast(probe), "band"))
        for hit in hits:
            hit = hit.select("doc_id", "_row", "template_id")
            found = hit if found is None else found.unionByName(hit)
    candidates = settle(found.distinct())
    wanted = candidates.groupBy("doc_id", "_row").agg(F.collect_list("template_id").alias("ids"))
    texts = rows.join(bounded_broadcast(wanted, 100 * candidates.count()),
                      rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["_row"] == wanted["_row"]), "inner") \
        .select(rows["doc_id"], rows["_row"], "_text", "ids").dropDuplicates(["doc_id", "_row"])
    held = texts.select("doc_id", F.array(*[shingles(F.col("_text"), k) for k in sizes]).alias("_held"), F.explode("ids").alias("template_id"))
    sized = bounded_broadcast(table.withColumnRenamed("shingles", "want"), 16 * total)
    own = F.coalesce(*[F.when(F.col("size") == k, F.col("_held")[i]) for i, k in enumerate(sizes)])
    both = held.join(sized, "template_id").withColumn("held", own)
    # positions of the shingles that the template has
    first = F.expr("filter(transform(held, (s, i) -> if(array_contains(want, s), i, null)), i -> i is not null)[0]")
    matched = F.size(F.array_intersect("want", "held"))
    return both.select("doc_id", "template_id", matched.alias("matched"), (matched / F.size("want")).alias("containment"),
                       first.cast("int").alias("first_word")).filter(F.col("containment") >= CONTAINMENT)
