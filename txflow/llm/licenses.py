"""License scan: names of licenses, and an exact set-similarity join of word runs with notice templates.

A run is some words in a row, across line ends; its length is bounded by the template's (SLACK times its words), so that
scattered words don't make a notice. A run starts with a word of the template and fits it if it holds at least ``THRESHOLD`` of the template's
distinct words. Every run lies in one of the blocks of twice its length that overlap by half. Blocks are joined
with the templates: words are ordered by their frequency over the corpus, rarest first; of a template of n words that
must share o with a block only the n - o + 1 rarest can be the first shared word (prefix filter); a block needs o words
(length filter); and the words that still follow on both sides must be enough (positional filter). In the blocks that
pass every run is verified. Everything is DataFrame functions.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import saved, text_of

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8

# fixed values: phrases that name a license, and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

SLACK = 1.25      # a run may have so many times the words of its template

# fixed values: notices by label, as the licenses word them
TEMPLATES = {
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "This work is licensed under the GNU General Public License version 3",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ],
    "apache": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
}

# labels whose notices differ by few words: of those that fit at one place the most similar one counts
FAMILIES = {"cc-by": "cc", "cc-by-sa": "cc", "cc-by-nc": "cc", "lgpl": "gpl"}


def words_of(text: Column) -> Column:
    """The words of a text in order. ``lower`` stands for A-Z to a-z: whatever else it changes stays within words,
    and none of it becomes a letter of the phrases."""
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def phrase_places(words: Column) -> Column:
    """(word, label) of every place where a phrase's words stand consecutively."""
    return F.concat(*[_places_of(words, phrase.split(" "), label) for phrase, label in PHRASES.items()])


def _places_of(words: Column, parts: list[str], label: str) -> Column:
    """Every place of the first word, then those where the others follow."""
    def followed(i: Column) -> Column:
        same = [F.get(words, i + j) == part for j, part in enumerate(parts)]
        return F.coalesce(reduce(Column.__and__, same), F.lit(False))

    firsts = F.filter(F.transform(words, lambda w, i: F.when(w == parts[0], i)), lambda i: i.isNotNull())
    return F.transform(F.filter(firsts, followed),
                       lambda i: F.struct(i.cast("long").alias("word"), F.lit(label).alias("label")))


def notice_words(notice: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), notice)) if w]


def known_templates(templates: dict[str, list[str]] | DataFrame | None = None, threshold: float = THRESHOLD) -> list[dict]:
    """name, label, family, words (distinct), need (how many of them a run must hold) and run (its words at most) of every
    notice; a table has the columns label, family (null: the label) and notice and is a list of known licenses."""
    if isinstance(templates, DataFrame):
        rows = [tuple(r) for r in templates.select("label", F.coalesce("family", "label"), "notice").collect()]
    else:
        rows = [(label, FAMILIES.get(label, label), n) for label, notices in (templates or TEMPLATES).items() for n in notices]
    out = []
    for i, (label, family, notice) in enumerate(rows):
        given = notice_words(notice)
        words = sorted(set(given))
        if words:
            out.append({"name": i, "label": label, "family": family, "words": words,
                        "need": -(-len(words) * round(threshold * 1000) // 1000), "run": math.ceil(SLACK * len(given))})
    return out


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, list[str]] | DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, n_words, places (word, label), base_labels, labels, score.

    ``base_labels`` come from the phrases, ``labels`` also from the templates; both distinct and sorted. Of templates of
    one family that fit runs with the same first word the one of the largest share counts, then of most words, then of
    the smallest label. ``score``: 1 where a phrase stands, else the largest share of a template that counts, else 0. A
    null text is empty: no words, no labels. Null and repeated ids stay rows of their own, an empty table gives no
    rows, other columns are not read. A text may have any length.

    The text is read once. A document is cut into blocks only for templates of which it holds enough words as a whole,
    and of a block only the words of the templates (a fixed list) are kept; the join is on words of the templates'
    prefixes, and its keys carry the block, so that a frequent word is dealt by its blocks.
    """
    spark = docs.sparkSession
    known = known_templates(templates, threshold)
    vocabulary = sorted({w for t in known for w in t["words"]})
    if not vocabulary:
        raise ValueError("no template has a word")
    words_known = F.array(*[F.lit(w) for w in vocabulary])

    text = text_of(F.col(text_col))
    any_phrase = "|".join(p.replace(" ", NOT_WORD) for p in PHRASES)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("all_words", words_of(F.col("text")))
    rows = rows.withColumn("held", F.array_intersect("all_words", words_known))
    # templates of which the document as a whole holds enough, and for each length of run the blocks of its words
    likely = F.filter(F.array(*[F.when(F.size(F.array_intersect("held", F.array(*[F.lit(w) for w in t["words"]]))) >= t["need"],
                                       F.lit(t["run"])) for t in known], F.lit(None).cast("int")), lambda x: x.isNotNull())
    number = F.size("all_words")

    def blocks_of(run: Column) -> Column:
        starts = F.when(number > 0, F.sequence(F.lit(0), number - 1, run)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.struct(run.alias("run"), s.alias("start"), F.transform(
            F.slice("all_words", s + 1, 2 * run), lambda w: F.when(F.array_contains(words_known, w), w).otherwise(F.lit(""))).alias("words")))

    none = F.array().cast("array<struct<word:bigint,label:string>>")
    rows = saved(rows.select(
        F.monotonically_increasing_id().alias("row"), "id", number.cast("long").alias("n_words"), "held",
        F.when(F.lower("text").rlike(any_phrase), phrase_places(F.col("all_words"))).otherwise(none).alias("places"),
        F.flatten(F.transform(F.array_distinct(likely), blocks_of)).alias("blocks")), "license-rows")

    # how many documents hold each word: at most as many sums as the templates have words
    counts = rows.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    seen = {r["word"]: r["n"] for r in counts.collect()}
    rank = {w: i + 1 for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    ranks = F.create_map(*[x for w in vocabulary for x in (F.lit(w), F.lit(rank[w]))])
    prefixes = []
    for t in known:
        ordered = sorted(rank[w] for w in t["words"])
        prefixes += [(t["label"], t["family"], t["run"], ordered, t["need"], r, i)
                     for i, r in enumerate(ordered[:len(ordered) - t["need"] + 1])]
    index = spark.createDataFrame(prefixes, "label string, family string, t_run int, t_ranks array<int>, need int, t_rank int, t_at int")

    # a block's words as ranks, 0 for a word of no template
    numbered = F.transform("b.words", lambda w: F.coalesce(F.try_element_at(ranks, w), F.lit(0)))
    blocks = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.run", "b.start", numbered.alias("at"))
    blocks = blocks.withColumn("b_ranks", F.array_sort(F.array_remove(F.array_distinct("at"), 0)))
    probes = blocks.select("*", F.posexplode("b_ranks").alias("b_at", "b_rank"))
    candidates = (probes.join(F.broadcast(index), (F.col("b_rank") == F.col("t_rank")) & (F.col("run") == F.col("t_run")))
                  .filter(F.size("b_ranks") >= F.col("need"))                            # length
                  .filter(F.least(F.size("t_ranks") - F.col("t_at"),                     # position: the first shared
                                  F.size("b_ranks") - F.col("b_at")) >= F.col("need"))   # word has enough after it
                  .filter(F.size(F.array_intersect("t_ranks", "b_ranks")) >= F.col("need")))
    # a run belongs to the block that its first word is in the first half of
    size = F.size("at")
    starts = F.filter(F.sequence(F.lit(0), F.least(F.col("run"), size) - 1), lambda s: F.array_contains("t_ranks", F.get("at", s)))
    shares = F.transform(starts, lambda s: F.struct(
        (F.col("start") + s).alias("from"), F.size(F.array_intersect(F.slice("at", s + 1, F.col("run")), F.col("t_ranks"))).alias("shared")))
    fits = (candidates.select("row", "label", "family", F.size("t_ranks").alias("of"), F.explode(
        F.filter(shares, lambda x: x["shared"] >= F.col("need"))).alias("run")).distinct())
    share = F.col("run.shared") / F.col("of")
    won = fits.groupBy("row", "family", F.col("run.from").alias("from")).agg(
        F.min(F.struct((-share).alias("s"), (-F.col("of")).alias("n"), "label")).alias("best"))
    won = won.select("row", F.col("best.label").alias("label"), (-F.col("best.s")).alias("share"))
    found = (won.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
             .withColumnRenamed("row", "f_row"))

    out = rows.join(found, F.col("row") == F.col("f_row"), "left")
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    return out.select(
        F.col("id").alias(id_col), "n_words", "places", F.array_sort(base).alias("base_labels"),
        F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
