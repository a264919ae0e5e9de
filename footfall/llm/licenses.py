"""License notices in whole texts by diagonal voting, in DataFrame functions only.

Diagonal voting: the hash of every run of K words is joined to the places of the templates that hold the same run. A
meeting votes for its offset diagonal, place in the text minus place in the template. Runs are compared word by word
where their hashes meet. Votes are aggregated by diagonal (as the set of template places, which no repetition makes
longer), each diagonal is merged with its neighbours up to `BAND` away, so that a few inserted or missing words do not
tear a notice apart, and the merged span is verified: enough of the template's words must be covered, and each number
in it (a version) must be.

Templates are a parameter. If they have at most `BROADCAST_ROWS` places, they are broadcast and no text moves; otherwise
both sides are moved by hash with the run's words beside it.

Base labels are places where a phrase's words stand consecutively; they need no template and stay whatever the method says.

Defined cases: null text is empty; a text without words has no labels and score 0; rows with the same `doc_id` are judged
row by row; a template of fewer than K words votes for nothing; of equal templates each gives its label. Very long texts
are taken whole, a row for each run of K words passes through the join and is gone if it meets nothing. Extra columns
are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut
from .common import documents
from .decontamination import WORD, words

K = 4
BAND = 2
#: Share of a template's words that a span must cover.
COVERED = 0.8
BROADCAST_ROWS = 100_000
#: Phrases and their labels; fixed values of the contract.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Public notices and the usual one-line forms.
TEMPLATES = (
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)


def template_rows(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """template (number), label, t_words."""
    rows = [F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(templates)]
    kinds = "array<struct<template:int,label:string,text:string>>"
    given = spark.range(1).select(F.inline(F.array(*rows) if rows else F.array().cast(kinds)))
    return given.select("template", "label", words(F.col("text")).alias("t_words"))


def _run_hashes(hashes: Column) -> Column:
    runs = F.transform(F.sequence(F.lit(1), F.size(hashes) - (K - 1)), lambda i: F.xxhash64(*[F.get(hashes, i - 1 + j) for j in range(K)]))
    return F.when(F.size(hashes) >= K, runs)


def _runs(texts: DataFrame, word_column: str, place: str) -> DataFrame:
    """All columns, `place` and `hash` of each run of K words; texts with fewer words have none."""
    carry = texts.columns
    hashed = texts.withColumn("hashes", F.transform(word_column, lambda w: F.xxhash64(w)))
    runs = hashed.select(*carry, _run_hashes(F.col("hashes")).alias("runs"))
    # An inner explode would be preceded by a filter that computes all the above again.
    return runs.select(*carry, F.posexplode_outer("runs").alias(place, "hash")).where("hash is not null")


def votes(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, version, template, place, t_place of each run of a text that equals a run of a template."""
    given = documents(docs).select("doc_id", F.xxhash64("text").alias("version"), words(F.col("text")).alias("words"))
    marks = cut(_runs(templates.select("template", "t_words"), "t_words", "t_place").select("template", "t_place", "hash", F.slice("t_words", F.col("t_place") + 1, F.lit(K)).alias("t_run")))
    run = F.slice("words", F.col("place") + 1, F.lit(K)).alias("run")
    found = _runs(given, "words", "place")
    few = marks.count() <= BROADCAST_ROWS
    if few:
        met = found.join(F.broadcast(marks), "hash").select("doc_id", "version", "template", "place", "t_place", "t_run", run)
    else:
        met = found.select("doc_id", "version", "place", "hash", run).join(marks, "hash")
    return met.where("run = t_run").select("doc_id", "version", "template", "place", "t_place")


def spans(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, version, template, label, first, last (words from 0), covered, share, verified: the merged diagonals.

    A diagonal and its neighbours reach over at most the template's length and `BAND` words either side.
    """
    place = F.collect_set("t_place").alias("t_places")
    diagonal = (F.col("place") - F.col("t_place")).alias("diagonal")
    lines = votes(docs, templates).groupBy("doc_id", "version", "template", diagonal).agg(place)
    around = F.explode(F.sequence(F.col("diagonal") - BAND, F.col("diagonal") + BAND)).alias("centre")
    merged = lines.select("doc_id", "version", "template", "diagonal", "t_places", around).groupBy("doc_id", "version", "template", "centre").agg(
        F.max(F.col("diagonal") == F.col("centre")).alias("own"),
        F.min(F.col("diagonal") + F.array_min("t_places")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("t_places") + (K - 1)).alias("last"),
        F.array_distinct(F.flatten(F.collect_list("t_places"))).alias("t_places"),
    )
    covered = F.array_distinct(F.flatten(F.transform("t_places", lambda t: F.sequence(t, t + (K - 1))))).alias("places")
    numbers = F.filter(F.sequence(F.lit(0), F.size("t_words") - 1), lambda i: F.get("t_words", i).rlike("^[0-9]+$")).alias("numbers")
    known = templates.where(F.size("t_words") >= K).select("template", "label", F.size("t_words").alias("t_size"), numbers)
    joined = merged.where("own").select("doc_id", "version", "template", "first", "last", covered).join(known, "template")
    share = F.size("places") / F.col("t_size")
    verified = (share >= COVERED) & (F.size(F.array_except("numbers", "places")) == 0)
    return joined.select(
        "doc_id", "version", "template", "label", "first", "last", F.size("places").alias("covered"), share.alias("share"), verified.alias("verified")
    )


def _starts(text_words: Column, phrase: Sequence[str]) -> Column:
    """Places from 0 at which the phrase's words stand one after the other."""
    places = F.sequence(F.lit(0), F.size(text_words) - len(phrase))

    def stands(i: Column) -> Column:
        same = F.get(text_words, i) == phrase[0]
        for j, word in enumerate(phrase[1:], 1):
            same = same & (F.get(text_words, i + j) == word)
        return same

    return F.when(F.size(text_words) >= len(phrase), F.filter(places, stands)).otherwise(F.array().cast("array<int>"))


def base(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, version, n_words, n_base, first_word, last_word, base_labels (array)."""
    given = documents(docs)
    n_words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words")
    # Most texts hold no phrase: only others are split into words.
    between = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    likely = "(?i)" + "|".join(between.join(phrase.split(" ")) for phrase, _ in PHRASES)
    counted = given.select("doc_id", F.xxhash64("text").alias("version"), n_words, F.when(F.col("text").rlike(likely), words(F.col("text"))).alias("words"))
    starts = [_starts(F.col("words"), phrase.split(" ")).alias(f"p{i}") for i, (phrase, _) in enumerate(PHRASES)]
    found = counted.select("doc_id", "version", "n_words", *[F.when(F.col("words").isNotNull(), s).otherwise(F.array().cast("array<int>")).alias(f"p{i}") for i, s in enumerate(starts)])
    every = F.concat(*[F.col(f"p{i}") for i in range(len(PHRASES))])
    held = [F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]
    return found.select(
        "doc_id", "version", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"), F.array_sort(F.array_distinct(F.array_compact(F.array(*held)))).alias("base_labels"),
    )


def scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """Per row of `docs`: doc_id, version, n_words, n_base, first_word, last_word, base_labels, labels, score.

    `labels` are the base labels and those of verified spans; `score` is the greatest share of a template that a merged
    diagonal covers, verified or not.
    """
    templates = templates if templates is not None else template_rows(docs.sparkSession)
    own = F.collect_set(F.when(F.col("verified"), F.col("label"))).alias("own")
    found = spans(docs, templates).groupBy(F.col("doc_id").alias("f_doc"), F.col("version").alias("f_version")).agg(own, F.max("share").alias("share"))
    rows = base(docs)
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["f_doc"]) & rows["version"].eqNullSafe(found["f_version"]), "left")
    every = F.array_sort(F.array_union("base_labels", F.coalesce("own", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "version", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"), F.coalesce("share", F.lit(0.0)).alias("score"),
    )
