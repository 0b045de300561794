"""License scan by diagonal voting.

Each template (a phrase or a notice) is a list of words with a label. All
rolling word k-grams of every whole text, by their 64-bit hash, are joined to the
template positions with the same hash (the k-gram itself is compared too, so a
vote is exact). A match at document word ``p`` and template word ``t`` votes for
the diagonal ``p - t``. Votes are counted per document, template and diagonal
(map-side combined). Words put into a notice or left out move the rest to another
diagonal, so diagonals less than the template's length apart are merged, from every
diagonal on, and each merged span is verified: the share of the template's k-grams it
holds must reach ``coverage``. It is less than twice as long as the template. Of spans of
a template that start less than its length apart the one that holds most stays (the
first of equals), and a diagonal with no k-gram of its own does not stretch it.

A phrase is a template of coverage 1 whose diagonals are not merged: its words
stand consecutively at a place exactly when all its 2-grams vote for it.

Words: A-Z count as a-z; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
(``lower`` also folds letters outside ASCII; that changes no word boundary and no
ASCII word of a template.)

Defined results: null or empty texts have no words and no places. Each input row
gives one output row, repeated rows too. An empty table gives no rows. Extra
columns are not carried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASE_K = 2
NOTICE_K = 5
COVERAGE = 0.6
PHRASE_SCORE = 0.5       # a mention counts less than a whole notice
MAX_TEMPLATE_GRAMS = 200_000   # bound of the broadcast side


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    text: str
    base: bool = False
    notice: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", self.text.lower())

    @property
    def k(self) -> int:
        return NOTICE_K if self.notice else PHRASE_K


# Phrases and the opening passages of public licence notices.
TEMPLATES: tuple[Template, ...] = (
    Template("phrase-mit", "mit", "mit license", base=True),
    Template("phrase-apache", "apache", "apache license", base=True),
    Template("phrase-gpl", "gpl", "general public license", base=True),
    Template("spdx-mit", "mit", "SPDX-License-Identifier: MIT"),
    Template("spdx-apache", "apache", "SPDX-License-Identifier: Apache"),
    Template("spdx-gpl", "gpl", "SPDX-License-Identifier: GPL"),
    Template("spdx-bsd", "bsd", "SPDX-License-Identifier: BSD"),
    Template("phrase-bsd", "bsd", "bsd license"),
    Template("phrase-mpl", "mpl", "mozilla public license"),
    Template("phrase-cc", "cc", "creative commons attribution"),
    Template("notice-mit", "mit", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions"), notice=True),
    Template("notice-apache", "apache", (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."), notice=True),
    Template("notice-gpl", "gpl", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"), notice=True),
    Template("notice-bsd", "bsd", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."), notice=True),
)


def template_positions(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(gram, h, template, at): every k-gram of every template and its position."""
    rows = []
    for i, t in enumerate(templates):
        if len(t.words) < t.k:
            raise ValueError(f"template {t.name!r} has fewer than {t.k} words")
        rows += [(" ".join(t.words[at: at + t.k]), i, at) for at in range(len(t.words) - t.k + 1)]
    if len(rows) > MAX_TEMPLATE_GRAMS:
        raise ValueError(f"{len(rows)} template positions; at most {MAX_TEMPLATE_GRAMS} are broadcast")
    return spark.createDataFrame(rows, "gram string, template int, at int").withColumn("h", F.xxhash64("gram"))


def _template_facts(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    rows = [(i, t.label, t.base, t.notice, t.k, len(t.words), len(t.words) - t.k + 1) for i, t in enumerate(templates)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, notice boolean, k int, words int, grams int")


def rolling_grams(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """One row per text and rolling k-gram: row, doc_id, n_words, pos, gram. Every
    text also has one row with pos -1 and no gram, which carries its counts.

    Positions are generated, and each picks its words from the text's list: the
    list is neither copied per position nor built up a second time as k-grams.
    """
    text = F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                        F.array_remove(F.split(text, SEPARATORS, -1), "").alias("words"))
    pos, k = F.col("pos"), F.col("k")
    placed = (words.withColumn("n_words", F.size("words"))
              .withColumn("pos", F.explode(F.sequence(F.lit(-1), F.col("n_words") - 1)))
              .withColumn("k", F.explode(F.array(F.lit(PHRASE_K), F.lit(NOTICE_K))))
              .filter(((pos >= 0) & (pos + k <= F.col("n_words"))) | ((pos < 0) & (k == PHRASE_K))))
    gram = lambda n: F.concat_ws(" ", *(F.get("words", pos + j) for j in range(n)))
    return placed.select("row", "doc_id", F.col("n_words").cast("long").alias("n_words"), "pos",
                         F.when(pos < 0, None).when(k == PHRASE_K, gram(PHRASE_K)).otherwise(gram(NOTICE_K)).alias("gram"))


def spans(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text_col: str = "text", id_col: str = "doc_id",
          coverage: float = COVERAGE) -> DataFrame:
    """Verified spans: row, doc_id, n_words, template, label, base, notice, first
    (word where it starts), last (its last word), cover. Each document also has a
    row without a template, so that documents without spans stay visible."""
    spark = docs.sparkSession
    votes = (rolling_grams(docs, text_col, id_col).withColumn("h", F.xxhash64("gram"))
             .join(F.broadcast(template_positions(spark, templates).withColumnRenamed("gram", "template_gram")), "h", "left")
             .filter((F.col("gram") == F.col("template_gram")) | (F.col("pos") < 0))
             .withColumn("diagonal", F.col("pos") - F.col("at"))
             .groupBy("row", "doc_id", "n_words", "template", "diagonal")
             .agg(F.count("at").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                  F.collect_set("at").alias("ats")))
    votes = votes.join(F.broadcast(_template_facts(spark, templates)), "template", "left")
    # Diagonals from each one on, less than a template's length away (a phrase: itself alone).
    longest = max((len(t.words) for t in templates), default=1)
    along = F.when(F.col("notice"), F.col("diagonal")).otherwise(F.col("diagonal") * longest).cast("long")
    onward = Window.partitionBy("row", "template").orderBy("along").rangeBetween(0, longest - 1)
    near = F.filter(F.collect_list(F.struct((-F.col("votes")).alias("fewer"), "diagonal", "lo", "hi", "ats")).over(onward),
                    lambda d: d["diagonal"] - F.col("diagonal") < F.col("words"))
    none = F.struct(F.array().cast("array<int>").alias("held"), F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"))
    union = F.aggregate(F.array_sort("near"), none, lambda acc, d: F.when(
        F.size(F.array_except(d["ats"], acc["held"])) > 0,
        F.struct(F.array_union(acc["held"], d["ats"]).alias("held"), F.least(acc["lo"], d["lo"]).alias("lo"),
                 F.greatest(acc["hi"], d["hi"]).alias("hi"))).otherwise(acc))
    merged = (votes.withColumn("along", along).withColumn("near", near).withColumn("span", union)
              .withColumn("cover", F.size("span.held") / F.col("grams")))
    whole = F.when(F.col("notice"), F.col("cover") >= coverage).otherwise(F.size("span.held") == F.col("grams"))
    facts = ["row", "doc_id", "n_words", "template", "label", "base", "notice"]
    places = (merged.filter(F.col("template").isNull() | whole)
              .select(*facts, "words", F.struct((-F.col("cover")).alias("less"), "diagonal", F.col("span.lo").alias("first"),
                                                (F.col("span.hi") + F.col("k") - 1).alias("last"), "cover").alias("place"))
              .groupBy(*facts, "words").agg(F.collect_list("place").alias("places")))
    apart = F.aggregate(F.array_sort("places"), F.slice("places", F.lit(1), F.lit(0)), lambda kept, p: F.when(
        F.exists(kept, lambda q: F.abs(q["diagonal"] - p["diagonal"]) < F.col("words")), kept).otherwise(F.concat(kept, F.array(p))))
    return (places.withColumn("place", F.explode(F.when(F.col("notice"), apart).otherwise(F.col("places"))))
            .select(*facts, "place.first", "place.last", "place.cover"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text_col: str = "text", id_col: str = "doc_id",
         coverage: float = COVERAGE) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score (best verified coverage; a phrase alone gives 0.5)."""
    found = spans(docs, templates, text_col, id_col, coverage)
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return (found.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        joined("label").alias("labels"),
        F.coalesce(F.max(F.when(F.col("notice"), F.least(F.col("cover"), F.lit(1.0)))
                         .when(F.col("template").isNotNull(), F.lit(PHRASE_SCORE))), F.lit(0.0)).alias("score"))
        .drop("row"))
