"""License scans: phrases in place, and an exact set-similarity join with notices.

A text block is a stretch of 2c words that starts at a multiple of c; c is the
least power of two (8 at least) that holds the template, so a template's words
standing together always lie inside one block whole. A block is found when it
contains ``percent`` of the template's distinct words.

The join is the prefix-filtering one. Words are ordered by how often they occur
in the whole corpus, rarest first. Only words of some template can be shared, so
a block is reduced to those; with an overlap of ``need`` words asked for, the first
shared word must be among the first ``size - need + 1`` words of the template and
of the block (prefix filter), the block must hold ``need`` words (length filter), and
no fewer than ``need`` may remain from the shared word on (positional filter). What
passes is verified by the intersection itself.

The side that is sent everywhere is the index of template prefixes: a few words
of each template, whatever the corpus. Documents are not shuffled; what is found
is, as one row per text. Everything is built-in column functions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medley.llm.common import LOWER, LOWER_AZ, UPPER, text_of, written

# Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text; this is what lies between.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Phrase:
    """Words that stand consecutively, and the label they give."""
    text: str
    label: str


@dataclass(frozen=True)
class Template:
    """A notice whose words may be reordered, wrapped or slightly changed."""
    label: str
    text: str

    @property
    def words(self) -> list[str]:
        return words_in(self.text)

    @property
    def step(self) -> int:
        """Block stride: the least power of two that holds the notice, 8 at least."""
        return max(8, 1 << (len(self.words) - 1).bit_length())

    def need(self, percent: int) -> int:
        return -(-percent * len(set(self.words)) // 100)


# The base phrases and their labels.
PHRASES = (
    Phrase("gnu general public license", "gpl"),
    Phrase("apache license", "apache"),
    Phrase("cc by", "cc-by"),
    Phrase("mit license", "mit"),
)
# Public license notices as their owners word them.
TEMPLATES = (
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the "
                     "Free Software Foundation"),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may "
                           "obtain a copy of the License at"),
    Template("bsd", "Redistributions of source code must retain the above copyright notice, this list "
                    "of conditions and the following disclaimer"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 "
                          "International License"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related "
                    "or neighboring rights to this work"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the "
                    "terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose "
                    "with or without fee is hereby granted"),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the "
                     "Free Software Foundation"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                    "this software and associated documentation files, to deal in the Software without "
                    "restriction"),
    Template("mit", "Released under the MIT License"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)
PERCENT = 90


def words_in(text: str) -> list[str]:
    """The words of a short text, as ``words_of`` gives them for a column."""
    return [w for w in re.split(GAP, text.translate(LOWER_AZ)) if w]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), GAP), "")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(docs, text_col)
    return docs.select(docs[id_col].alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("digest"))


def word_order(docs: DataFrame, vocabulary: Iterable[str], text_col: str = "text") -> list[str]:
    """``vocabulary`` by its number of occurrences in all texts, rarest first, ties
    by the word. What reaches the driver is one count per vocabulary word."""
    spark, vocabulary = docs.sparkSession, sorted(set(vocabulary))
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, vocabulary))).alias("word"))
    counts = (docs.select(F.explode_outer(words_of(text_of(docs, text_col))).alias("word"))
              .join(F.broadcast(listed), "word").groupBy("word").agg(F.count("*").alias("n")))
    n = {r.word: r.n for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def prefix_index(spark: SparkSession, templates, order: list[str], percent: int) -> DataFrame:
    """(word, template, label, at, size, need, step, notice): the prefix words of each
    template with their place among its words in ``order``."""
    rank, rows = {w: k for k, w in enumerate(order)}, []
    for k, t in enumerate(templates):
        notice = sorted(set(t.words), key=rank.__getitem__)
        need = t.need(percent)
        fixed = {"template": k, "label": t.label, "size": len(notice), "need": need, "step": t.step}
        rows += [F.struct(F.lit(w).alias("word"), F.lit(at).alias("at"),
                          *[F.lit(v).alias(c) for c, v in fixed.items()],
                          F.array(*map(F.lit, notice)).alias("notice"))
                 for at, w in enumerate(notice[:len(notice) - need + 1])]
    return spark.range(1).select(F.inline(F.array(*rows)))


BLOCKS = ("digest string, template int, label string, first_word long, n_words int, overlap int, "
          "size int, containment double, block string")


def find_blocks(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Every text block that holds ``percent`` of a template's words, once per
    distinct text (``digest`` is the text's SHA-256) and template.

    ``first_word`` is the block's start in words, ``block`` its words. A template
    without words finds nothing; one word gives a block for each place of it.
    NULL and empty texts have no blocks. A very long text is one array of words in
    one task; its blocks are handled one at a time."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be over 0 and at most 100")
    spark, templates = docs.sparkSession, [t for t in templates if t.words]
    if not templates:
        return spark.createDataFrame([], BLOCKS)
    order = word_order(docs, {w for t in templates for w in t.words}, text_col)
    index = prefix_index(spark, templates, order, percent)
    known = F.array(*[F.lit(w) for w in order])
    first = sorted({r.word for r in index.select("word").collect()})
    # a text's words stay one array; only the places of prefix words become rows (the
    # outer form keeps the optimizer from splitting each text twice to test for none)
    spots = F.when(F.arrays_overlap("words", F.array(*map(F.lit, first))), F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("pos"))),
        lambda x: x["word"].isin(first)))
    at_words = (_texts(docs, id_col, text_col)
                .select("digest", words_of(F.col("text")).alias("words"))
                .select("digest", "words", F.explode_outer(spots).alias("spot"))
                .filter("spot.word is not null")
                .select("digest", "words", "spot.*").join(F.broadcast(index), "word"))
    piece = F.floor(F.col("pos") / F.col("step"))
    blocks = (at_words.select("*", F.explode(F.array(piece - 1, piece)).alias("piece"))
              .filter("piece >= 0")
              .withColumn("first_word", F.col("piece") * F.col("step"))
              .withColumn("block", F.slice("words", (F.col("first_word") + 1).cast("int"),
                                           (2 * F.col("step")).cast("int")))
              .drop("words", "piece", "pos")
              .withColumn("held", F.array_intersect(known, F.col("block"))))
    held, need = F.size("held"), F.col("need")
    j = F.array_position("held", F.col("word")) - 1
    may = blocks.filter((held >= need) & (j <= held - need)                     # length and prefix
                        & (1 + F.least(F.col("size") - F.col("at") - 1, held - j - 1) >= need))
    shared = F.array_intersect("notice", F.col("held"))
    found = (may.withColumn("shared", shared)
             .filter((F.size("shared") >= need) & (F.get("shared", F.lit(0)) == F.col("word"))))
    overlap = F.size("shared")
    return found.select("digest", "template", "label", F.col("first_word").cast("long").alias("first_word"),
                        F.size("block").alias("n_words"), overlap.alias("overlap"), "size",
                        (overlap / F.col("size")).alias("containment"),
                        F.array_join("block", " ").alias("block")).distinct()


def _places(words: Column, line: Column, phrase: Phrase) -> Column:
    """Word indexes where the phrase's words stand consecutively. ``line`` is the
    words between single spaces: texts without the phrase are told by it."""
    parts = words_in(phrase.text)
    if not parts:
        return F.array().cast("array<int>")

    def here(i):
        test = F.lit(True)
        for k, w in enumerate(parts):
            test = test & F.coalesce(F.get(words, i + k) == w, F.lit(False))
        return test

    return (F.when(F.contains(line, F.lit(f" {' '.join(parts)} ")),
                   F.filter(F.sequence(F.lit(0), F.size(words) - 1), here))
            .otherwise(F.array().cast("array<int>")))


def _labelled(label: str):
    return lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label"))


def find_phrases(docs: DataFrame, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, n_words and ``places``, an array of (start, label) in order of
    start, for every row. Places may overlap; NULL text: no words, no places."""
    texts = (_texts(docs, id_col, text_col).select("doc_id", "digest", words_of(F.col("text")).alias("words"))
             .withColumn("line", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))))
    each = [F.transform(_places(F.col("words"), F.col("line"), p), _labelled(p.label)) for p in phrases]
    empty = F.array().cast("array<struct<start:bigint,label:string>>")
    return texts.select("doc_id", "digest", F.size("words").cast("long").alias("n_words"),
                        F.array_sort(F.concat(empty, *each)).alias("places"))


def license_report(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, percent: int = PERCENT,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for
    every row; repeated rows stay rows.

    ``score``: 1 where a phrase stands, else the largest containment found, else 0.
    Labels are distinct and sorted. NULL or empty text: no words, '' and 0."""
    per_text = (find_blocks(docs, templates, percent, id_col, text_col).groupBy("digest")
                .agg(F.collect_set("label").alias("found"), F.max("containment").alias("most")))
    # read back, so that the join shuffles both sides and a text of many rows can be split
    per_text = written(docs.sparkSession, per_text, "license-blocks")
    rows = find_phrases(docs, phrases, id_col, text_col).join(per_text, "digest", "left")
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    none = F.array().cast("array<string>")
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"))


__all__ = ["Phrase", "Template", "PHRASES", "TEMPLATES", "PERCENT", "words_in", "words_of",
           "word_order", "prefix_index", "find_blocks", "find_phrases", "license_report"]
