"""License texts by diagonal voting, in DataFrame operations only.

All rolling word 2-grams of all texts are hashed and joined to the positions
of the same 2-grams in the templates. A hit votes for its diagonal (document
position minus template position); votes are summed per (document, template,
diagonal) before they are shuffled. Neighbouring diagonals (words inserted or
left out) are merged, and a merged span is verified: the share of the
template's 2-grams that it holds must reach the template's threshold.

The base phrases are templates whose every 2-gram must stand on one diagonal,
so their places are exact up to a 64-bit hash collision with one of some hundred template
2-grams (odds of about 1e-17 per word).

The template table is fixed (a parameter), hence its broadcast is bounded;
a template has at most 64 words, so the 2-grams seen fit one 64-bit mask.

Defined results: one row per document, that is per doc_id and text (a hash of
the text is part of the key, so documents that share an id, or have none, are
judged apart); null and empty texts have no words, no labels and score 0; equal
rows count once; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ALNUM_SEPARATORS, ALNUM_TABLE, start, utf8

# Phrases and labels of the contract.
BASE_PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

# Notices as their publishers word them.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                   "GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
)

MAX_WORDS = 64


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    exact: bool

    @property
    def grams(self) -> int:
        return len(self.words) - 1


def template(label: str, text: str, exact: bool = False) -> Template:
    words = tuple(w.decode() for w in utf8(text).translate(ALNUM_TABLE).split())
    if not 2 <= len(words) <= MAX_WORDS or not all(re.fullmatch(r"[a-z0-9]+", w) for w in words):
        raise ValueError(f"a template has 2 to {MAX_WORDS} plain words")
    return Template(label, words, exact)


BASE = tuple(template(label, text, True) for label, text in BASE_PHRASES)
TEMPLATES = (*BASE, *(template(label, text) for label, text in NOTICES))

#: Share of a template's 2-grams that a span must hold.
THRESHOLD = 0.75
#: Diagonals this close belong to one span: so many words inserted or left out.
MERGE_GAP = 3


def _template_grams(templates: tuple[Template, ...]) -> Column:
    """Array of (template, position, words of the 2-gram). Template -1 marks
    the row that every document has."""
    rows = [(-1, 0, "", "")] + [(t, p, a, b) for t, x in enumerate(templates)
                                for p, (a, b) in enumerate(zip(x.words, x.words[1:]))]
    return F.array(*(F.struct(F.lit(t).alias("template"), F.lit(p).alias("place"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                     for t, p, a, b in rows))


def license_spans(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
                  threshold: float = THRESHOLD, gap: int = MERGE_GAP) -> DataFrame:
    """Verified spans and one marker row (template -1) per document: doc_id,
    th (a hash of the text), n_words, template, begin, finish (words, inclusive), share."""
    spark = start(docs.sparkSession)
    grams = (spark.range(1).select(F.explode(_template_grams(templates)).alias("g")).select("g.*")
             .withColumn("h", F.xxhash64("a", "b")))
    # Lower-casing beyond A-Z is harmless: templates are ASCII, and the only
    # letter that becomes ASCII (the Kelvin sign) is taken out first.
    lowered = F.lower(F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(F.col("text").cast("string")).alias("th"),
                        F.array_remove(F.split(lowered, ALNUM_SEPARATORS), "").alias("w"))
    hashed = words.select("doc_id", "th", F.size("w").cast("long").alias("n_words"),
                          F.concat(F.array(F.xxhash64(F.lit(""), F.lit(""))),
                                   F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1)))).alias("h"))
    # entry 0 is the marker; entry i + 1 is the 2-gram at word i. The array is
    # never empty; the outer form keeps the planner from filtering on its size,
    # which would split the text again for every word.
    places = hashed.select("doc_id", "th", "n_words", F.posexplode_outer("h").alias("at", "h"))
    hits = (places.join(F.broadcast(grams), "h").where((F.col("template") < 0) == (F.col("at") == 0))
            .select("doc_id", "th", "n_words", "template", "place", (F.col("at") - 1).cast("long").alias("word")))
    one = F.lit(1).cast("long")
    votes = (hits.withColumn("diagonal", F.col("word") - F.col("place"))
             .groupBy("doc_id", "th", "template", "diagonal")
             .agg(F.max("n_words").alias("n_words"), F.min("word").alias("lo"), F.max("word").alias("hi"),
                  F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask")))
    exact = F.element_at(F.array(*(F.lit(t.exact) for t in templates)), F.greatest(F.col("template") + 1, F.lit(1)))
    total = F.element_at(F.array(*(F.lit(t.grams) for t in templates)), F.greatest(F.col("template") + 1, F.lit(1)))
    # a single vote on a longer template is noise that would chain diagonals
    votes = (votes.withColumn("exact", exact).withColumn("total", total)
             .where((F.col("template") < 0)
                    | F.col("exact") & (F.bit_count("mask") == F.col("total"))
                    | ~F.col("exact") & ((F.bit_count("mask") >= 2) | (F.col("total") <= 2))))
    by = Window.partitionBy("doc_id", "th", "template").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(by) > gap)
    spans = (votes.withColumn("new", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0))
             .withColumn("island", F.sum("new").over(by))
             .groupBy("doc_id", "th", "template", "island")
             .agg(F.max("n_words").alias("n_words"), F.min("lo").alias("begin"), (F.max("hi") + one).alias("finish"),
                  F.bit_or("mask").alias("mask"), F.max("total").alias("total")))
    share = F.bit_count("mask") / F.col("total")
    return (spans.withColumn("share", F.least(share, F.lit(1.0)))
            .where((F.col("template") < 0) | (F.col("share") >= threshold))
            .select("doc_id", "th", "n_words", "template", "begin", "finish", "share"))


def license_report(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
                   threshold: float = THRESHOLD, gap: int = MERGE_GAP) -> DataFrame:
    """One row per document: n_words, base places and their first and last
    start, base labels, all labels, score (the best share of any template)."""
    spans = license_spans(docs, templates, threshold, gap)
    of = F.greatest(F.col("template") + 1, F.lit(1))
    label = F.element_at(F.array(*(F.lit(t.label) for t in templates)), of)
    base = (F.col("template") >= 0) & F.element_at(F.array(*(F.lit(t.exact) for t in templates)), of)
    names = lambda when: F.array_join(F.sort_array(F.collect_set(F.when(when, label))), ",")
    return spans.groupBy("doc_id", "th").agg(
        F.max("n_words").alias("n_words"), F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("begin"))).alias("first_word"), F.max(F.when(base, F.col("begin"))).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("template") >= 0).alias("labels"),
        F.max(F.when(F.col("template") >= 0, F.col("share")).otherwise(0.0)).alias("score")).drop("th")
