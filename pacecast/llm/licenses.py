"""License scans by an exact set-similarity join (operator 11), DataFrame and SQL functions only.

Templates are license notices; a text's blocks are its sentences and lines. A block holds a template
if at least ``share`` of the template's distinct words occur in it. The join finds every such pair:

1. Words of the templates are counted over all documents, and every set is put in the global order of
   these counts, rarest first. Words of no template change no overlap and are left out.
2. Prefix filter: a pair that shares o words shares one among the first |T| - o + 1 of the template and the
   first |B| - o + 1 of the block. Blocks that hold no template's prefix word go at once; the others'
   prefix words are joined with those of the templates (a table bounded by the template list).
3. Length filter: a block needs as many words as the template's overlap. Positional filter: what
   both sets still have from the shared word on must reach the overlap.
4. The surviving pairs are confirmed on the full sets.

Sentences of more than ``BLOCK_WORDS`` words are cut into blocks of that size that overlap by half, so
any passage of up to half a block lies in one block whole and far-apart words don't add up to a
notice. Beside the templates, fixed phrases are looked up word by word with their places.

Only A-Z are lower-cased. A null or empty text has no words, no labels and score 0. Ids may be null or
repeat: rows are told apart by a number of their own, repeated rows get a result each. An
empty table gives an empty table. Work inside a text is one row's; nothing is grouped by a
word, so neither a frequent word nor a group of copies is a hot key.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import others, stored

#: A word: ASCII letters and digits and all characters beyond ASCII. The Java matcher tests a class's
#: ranges in turn, so the frequent letters come first and nothing is negated.
WORD = r"[a-z0-9A-Z\x{80}-\x{10FFFF}]+"
#: Ends of sentences and lines.
BLOCK_END = r"[.!?][\x20\x09-\x0D]+|[\x0A-\x0D]+"
BLOCK_WORDS = 100
SHARE = 0.9

# Phrases whose places count, and their labels (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Sentences of widely used public licenses and the notices that name them (fixed values).
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions "
            "and the following disclaimer"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("no-warranty", "The software is provided as is, without warranty of any kind, express or implied"),
]


def lowered(text: Column) -> Column:
    """Lower case as far as words of ASCII letters go.

    Of all other characters, lower case turns only the Kelvin sign and the dotted capital I into ASCII
    letters; these two are put out of the way first. It never changes where a word ends.
    """
    for sign in ("K", "İ"):
        text = F.replace(text, F.lit(sign), F.lit("ß"))
    return F.lower(text)


def words(text: Column) -> Column:
    """The words of a lower-cased text (null: none)."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _template_words(text: str) -> list[str]:
    """Distinct words of an ASCII template."""
    plain = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
    return list(dict.fromkeys(plain.split()))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def blocks(text: Column) -> Column:
    """Word lists of a lower-cased text's sentences and lines, long ones cut into overlapping blocks."""
    half = BLOCK_WORDS // 2

    def cut(found: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(found) - half - 1, F.lit(0)), F.lit(half))
        pieces = F.transform(starts, lambda s: F.slice(found, s + 1, F.lit(BLOCK_WORDS)))
        return F.when(F.size(found) > BLOCK_WORDS, pieces).otherwise(F.array(found))

    found = F.transform(F.split(text, BLOCK_END), lambda part: words(part))
    return F.flatten(F.transform(found, cut))


def word_order(docs: DataFrame, text_col: str, templates: list[tuple[str, str]]) -> list[str]:
    """All words of the templates by their number of occurrences in the documents, rarest first."""
    known = sorted({w for _, text in templates for w in _template_words(text)})
    counts = (docs.select(F.explode(words(lowered(F.col(text_col)))).alias("word"))
              .where(F.col("word").isin(known)).groupBy("word").count())
    found = {r["word"]: r["count"] for r in counts.collect()}  # at most as many rows as template words
    return sorted(known, key=lambda w: (found.get(w, 0), w))


def _places(found: Column, phrase: str, label: str) -> Column:
    """(label, start) of a phrase in a word list, words from 0."""
    parts = phrase.split()
    starts = F.sequence(F.lit(1), F.size(found) - len(parts) + 1)
    here = F.filter(starts, lambda at: reduce(and_, [F.element_at(found, at + k) == w for k, w in enumerate(parts)]))
    fits = (F.size(found) >= len(parts)) & F.array_contains(found, parts[-1])
    at = F.when(fits, here).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda start: F.struct(F.lit(label).alias("label"), (start - 1).alias("start")))


def scan(docs: DataFrame, text_col: str = "text", templates: list[tuple[str, str]] | None = None,
         phrases: dict[str, str] | None = None, share: float = SHARE, keep: list[str] | None = None) -> DataFrame:
    """One row per document: n_words, places, matches, base_labels, labels, score and the columns of ``keep``.

    ``places`` are (label, start) of every phrase, ``matches`` the (template, label, containment, block) of
    every block that holds a template's words to ``share`` or more (blocks count from 0). ``score`` is the
    largest containment found, 1 where a phrase stands and 0 without any.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    new = ("n_words", "places", "matches", "base_labels", "labels", "score")
    keep = [c for c in others(docs, *new) if c in (keep or ())]
    order = word_order(docs, text_col, templates)
    rank = {w: k for k, w in enumerate(order)}
    sets = [sorted(_template_words(text), key=rank.__getitem__) for _, text in templates]
    # whole words, in exact arithmetic: the least overlap that reaches the share
    need = [max(1, math.ceil(round(share * len(s), 9))) for s in sets]
    least = min(need)
    prefixes = [(k, s[i], i, o) for k, (s, o) in enumerate(zip(sets, need, strict=True)) for i in range(len(s) - o + 1)]
    rare = _strings(sorted({p[1] for p in prefixes}, key=rank.__getitem__))
    base = docs.select(*[F.col(f"`{c}`").alias(f"k_{c}") for c in keep], lowered(F.col(text_col)).alias("_text"))
    worded = base.withColumn("_words", words(F.col("_text")))
    # the blocks' template words in global order; most texts hold no prefix word at all
    ordered = F.transform(blocks(F.col("_text")), lambda b: F.array_intersect(_strings(order), b))
    numbered = F.transform(ordered, lambda b, i: F.struct(i.alias("block"), b.alias("set")))
    held = F.filter(numbered, lambda b: (F.size(b["set"]) >= least) & F.arrays_overlap(b["set"], rare))
    places = F.concat(*[_places(F.col("_words"), phrase, label) for phrase, label in phrases.items()])
    rows = stored(worded.select(
        *[f"k_{c}" for c in keep], F.monotonically_increasing_id().alias("_row"),
        F.size("_words").cast("long").alias("n_words"), places.alias("places"),
        F.when(F.arrays_overlap("_words", rare), held).alias("_blocks")), "licenses-blocks")
    # the join: block prefixes against template prefixes
    block = rows.select("_row", F.explode("_blocks").alias("b")).select("_row", "b.block", "b.set")
    probe = block.select("_row", "block", "set", F.posexplode(
        F.slice("set", F.lit(1), F.size("set") - (least - 1))).alias("j", "word"))
    table = docs.sparkSession.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(k).alias("template"), F.lit(templates[k][0]).alias("label"), F.lit(word).alias("word"),
        F.lit(i).alias("i"), F.lit(o).alias("need"), _strings(sets[k]).alias("words")) for k, word, i, o in prefixes])))
    both = probe.join(F.broadcast(table), "word").withColumn("size", F.size("words"))
    pairs = both.where(
        (F.size("set") >= F.col("need")) & (F.col("j") <= F.size("set") - F.col("need"))
        & (F.least(F.col("size") - F.col("i"), F.size("set") - F.col("j")) >= F.col("need"))
    ).withColumn("_shared", F.size(F.array_intersect("set", "words"))).where("_shared >= need")
    match = F.struct("template", "label", (F.col("_shared") / F.col("size")).alias("containment"), "block")
    found = pairs.groupBy("_row").agg(F.sort_array(F.collect_set(match)).alias("matches"))
    empty = F.array().cast("array<struct<template:int,label:string,containment:double,block:int>>")
    out = rows.drop("_blocks").join(found, "_row", "left").withColumn("matches", F.coalesce("matches", empty))
    base_labels = F.array_sort(F.array_distinct("places.label"))
    best = F.coalesce(F.array_max("matches.containment"), F.lit(0.0))
    return out.select(
        *[F.col(f"k_{c}").alias(c) for c in keep], "n_words", "places", "matches", base_labels.alias("base_labels"),
        F.array_sort(F.array_union(base_labels, F.array_distinct("matches.label"))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"))
