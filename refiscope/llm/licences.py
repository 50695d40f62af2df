"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

Blocks are the lines of a text and, for each length of a template, the words on both sides of every line
end inside a paragraph as far as a template of that length reaches, so a statement that is wrapped over
lines lies in one block. A blank line ends a paragraph.

Tokens are ordered by the number of documents that hold them, rare first, over the whole corpus. A
block that shares at least ``threshold`` of a template's tokens must hold one of the template's
first ``size - needed + 1`` tokens in that order (prefix filter), must have enough tokens (length
filter) and enough of both sides must be left after the shared token (positional filter). Blocks and
templates meet in an equi-join on prefix tokens; what passes the filters is verified by counting.

Every text is cut into words once: word count, phrases, the templates' tokens it holds and, where these
could make up a template, those of its blocks are kept, and all else works on them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .base import ascii_lower, keyed

#: Word characters: digits, letters a-z (and A-Z, for texts that aren't lower-cased yet) and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What parts paragraphs.
BLANK_LINE = r"\n[ \t\r]*\n"

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences by which licenses are commonly stated.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)


def words(text: Column) -> Column:
    """Of a lower-cased text."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def template_tokens(templates: Sequence[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    return [(label, sorted(set(re.findall(WORD, text.lower())))) for label, text in templates]


def reach(text: str) -> int:
    """Words that a statement of a template can have on one side of a line end."""
    return max(len(re.findall(WORD, text.lower())) - 1, 1)


def _needed(tokens: Sequence[str], threshold: float) -> int:
    return math.ceil(threshold * len(tokens) - 1e-9)


def block_tokens(text: Column, vocabulary: Column, sides: Sequence[int], least: int) -> Column:
    """side (0 for a line) and the vocabulary's tokens of each block of a lower-cased text that holds at least ``least`` of them."""

    def blocks(lines: Column, ends: Column, side: int) -> Column:
        held = F.transform(ends, lambda i: F.array_intersect(vocabulary, _around(lines, i, side)))
        return F.transform(F.filter(held, lambda w: F.size(w) >= least), lambda w: F.struct(F.lit(side).alias("side"), w.alias("held")))

    def of_paragraph(lines: Column) -> Column:
        # Lines hold a word at least, so ``side`` lines on either side hold enough words.
        ends = F.when(F.size(lines) > 1, F.sequence(F.lit(1), F.size(lines) - 1)).otherwise(F.array().cast("array<int>"))
        own = F.transform(lines, lambda w: F.struct(F.lit(0).alias("side"), F.array_intersect(vocabulary, w).alias("held")))
        return F.concat(F.filter(own, lambda w: F.size(w["held"]) >= least), *[blocks(lines, ends, side) for side in sides])

    lines = F.transform(F.split(text, BLANK_LINE), lambda p: F.filter(F.transform(F.split(p, "\n"), words), lambda w: F.size(w) > 0))
    return F.array_distinct(F.flatten(F.transform(lines, of_paragraph)))


def _around(lines: Column, i: Column, side: int) -> Column:
    """Up to ``side`` words before the end of line ``i`` (from 1) and as many after it."""
    before = F.flatten(F.slice(lines, F.greatest(i - side + 1, F.lit(1)), F.least(i, F.lit(side))))
    after = F.flatten(F.slice(lines, i + 1, side))
    return F.concat(F.reverse(F.slice(F.reverse(before), 1, side)), F.slice(after, 1, side))


def frequency_order(held: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """The vocabulary by the number of documents with the token, rare first, ties by the token.

    ``held``: the vocabulary's tokens of each document.
    """
    counts = held.select(F.explode("held").alias("token")).groupBy("token").count().collect()  # one row a token of the templates
    found = {r["token"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda t: (found.get(t, 0), t))


def template_matches(
    facts: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = 0.8
) -> DataFrame:
    """``facts``: k1, k2, ``held`` and ``blocks`` per document. k1, k2, label, score for every block that holds
    at least ``threshold`` of a template's tokens; the best score per label."""
    sets = template_tokens(templates)
    order = frequency_order(facts, sorted({t for _, tokens in sets for t in tokens}))
    place = {t: i for i, t in enumerate(order)}
    rows = []
    for (label, tokens), (_, text) in zip(sets, templates, strict=True):
        tokens = sorted(tokens, key=place.get)
        needed = _needed(tokens, threshold)
        for i, t in enumerate(tokens[: len(tokens) - needed + 1]):
            rows.append((label, t, i, needed, tokens, reach(text)))
    index = facts.sparkSession.createDataFrame(rows, "label string, token string, i int, needed int, tokens array<string>, reach int")

    blocks = facts.where(F.size("blocks") > 0).select("k1", "k2", F.explode("blocks").alias("block"))
    blocks = blocks.select("k1", "k2", "block.side", F.array_intersect(_strings(order), F.col("block.held")).alias("own"))
    probes = blocks.select("k1", "k2", "side", "own", F.posexplode("own").alias("j", "token"))
    pairs = probes.join(index, "token").where("side in (0, reach)").where(F.size("own") >= F.col("needed"))
    left_over = F.least(F.size("tokens") - F.col("i"), F.size("own") - F.col("j"))
    pairs = pairs.where(F.least("i", "j") + left_over >= F.col("needed"))
    shared = F.size(F.array_intersect("own", "tokens"))
    verified = pairs.where(shared >= F.col("needed")).withColumn("score", shared / F.size("tokens"))
    return verified.groupBy("k1", "k2", "label").agg(F.max("score").alias("score"))


def _places(own: Column, phrase: str) -> Column:
    """Starts, from 0, of the phrase's words in an array of words."""
    parts = phrase.split(" ")
    at = F.sequence(F.lit(0), F.size(own) - len(parts))

    def here(i: Column) -> Column:
        test = F.lit(True)
        for k, part in enumerate(parts):
            test = test & (F.element_at(own, i + k + 1) == part)
        return test

    return F.when(F.array_contains(own, parts[-1]) & (F.size(own) >= len(parts)), F.filter(at, here)).otherwise(F.array().cast("array<int>"))


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.8,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    Null texts count as empty: no words, no labels, score 0. Repeated rows stay; other columns are
    not read. The score is 1 with a phrase, else the best template containment that reaches the
    threshold, else 0.
    """
    named = keyed(docs, doc_id, text)
    sets = template_tokens(templates)
    vocabulary = _strings(sorted({t for _, tokens in sets for t in tokens}))
    lower = named.select("doc_id", "k1", "k2", ascii_lower(F.col("text")).alias("text"))
    cut = lower.select("doc_id", "k1", "k2", "text", words(F.col("text")).alias("own"))
    cut = cut.select("*", F.array_intersect(vocabulary, F.col("own")).alias("held"))
    # A block holds no more of a template than its document does.
    able = F.lit(False)
    for _, tokens in sets:
        able = able | (F.size(F.array_intersect(F.col("held"), _strings(tokens))) >= _needed(tokens, threshold))
    least = min([_needed(tokens, threshold) for _, tokens in sets], default=1)
    sides = sorted({reach(t) for _, t in templates})
    blocks = F.when(able, block_tokens(F.col("text"), vocabulary, sides, least))
    facts = stage(cut.select(
        "doc_id", "k1", "k2", F.size("own").cast("bigint").alias("n_words"), "held", blocks.alias("blocks"),
        *[_places(F.col("own"), p).alias(f"p{i}") for i, p in enumerate(phrases)]), "license-facts")
    starts = F.concat(*[F.col(f"p{i}") for i in range(len(phrases))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, label) for i, label in enumerate(phrases.values())]))
    based = facts.select(
        "doc_id", "k1", "k2", "n_words", F.size(starts).cast("bigint").alias("n_base"), F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"), F.array_sort(F.array_distinct(labels)).alias("base"))
    found = template_matches(facts, templates, threshold)
    found = stage(found.groupBy("k1", "k2").agg(F.collect_set("label").alias("more"), F.max("score").alias("best")), "license-matches")
    joined = based.join(found, ["k1", "k2"], "left")
    every = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"), score.alias("score"))
