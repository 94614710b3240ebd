"""Operator 7: licence scan by an exact set-similarity join (native).

**Phrases.** The contract's phrases are looked for word by word; every place
counts (``n_base``).

**Templates.** A template stands where a run of consecutive words, as many as the
template's and ``SLACK`` more (or the whole text), holds at least
``CONTAINMENT`` of its distinct words, all words that set it apart, and none that
set a relative of it apart ("lesser", "affero", "nc", "sa"). Lines do not matter, so
a wrapped notice is found like one on a single line. The join is exact:

* word counts over all documents order the template words, rare ones first;
* *prefix filter*: a run that holds c of the |T| words of a template holds one of
  its |T| - c + 1 rarest, so only the words around those are joined, and
  documents without any of them are left where they are read;
* *length filter*: these words must hold c template words at all;
* *positional filter*: with the shared word at place i of the words found and j of
  the template, at most min(|B| - i, |T| - j) words can be shared;
* what is left is compared in full, run by run.

The template table is a parameter; its size does not depend on the data, so it
is broadcast. All of it is DataFrame functions.

Defined results: a null or empty text has no words, labels or places and score
0; the score is 1 for a text with a phrase, else the largest containment of a
template that stands there; equal rows get equal results; a null id is kept; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiergrain.llm.common import id_text

CONTAINMENT = 0.8
SLACK = 4              # words a run may hold besides the template's

# The contract's phrases and labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices that well-known licences ask for, with this module's labels; the words a place must
# hold and those it must not.
TEMPLATES = (
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation", "gnu", "lesser affero"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "gnu", "lesser affero"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License", "gnu lesser", "affero"),
    ("agpl", "licensed under the terms of the GNU Affero General Public License", "gnu affero", "lesser"),
    ("apache", "Licensed under the Apache License, Version 2.0", "apache", ""),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files", "granted charge", ""),
    ("mit", "Released under the MIT License", "mit license", ""),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", "redistribution forms", ""),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted", "permission granted", "charge"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla", ""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License", "creative commons",
     "noncommercial sharealike noderivatives"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc nc", ""),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc sa", ""),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work",
     "waived", ""),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered", ""),
)

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLACES = "array<int>"


def _plain(text: Column) -> Column:
    """Words of a text joined by one space.

    ``lower`` also changes letters beyond A-Z, but maps no other letter to one
    that a phrase or template could use, and no letter to a word border.
    """
    return F.trim(F.regexp_replace(F.lower(text), NO_WORD, " "))


def _words(plain: Column) -> Column:
    return F.when(plain != "", F.split(plain, " ")).otherwise(F.array().cast("array<string>"))


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _template_words(text: str) -> list[str]:
    return sorted(set(_plain_words(text)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = id_text(docs, id_col, text_col)
    return rows.select("doc_id", F.xxhash64("text").alias("key"), "text", _plain(F.col("text")).alias("plain"))


def phrase_places(docs: DataFrame, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``key``, ``n_words``, ``places`` (all word starts) and ``base`` labels."""
    rows = _rows(docs, id_col, text_col).select("doc_id", "key", "plain", _words(F.col("plain")).alias("words"))
    padded = F.concat(F.lit(" "), F.col("plain"), F.lit(" "))

    def places(phrase: str) -> Column:
        parts = phrase.split()

        def here(i: Column) -> Column:
            hit = F.get("words", i) == parts[0]
            for j, p in enumerate(parts[1:], 1):
                hit = hit & (F.get("words", i + j) == p)
            return hit

        starts = F.filter(F.sequence(F.lit(0), F.size("words") - len(parts)), here)
        return F.when(padded.contains(f" {phrase} "), starts).otherwise(F.array().cast(_PLACES))

    found = rows.select("doc_id", "key", F.size("words").alias("n_words"),
                        *[places(p).alias(f"p{i}") for i, (p, _) in enumerate(phrases)])
    labels = [F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]
    return found.select("doc_id", "key", "n_words", F.concat(*[f"p{i}" for i in range(len(phrases))]).alias("places"),
                        F.array_compact(F.array(*labels)).alias("base"))


def word_order(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """The vocabulary by its count over all documents, rare words first."""
    words = _rows(docs, id_col, text_col).select(F.explode(F.split("plain", " ")).alias("word"))
    counted = words.where(F.col("word").isin(vocabulary)).groupBy("word").agg(F.count("*").alias("n"))
    n = {r.word: r.n for r in counted.collect()}      # one row per template word at most
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def template_matches(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``key``, ``found`` labels and the largest ``containment`` of matching texts."""
    sets = [(label, _template_words(text), len(_plain_words(text)) + SLACK, must.split(), never.split())
            for label, text, must, never in templates]
    vocabulary = sorted({w for _, ws, *_ in sets for w in ws})
    rank = {w: i for i, w in enumerate(word_order(docs, vocabulary, id_col, text_col))}
    prefixes, rows = set(), []
    for label, ws, run, must, never in sets:
        tokens = sorted(ws, key=rank.__getitem__)
        need = math.ceil(containment * len(tokens) - 1e-9)
        for j in range(len(tokens) - need + 1):
            prefixes.add(tokens[j])
            rows.append((tokens[j], label, tokens, j, need, run, must, never))
    table = docs.sparkSession.createDataFrame(
        rows, "token string, label string, tokens array<string>, j int, need int, run int, must array<string>, never array<string>")
    widest = max(r[5] for r in rows)
    rare = sorted(prefixes)
    texts = _rows(docs, id_col, text_col).select("doc_id", "key", _words(F.col("plain")).alias("words"))
    texts = texts.where(F.arrays_overlap("words", F.array(*[F.lit(w) for w in rare])))

    def around(i: Column) -> Column:
        """The rare word at place i, the words near it, and its place among these."""
        first = F.greatest(i - (widest - 1), F.lit(0))
        return F.struct(F.get("words", i).alias("token"), F.slice("words", first + 1, i - first + widest).alias("near"),
                        (i - first).alias("at"))

    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(rare))
    near = texts.select("doc_id", "key", F.explode(F.transform(places, around)).alias("p")).select("doc_id", "key", "p.*")
    # the words within one run's length of the rare word
    first = F.greatest(F.col("at") - F.col("run") + 1, F.lit(0))
    cut = near.join(F.broadcast(table), "token").withColumn("near", F.slice("near", first + 1, F.col("at") - first + F.col("run")))
    shared = F.filter("tokens", lambda t: F.array_contains(F.col("near"), t))
    able = F.least(F.size("b") - F.array_position("b", F.col("token")) + 1, F.size("tokens") - F.col("j"))
    cut = cut.withColumn("b", shared).where((F.size("b") >= F.col("need")) & (able >= F.col("need")))

    def held(s: Column) -> Column:
        words = F.slice("near", s, F.col("run"))
        n = F.size(F.array_intersect(words, F.col("tokens")))
        fits = (F.size(F.array_except("must", words)) == 0) & ~F.arrays_overlap(words, F.col("never"))
        return F.when(fits, n).otherwise(0)

    runs = F.sequence(F.lit(1), F.greatest(F.size("near") - F.col("run") + 1, F.lit(1)))
    best = cut.select("doc_id", "key", "label", "need", F.size("tokens").alias("size"),
                      F.array_max(F.transform(runs, held)).alias("n")).where(F.col("n") >= F.col("need"))
    return best.groupBy("doc_id", "key").agg(F.collect_set("label").alias("found"),
                                             F.max(F.col("n") / F.col("size")).alias("containment"))


def scan_licences(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, containment: float = CONTAINMENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, places, labels and score."""
    base = phrase_places(docs, phrases, id_col, text_col).alias("d")
    found = template_matches(docs, templates, containment, id_col, text_col).alias("t")
    both = base.join(found, F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("d.key") == F.col("t.key")), "left")
    own = F.coalesce(F.col("t.found"), F.array().cast("array<string>"))
    return both.select(
        "d.doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.sort_array("base").alias("base_labels"), F.sort_array(F.array_union("base", own)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("t.containment", F.lit(0.0))).alias("score"))
