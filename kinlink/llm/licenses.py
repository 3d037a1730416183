"""License scans: an exact set-similarity join, in DataFrame expressions only.

A block is a line of a text; with ``wrapped`` also each run of consecutive words
over line ends, a quarter longer than a template, that holds enough of it.  A template matches a block where the block holds
at least ``threshold`` of the template's distinct words.  Blocks are joined with
templates by prefix filtering: the words of templates are put in one global
order, rarest in the corpus first; a match needs a common word among the first
``|T| - o + 1`` words of the template (o: the words it needs) and the like of the
block.  Blocks with fewer template words than o fall out before (length
filter), as do pairs whose common word leaves too few words after it on either
side (positional filter).  What is left is verified; no match is lost.

Besides, phrases are counted where their words stand next to each other.

Only words of templates leave a document, in a narrow table; texts are never
shuffled.  Templates are constants, so what is broadcast is bounded by them.

Defined results: null texts are empty; rows are known by id and text, so equal
rows get equal results; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import ascii_lower, stored

#: The phrases of the contract and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Label and wording of well-known public licence notices.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

BETWEEN = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"  # what is no word, but for line ends


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())))


def window_size(text: str) -> int:
    """Words of a run that may hold a template: its own, and a quarter for words put in between."""
    n = len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))
    return n + n // 4


def needed(n: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * n - 1e-9))


def places(words: Column, phrases: dict[str, str]) -> Column:
    """Each place where a phrase begins: struct(i, label)."""
    def of(phrase: str, label: str) -> Column:
        head, *rest = phrase.split()

        def here(w: Column, i: Column) -> Column:
            test = w == head
            for j, word in enumerate(rest, 1):
                test = test & F.coalesce(F.get(words, i + j) == word, F.lit(False))
            return F.when(test, F.struct(i.alias("i"), F.lit(label).alias("label")))

        return F.filter(F.transform(words, here), lambda x: x.isNotNull())

    return F.concat(*(of(p, x) for p, x in phrases.items()))


def windows(words: Column, known: Column, own: Column, template: list[str], size: int, o: int) -> Column:
    """The distinct blocks of runs of ``size`` words that begin with a word of the template and hold ``o`` or more; none is built where the text lacks them."""
    t = F.array(*map(F.lit, template))
    starts = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(t, w), i + 1)), lambda i: i.isNotNull())
    runs = F.filter(F.transform(starts, lambda i: F.slice(words, i, F.lit(size))), lambda x: F.size(F.array_intersect(t, x)) >= o)
    some = F.array_distinct(F.transform(runs, lambda x: F.array_intersect(own, x)))
    return F.when(F.size(F.array_intersect(t, known)) >= o, some).otherwise(F.array().cast("array<array<string>>"))


def scanned(docs: DataFrame, phrases: dict[str, str], vocabulary: list[str], least: int, wrapped: list[tuple[list[str], int, int]] = ()) -> DataFrame:
    """doc_id, th, n_words, found (places of phrases) and blocks (their words of the vocabulary, if ``least`` or more); wrapped: words, window size and words needed of templates that may span lines."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.regexp_replace(ascii_lower(F.coalesce("text", F.lit(""))), BETWEEN, " ").alias("t"))
    rows = rows.withColumn("words", F.array_remove(F.split(F.translate("t", "\n", " "), " "), ""))
    rows = rows.withColumn("line", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    some = F.lit(False)
    for p in phrases:
        some = some | F.contains(F.col("line"), F.lit(f" {p} "))
    own = F.array(*map(F.lit, vocabulary))
    blocks = F.filter(F.transform(F.split("t", "\n"), lambda x: F.array_intersect(own, F.split(x, " "))), lambda b: F.size(b) >= least)
    if wrapped:
        rows = rows.withColumn("known", F.array_intersect(own, "words"))
        blocks = F.concat(blocks, *(windows(F.col("words"), F.col("known"), own, t, size, o) for t, size, o in wrapped))
    none = F.array().cast("array<struct<i:int,label:string>>")
    return rows.select("doc_id", "th", F.size("words").cast("long").alias("n_words"), F.when(some, places(F.col("words"), phrases)).otherwise(none).alias("found"), blocks.alias("blocks"))


def matches(rows: DataFrame, templates: list[tuple[str, list[str]]], threshold: float) -> DataFrame:
    """doc_id, th, label, containment: the best containment of each label in a block of the document."""
    spark = rows.sparkSession
    blocks = rows.select("doc_id", "th", F.posexplode("blocks").alias("block", "words"))
    seen = {r["word"]: r["count"] for r in blocks.select(F.explode("words").alias("word")).groupBy("word").count().collect()}  # words of templates only
    order = sorted({w for _, t in templates for w in t}, key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    least = min(needed(len(t), threshold) for _, t in templates)
    prefixes, whole = [], []
    for k, (label, t) in enumerate(templates):
        codes, o = sorted(rank[w] for w in t), needed(len(t), threshold)
        prefixes += [(c, k, at, len(codes), o) for at, c in enumerate(codes[: len(codes) - o + 1])]
        whole.append((k, label, codes))
    heads = spark.createDataFrame(prefixes, "code int, template int, t_at int, t_size int, o int")
    texts = spark.createDataFrame(whole, "template int, label string, t_codes array<int>")
    code = F.create_map(*(x for w, i in rank.items() for x in (F.lit(w), F.lit(i))))
    coded = blocks.withColumn("codes", F.sort_array(F.transform("words", lambda w: F.element_at(code, w))))
    probes = coded.select("doc_id", "th", "block", "codes", F.posexplode(F.slice("codes", 1, F.size("codes") - least + 1)).alias("at", "code"))
    pairs = probes.join(F.broadcast(heads), "code").filter((F.size("codes") >= F.col("o")) & (1 + F.least(F.col("t_size") - F.col("t_at") - 1, F.size("codes") - F.col("at") - 1) >= F.col("o")))
    near = pairs.join(F.broadcast(texts), "template").withColumn("common", F.size(F.array_intersect("codes", "t_codes"))).filter(F.col("common") >= F.col("o"))
    return near.groupBy("doc_id", "th", "label").agg(F.max(F.col("common") / F.col("t_size")).alias("containment"))


def scan(docs: DataFrame, threshold: float = 0.8, templates=TEMPLATES, phrases: dict[str, str] = PHRASES, wrapped: bool = False) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels and labels (arrays), score."""
    cut = [(label, template_words(text)) for label, text in templates]
    vocabulary = sorted({w for _, t in cut for w in t})
    spans = [(t, window_size(text), needed(len(t), threshold)) for (_, t), (_, text) in zip(cut, templates, strict=True)] if wrapped else []
    rows = stored(scanned(docs, phrases, vocabulary, min(needed(len(t), threshold) for _, t in cut), spans), "license-words")
    own = matches(rows, cut, threshold).groupBy("doc_id", "th").agg(F.collect_set("label").alias("own"), F.max("containment").alias("containment")).toDF("__id", "__th", "own", "containment")
    joined = rows.drop("blocks").join(own, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), "left")
    starts, base = F.transform("found", lambda x: x.i.cast("long")), F.array_sort(F.array_distinct(F.transform("found", lambda x: x.label)))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("found").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, F.coalesce("own", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("found") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
