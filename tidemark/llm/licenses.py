"""License scan: which text blocks hold most words of a license template.

An exact set-similarity join of blocks and templates by containment. Template words are ordered by how
often all documents have them, rarest first. A block that holds at least `need` of a template's words
holds one of its rarest |T| - need + 1 (the prefix), so only those are looked for. Length (a block of
fewer words than needed) and position (the places that the prefix words found leave free can hold one
word each, of the need - 1 that are not in the prefix) leave out more. What is left is checked word by word.

Blocks follow the template: its stride is the least power of two that holds its words (STRIDE at least),
blocks are two strides long and begin every stride, so every stretch as long as the template is whole in one of them,
whatever its length. Template words are a set in the plan while they are at most FEW_WORDS, and a joined
table beyond that. Documents with a candidate are picked out by broadcast up to BROADCAST_DOCS and by
shuffle beyond it.

Besides, three fixed phrases are found as consecutive words. Null or empty text: no words, no labels.
Rows of documents are all kept, with null and repeated ids; rows that repeat id and text have the same
result. Texts of any length are taken whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import among, plain_words, small_side, split_words
from tidemark.sources.lake import staged

STRIDE = 32
CONTAINMENT_PERCENT = 85
FEW_WORDS = 10_000
BROADCAST_WORDS = 200_000
BROADCAST_DOCS = 200_000

#: Phrases of the fixed rule and their labels; fixed values.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Usual license notices, as their licenses give them; fixed values.
TEMPLATES = {
    "apache": ("Licensed under the Apache License, Version 2.0",
               "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by": ("licensed under a Creative Commons Attribution 4.0 International License",),
    "gpl": ("This work is licensed under the GNU General Public License, version 3",
            "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    "mit": ("Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
}


def templates_frame(spark, templates: Mapping[str, tuple[str, ...]] | DataFrame) -> DataFrame:
    """(template, label, words: distinct, stride) of the templates, given by label or as a table (label, text)."""
    if isinstance(templates, DataFrame):
        df = templates.select(F.col("label").cast("string").alias("label"), F.col("text").cast("string").alias("text")).where("label IS NOT NULL").distinct()
    else:
        df = spark.createDataFrame([(label, text) for label, texts in templates.items() for text in texts], "label string, text string")
    df = df.select(F.xxhash64("label", "text").alias("template"), "label", plain_words(F.col("text")).alias("all")).where(F.size("all") > 0)
    stride = F.greatest(F.lit(STRIDE), F.pow(F.lit(2), F.ceil(F.log2(F.size("all"))))).cast("int")
    return df.select("template", "label", F.array_distinct("all").alias("words"), stride.alias("stride"))


def _base(docs: DataFrame) -> DataFrame:
    """doc_id, h, n_words, places: array<struct<at, label>> of the phrases, for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    pieces = F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # cut like words, without lowering
    n = F.expr("size(pieces) - int(pieces[0] = '') - int(size(pieces) > 1 AND pieces[size(pieces) - 1] = '')")
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text", pieces.alias("pieces"))
    words = F.when(F.lower("text").contains("license"), plain_words(F.col("text")))
    rows = rows.select("doc_id", "h", n.cast("long").alias("n_words"), words.alias("words"))

    def place(w, i):
        found = F.lit(None).cast("struct<at:bigint,label:string>")
        for phrase, label in PHRASES.items():
            *before, last = phrase.split(" ")
            here = w == last
            for k, word in enumerate(reversed(before), 1):
                here = here & (F.get("words", i - k) == word)
            found = F.when(here, F.struct((i - len(before)).cast("long").alias("at"), F.lit(label).alias("label"))).otherwise(found)
        return found

    return rows.select("doc_id", "h", "n_words", F.array_compact(F.transform("words", place)).alias("places"))


def _in_blocks(hits: DataFrame) -> DataFrame:
    """Each hit in the two blocks of its stride that hold its place."""
    own = F.floor(F.col("pos") / F.col("stride"))
    blocks = F.when(own > 0, F.array(own, own - 1)).otherwise(F.array(own))
    return hits.withColumn("block", F.explode(blocks))


def _candidates(hits: DataFrame) -> DataFrame:
    """(doc_id, h, stride, block, template) that can hold the words needed, from the prefix words found:
    (doc_id, h, n, pos, template, stride, rank, need), n words in the document."""
    length = F.least(2 * F.col("stride"), F.col("n") - F.col("block") * F.col("stride"))
    found = _in_blocks(hits).withColumn("length", length).where("length >= need").groupBy("doc_id", "h", "stride", "block", "template", "need").agg(
        F.max("length").alias("length"), F.count("*").alias("places"), F.size(F.collect_set("rank")).alias("found"))
    return found.where("found + least(need - 1, length - places) >= need").select("doc_id", "h", "stride", "block", "template")


def scan_licenses(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] | DataFrame = TEMPLATES, percent: int = CONTAINMENT_PERCENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of docs
    (doc_id, text). The score is the largest containment of a template, and 1 where a phrase stands."""
    spark = docs.sparkSession
    known = staged(templates_frame(spark, templates), "templates")
    vocabulary = staged(known.select(F.explode("words").alias("word")).distinct(), "vocabulary")
    n_words = vocabulary.count()

    # Global order of the template words: occurrences in all documents.
    words = docs.select(F.explode(split_words(F.col("text"))).alias("word"))
    counted = among(words, "word", vocabulary, n_words, FEW_WORDS, BROADCAST_WORDS).groupBy("word").agg(F.count("*").alias("n"))
    ranks = known.select("template", F.explode("words").alias("word")).join(counted, "word", "left")
    ranks = ranks.groupBy("template").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word"))).alias("order"))
    need = F.ceil(F.lit(percent) * F.size("order") / F.lit(100)).cast("int")
    sets = known.join(ranks, "template").select("template", "label", "stride", F.transform("order", lambda x: x["word"]).alias("members"), need.alias("need"))
    sets = staged(sets, "sets")
    prefix = F.slice("members", F.lit(1), F.size("members") - F.col("need") + 1)
    probes = staged(sets.select("template", "stride", "need", F.posexplode(prefix).alias("rank", "word")), "probes")
    rarest = probes.select("word").distinct()

    keyed = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    split = keyed.select("doc_id", "h", split_words(F.col("text")).alias("words"))
    hits = split.select("doc_id", "h", F.size("words").alias("n"), F.posexplode("words").alias("pos", "word"))
    hits = among(hits, "word", rarest, n_words, FEW_WORDS, BROADCAST_WORDS).join(small_side(probes, probes.count(), BROADCAST_WORDS), "word")
    candidates = staged(_candidates(hits), "candidates")

    # The words of candidate blocks, and how many of them are the template's.
    wanted = candidates.select(F.col("doc_id").alias("d"), F.col("h").alias("k")).distinct()
    wanted = staged(wanted, "wanted")
    same = [F.col("doc_id").eqNullSafe(F.col("d")), F.col("h") == F.col("k")]
    chosen = keyed.join(small_side(wanted, wanted.count(), BROADCAST_DOCS), same, "left_semi")
    found = chosen.select("doc_id", "h", F.posexplode(split_words(F.col("text"))).alias("pos", "word"))
    found = among(found, "word", vocabulary, n_words, FEW_WORDS, BROADCAST_WORDS)
    # A power of two for each length of templates, so a few strides.
    strides = [r.stride for r in sets.select("stride").distinct().collect()]
    found = found.withColumn("stride", F.explode(F.array(*[F.lit(x) for x in strides]) if strides else F.array().cast("array<int>")))
    held = _in_blocks(found).groupBy("doc_id", "h", "stride", "block").agg(F.collect_set("word").alias("held"))
    held = held.select(F.col("doc_id").alias("d"), F.col("h").alias("k"), F.col("stride").alias("s"), F.col("block").alias("b"), "held")
    checked = candidates.join(held, [F.col("doc_id").eqNullSafe(F.col("d")), F.col("h") == F.col("k"), F.col("stride") == F.col("s"), F.col("block") == F.col("b")])
    n_templates = sets.count()
    checked = checked.join(small_side(sets.drop("stride"), n_templates, BROADCAST_WORDS // 1000), "template").withColumn("common", F.size(F.array_intersect("held", "members")))
    matched = checked.where("common >= need").groupBy(F.col("doc_id").alias("d"), F.col("h").alias("k")).agg(
        F.collect_set("label").alias("found"), F.max(F.col("common") / F.size("members")).alias("best"))

    rows = _base(docs).join(small_side(matched, wanted.count(), BROADCAST_DOCS), same, "left")
    none = F.array().cast("array<string>")
    base_labels = F.coalesce(F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"]))), none)
    at = F.transform("places", lambda p: p["at"])
    n_base = F.coalesce(F.size("places"), F.lit(0)).cast("long")
    rows = rows.withColumn("n_base", F.when(F.col("places").isNull(), F.lit(0).cast("long")).otherwise(n_base))
    return rows.select(
        "doc_id", "n_words", "n_base", F.when(F.col("n_base") > 0, F.array_min(at)).alias("first_word"), F.when(F.col("n_base") > 0, F.array_max(at)).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
