"""Benchmark decontamination by a positional inverted index.

The index keeps, for the terms worth asking for, every place they stand at: (term, document,
position). A phrase is found by its rarest terms: their lists, each shifted by the term's offset in the
phrase, meet where the phrase would begin. What meets is compared word for word.

* Frequencies are counted over all documents, for the terms of the test texts only.
* Per window the RAREST of its terms that occur are looked up. All windows of a test text share one shifted
  list per document, so a list that is everywhere is spread like the documents are. A window is looked at where all its
  own terms meet at one beginning, a row for each, so a test text that repeats its words brings no more
  than the places where its windows meet.
* Test terms are a set in the plan while they are at most FEW_TERMS, are broadcast up to
  BROADCAST_ROWS, and are joined by shuffle beyond it.
* Besides exact matches, proximity: two of a window's terms looked up stand at most NEAR words off the
  places they have to each other. With three terms looked up, that finds every window of which one word was
  changed, left out or put in. A window with a term that no document has can only match in this way.

Nulls: a null text has no words; it and an empty text match nothing. Test rows without a word or an id
are left out; rows that repeat an id are one test item. Rows of documents are all kept, with repeated
ids and null ids. Texts of any length are taken whole. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import among, plain_words, small_side, split_words
from tidemark.sources.lake import scratch, staged

WINDOW = 10
RAREST = 3
NEAR = 8
#: Beginnings that are compared in one row.
STRETCH = 256
FEW_TERMS = 10_000
BROADCAST_ROWS = 200_000


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key and words' source text. The key is an id and text's own: rows that repeat both have
    the same matches, so they may share it."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("h"))


def test_items(items: DataFrame) -> DataFrame:
    """(item, item_id, words), one row per distinct text of an item id."""
    words = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), plain_words(F.col("text")).alias("words"))
    words = words.where(F.size("words") > 0).distinct()
    return words.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words")


def frequencies(docs: DataFrame, vocabulary: DataFrame, rows: int) -> DataFrame:
    """(term, n): occurrences in all documents of the terms of the vocabulary."""
    words = docs.select(F.explode(split_words(F.col("text"))).alias("term"))
    return among(words, "term", vocabulary, rows, FEW_TERMS, BROADCAST_ROWS).groupBy("term").agg(F.count("*").alias("n"))


def windows_of(items: DataFrame, counted: DataFrame, size: int) -> DataFrame:
    """(item, item_id, start, words, probes: offsets in the item of the window's rarest terms that occur,
    whole: whether all its terms occur), for windows with a term that does."""
    terms = items.select("item", F.posexplode("words").alias("offset", "term"))
    known = terms.join(counted, "term", "left").groupBy("item").agg(
        F.array_sort(F.collect_list(F.struct("offset", F.coalesce("n", F.lit(0)).alias("n")))).alias("known"))
    length = F.least(F.lit(size), F.size("words"))
    rows = items.join(known, "item").withColumn("length", length)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("start"))
    own = F.slice("known", F.col("start") + 1, F.col("length"))
    occur = F.filter(own, lambda x: x["n"] > 0)
    ranked = F.array_sort(F.transform(occur, lambda x: F.struct(x["n"].alias("n"), x["offset"].alias("offset"))))
    rows = rows.withColumn("whole", F.size(occur) == F.col("length")).withColumn("ranked", ranked).where("size(ranked) > 0")
    return rows.select("item", "item_id", "start", F.slice("words", F.col("start") + 1, F.col("length")).alias("words"),
                       F.transform(F.slice("ranked", 1, RAREST), lambda x: x["offset"]).alias("probes"), "whole")


def index(docs: DataFrame, terms: DataFrame, rows: int) -> DataFrame:
    """Positional inverted index of the terms: (term, doc_id, h, pos). Positions count from the first
    piece of `split_words`."""
    words = keyed(docs).select("doc_id", "h", F.posexplode(split_words(F.col("text"))).alias("pos", "term"))
    return among(words, "term", terms, rows, FEW_TERMS, BROADCAST_ROWS)


def _covered(spans: Column) -> Column:
    """Positions covered by spans (at, end), sorted by at."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["at"]))).alias("n"), F.greatest(a["end"], s["end"]).alias("end"))
    return F.aggregate(spans, start, step)["n"]


def _pairs_of_windows(windows: DataFrame) -> DataFrame:
    """(item, item_id, low, high): two offsets looked up for one window."""
    two = F.flatten(F.transform("probes", lambda a: F.transform(F.filter("probes", lambda b: b > a), lambda b: F.struct(a.alias("low"), b.alias("high")))))
    return windows.select("item", "item_id", F.explode(two).alias("p")).select("item", "item_id", "p.*").distinct()


def _lists(shifted: DataFrame, near: int, least: int) -> DataFrame:
    """(doc_id, h, item, stretch, l: beginnings in order, each with its offsets). Beginnings are kept in stretches,
    to which the first ones of the next stretch are added; stretches in which nothing meets are left out. All
    from one shuffle of the shifted lists."""
    met = shifted.repartition("doc_id", "h", "item").groupBy("doc_id", "h", "item", "begin").agg(F.collect_set("offset").alias("offsets"))
    stretch = F.floor(F.col("begin") / STRETCH).cast("int")
    own = F.when(F.pmod("begin", F.lit(STRETCH)) < near, F.array(stretch, stretch - 1)).otherwise(F.array(stretch))
    lists = met.withColumn("stretch", F.explode(own)).groupBy("doc_id", "h", "item", "stretch").agg(F.array_sort(F.collect_list(F.struct("begin", "offsets"))).alias("l"))
    return lists.where((F.size("l") > 1) | (F.size(F.col("l")[0]["offsets"]) >= min(least, 2)))


def _close_pairs(lists: DataFrame, near: int, size: int) -> DataFrame:
    """(doc_id, h, item, low, high): offsets less than `size` apart, of two words of the document, whose
    beginnings are at most `near` apart."""
    # Of different beginnings in order, at most near + 1 lie between one and `near` words on.
    after = lambda a, i: F.filter(F.slice("l", i + 1, near + 1), lambda b: b["begin"] - a["begin"] <= near)
    two = lambda a, b: F.flatten(F.transform(a["offsets"], lambda x: F.transform(
        F.filter(b["offsets"], lambda y: (x != y) & (F.abs(x - y) < size) & (a["begin"] + x != b["begin"] + y)), lambda y: F.struct(F.least(x, y).alias("low"), F.greatest(x, y).alias("high")))))
    pairs = F.flatten(F.transform("l", lambda a, i: F.flatten(F.transform(after(a, i), lambda b: two(a, b)))))
    return lists.select("doc_id", "h", "item", F.explode(F.array_distinct(pairs)).alias("p")).select("doc_id", "h", "item", "p.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, near: int = NEAR) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, h (the text's hash), n_words, n_hit (words
    inside an occurrence of a window of `size` test words), n_items, items (their ids, sorted),
    contaminated, n_near (items with a proximity match)."""
    with scratch(docs.sparkSession) as scope:
        return scope.keep(_decontaminate(docs, benchmark, size, near), "contaminated")


def _decontaminate(docs: DataFrame, benchmark: DataFrame, size: int, near: int) -> DataFrame:
    items = staged(test_items(benchmark), "items")
    vocabulary = staged(items.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    counted = staged(frequencies(docs, vocabulary, vocabulary.count()), "frequencies")
    windows = staged(windows_of(items, counted, size), "windows")
    probes = windows.select("item", F.explode("probes").alias("offset")).distinct()
    anchors = items.select("item", F.posexplode("words").alias("offset", "term")).join(probes, ["item", "offset"])
    anchors = staged(anchors, "anchors")
    terms = staged(anchors.select("term").distinct(), "terms")
    postings = staged(index(docs, terms, terms.count()), "index")

    # Shifted lists: where each test text would begin by each of its terms looked up.
    shifted = postings.join(small_side(anchors, anchors.count(), BROADCAST_ROWS), "term")
    shifted = shifted.select("doc_id", "h", "item", (F.col("pos") - F.col("offset")).alias("begin"), "offset")
    exact = windows.where("whole").select("item", "item_id", "start", "words", "probes", F.element_at("probes", 1).alias("offset"), F.size("probes").alias("n"))
    least = exact.agg(F.coalesce(F.min("n"), F.lit(2))).first()[0]
    lists = staged(_lists(shifted, near, least), "lists")
    n_windows = windows.count()

    # Exact: the windows all of whose terms looked up meet at one beginning.
    begun = lists.select("doc_id", "h", "item", F.explode("l").alias("m")).select("doc_id", "h", "item", "m.*").where(F.size("offsets") >= least)
    begun = begun.select("*", F.explode("offsets").alias("offset"))
    candidates = begun.join(small_side(exact, n_windows, BROADCAST_ROWS), ["item", "offset"])
    candidates = candidates.where(F.forall("probes", lambda p: F.array_contains("offsets", p))).where("begin + start >= 0")
    candidate = F.struct((F.col("begin") + F.col("start")).alias("at"), "words", "item_id")
    found = candidates.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("k")).agg(F.collect_set(candidate).alias("candidates"))

    # Proximity: pairs of offsets of one window, of beginnings at most `near` apart.
    pairs = _pairs_of_windows(windows)
    close = _close_pairs(lists, near, size).join(small_side(pairs, n_windows * RAREST, BROADCAST_ROWS), ["item", "low", "high"]).select("doc_id", "h", "item_id").distinct()
    close = close.groupBy(F.col("doc_id").alias("near_id"), F.col("h").alias("near_h")).agg(F.count("*").alias("n_near"))

    found = found.join(close, [F.col("id").eqNullSafe(F.col("near_id")), F.col("k") == F.col("near_h")], "full")
    found = found.select(F.coalesce("id", "near_id").alias("id"), F.coalesce("k", "near_h").alias("k"), "candidates", "n_near")

    rows = keyed(docs).join(found, [F.col("doc_id").eqNullSafe(F.col("id")), F.col("h") == F.col("k")], "left")
    rows = rows.select("doc_id", "h", split_words(F.col("text")).alias("words"), "candidates", "n_near")
    same = lambda c: F.slice(F.col("words"), c["at"] + 1, F.size(c["words"])) == c["words"]
    matched = F.filter(F.coalesce("candidates", F.expr("array()")), same)
    rows = rows.select("doc_id", "h", "n_near", F.expr("size(words) - int(words[0] = '') - int(size(words) > 1 AND words[size(words) - 1] = '')").cast("long").alias("n_words"), matched.alias("m"))
    spans = F.array_sort(F.transform("m", lambda c: F.struct(c["at"].alias("at"), (c["at"] + F.size(c["words"])).alias("end"))))
    ids = F.array_sort(F.array_distinct(F.transform("m", lambda c: c["item_id"])))
    rows = rows.select("doc_id", "h", "n_words", "n_near", F.when(F.size("m") > 0, _covered(spans)).otherwise(F.lit(0)).cast("long").alias("n_hit"), ids.alias("items"))
    return rows.select("doc_id", "h", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                       (F.col("n_hit") > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
