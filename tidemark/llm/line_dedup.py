"""Line dedup by a deletion-neighbourhood join.

A line goes if an earlier line, of the same or any other document, equals it or is one edit away: one
character put in, left out or changed. Lines under MIN_CHARS characters go only if equal; blank lines
stay. Earlier is by doc_id (null last), the text's hash, then place in the text.

* Equal lines are one distinct line with its earliest place, aggregated before the shuffle.
* Two lines one edit apart agree in the first or in the last half of the shorter one. Lines that share
  no half with another line need no variants.
* The others emit every variant with one character left out, as a hash, and themselves. With the place
  that was left out, equal variants are lines that differ in just that character; a variant equal to a
  whole line is one character longer. So the earliest partner of a line is a minimum per key: groups of
  any size are aggregated, and never listed or paired.
* That partner is verified by the edit distance of the two lines.

Null text: no lines, and it stays null. Rows that repeat id and text are one document, and have the same
result. Lines and texts of any length are taken whole. Other columns are kept by `dedup_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import small_side
from tidemark.sources.lake import staged

MIN_CHARS = 12
BROADCAST_DOCS = 200_000
BROADCAST_VARIANTS = 1_000_000


def _place() -> Column:
    """Order of lines: comparable, the earliest is the least."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "line")


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]


def _half_keys(text: Column, n: Column) -> Column:
    def of(h):
        return F.array(F.xxhash64(F.lit("head"), h, F.substring(text, F.lit(1), h)), F.xxhash64(F.lit("tail"), h, F.substring(text, n - h + 1, h)))

    halves = F.array_distinct(F.array(F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")))
    return F.when(n >= MIN_CHARS - 1, F.flatten(F.transform(halves, of)))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h, removed: places of the lines that go) of documents that lose a line."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    lines = keyed.select("doc_id", "h", F.posexplode(F.split("text", "\n")).alias("line", "content")).where(F.trim(F.translate("content", "\t\x0b\x0c\r", "    ")) != "")
    k1, k2 = _keys(F.col("content"))
    lines = lines.withColumns({"place": _place(), "k1": k1, "k2": k2, "n": F.char_length("content")})
    places = staged(lines.select("place", "k1", "k2"), "lines")
    halves = _half_keys(F.col("content"), F.col("n"))
    distinct = lines.select("place", "k1", "k2", "n", halves.alias("halves")).groupBy("k1", "k2")
    distinct = staged(distinct.agg(F.min("place").alias("first"), F.min("n").alias("n"), F.min("halves").alias("halves")), "distinct-lines")

    # Lines that share a half with another line.
    halves = distinct.where(f"n >= {MIN_CHARS}").select("k1", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low < high")
    live = halves.join(shared.select("half"), "half", "left_semi").select("k1").distinct()
    live = distinct.join(live, "k1", "left_semi").where(f"n >= {MIN_CHARS}").select("first.*", "n")
    live = staged(live.groupBy("doc_id", "h").agg(F.collect_list(F.col("line")).alias("wanted")), "live")
    live = live.select(F.col("doc_id").alias("d"), F.col("h").alias("k"), "wanted")
    same = [F.col("doc_id").eqNullSafe(F.col("d")), F.col("h") == F.col("k")]
    held = keyed.join(small_side(live, live.count(), BROADCAST_DOCS), same).select("doc_id", "h", "wanted", F.split("text", "\n").alias("all"))
    held = held.select("doc_id", "h", "all", F.explode("wanted").alias("line"))
    held = held.select(_place().alias("place"), F.get("all", F.col("line")).alias("content"))
    # Numbered in their order: the number is the partition of the sort and the place in it.
    held = staged(held.distinct().orderBy("place").withColumn("id", F.monotonically_increasing_id()), "live-lines")

    # Every variant with one character left out, and the line itself. Only variants of two lines stay.
    content = F.col("content")
    shards = max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = held.repartition(shards, "id").select("id", "content", F.explode(F.sequence(F.lit(0), F.char_length("content"))).alias("out"))
    variant = F.when(F.col("out") == 0, content).otherwise(F.concat(F.expr("substring(content, 1, out - 1)"), F.expr("substring(content, out + 1)")))
    variants = staged(rows.select("id", "out", F.xxhash64(variant).alias("v")), "all-variants")
    shared = staged(variants.groupBy("v").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("v"), "shared")
    variants = staged(variants.join(small_side(shared, shared.count(), BROADCAST_VARIANTS), "v", "left_semi"), "variants")
    changed = variants.where("out > 0").groupBy("v", "out").agg(F.min("id").alias("first"))
    changed = variants.join(changed, ["v", "out"]).where("first < id").select("id", "first")
    longer = variants.groupBy("v").agg(F.min(F.when(F.col("out") == 0, F.col("id"))).alias("whole"), F.min(F.when(F.col("out") > 0, F.col("id"))).alias("cut"))
    longer = variants.join(longer, "v").select("id", F.when(F.col("out") == 0, F.col("cut")).otherwise(F.col("whole")).alias("first")).where("first < id")
    partner = changed.unionByName(longer).groupBy("id").agg(F.min("first").alias("first"))

    # Verified on the lines themselves.
    near = partner.join(held.select("id", F.col("content").alias("own")), "id")
    near = near.join(held.select(F.col("id").alias("first"), F.col("content").alias("earlier")), "first")
    near = near.where(F.levenshtein("own", "earlier", 1) >= 0).where(F.least(F.char_length("own"), F.char_length("earlier")) >= MIN_CHARS)
    near = staged(near.select(*[x.alias(n) for x, n in zip(_keys(F.col("own")), ("k1", "k2"), strict=True)]).distinct(), "near")

    # A line goes if its distinct line has an earlier place, or an earlier partner.
    first = distinct.select("k1", "k2", "first").join(near.withColumn("near", F.lit(True)), ["k1", "k2"], "left")
    gone = places.select("place", "k1", "k2").join(first, ["k1", "k2"]).where("near OR place > first")
    return gone.select("place.*").distinct().groupBy("doc_id", "h").agg(F.array_sort(F.collect_list("line")).alias("removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with repeated lines left out of `text`, and n_lines, n_removed and removed (their places)."""
    gone = removed_lines(docs).select(F.col("doc_id").alias("gone_doc"), F.col("h").alias("gone_h"), F.col("removed").alias("gone"))
    rows = docs.withColumn("own_h", F.xxhash64("text")).join(gone, [F.col("doc_id").eqNullSafe(F.col("gone_doc")), F.col("own_h") == F.col("gone_h")], "left")
    lines = F.split("text", "\n")
    none = F.array().cast("array<int>")
    removed = F.coalesce("gone", none)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("gone", i)), "\n")
    others = [c for c in docs.columns if c != "text"]
    return rows.select(*others, F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
                       F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                       F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))
