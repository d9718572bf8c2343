"""Mixing sources to target weights by a low-discrepancy schedule.

Every slot of the schedule stands for a block of equally many words, at most BLOCK of them whatever the
input, so slots grow with it. Slot i takes the source whose stretch of the cumulative weights holds the
van der Corput point of i, so after any number of slots each source is close to its share. How often a source came before slot i, its rank there, is computed from i
and the stretch alone: a bound of the stretch is a sum of powers of two, and points below each such piece
are the i of one residue. No slot waits for another and no group of slots is ever sorted.

A source's documents are put in hash order and cut into blocks, the last one of each pass with the words
that are left. Rank r reads block r modulo the number of blocks; a source is read at most PASSES times
over. A source has as many ranks as its target takes, the last one cut to the words still missing. Ranks
that the points leave out, a few of each source, are the last slots. So every source gets its target
to the word, also one whose target is smaller than a block. Where documents begin in their source follows
from sums per stretch of the hash order, so a source with most documents is spread over many groups.

Null text: size 0. A null source is a source of its own, last. Rows that repeat an id, or everything,
are documents of their own in `mixture`, and one document in `mixed_documents`. An empty table, or one
without words, gives targets and taken words of 0. Very long documents span blocks. Other columns are
ignored by `mixture` and kept by `mixed_documents`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import small_side
from tidemark.sources.lake import staged

WEIGHTS = (5, 2, 1)
PASSES = 3
#: Slots in a schedule, at least about, of small inputs: blocks have a word or more.
SLOTS = 1 << 18
#: Words of a block at most. Larger inputs have more slots.
BLOCK = 64
#: Sources up to this many are broadcast.
BROADCAST_SOURCES = 50_000
#: The same for their bounds, which are up to 2 KB each.
BROADCAST_BOUNDS = 2_000

_BITS = 40  # of van der Corput points and stretches
_CELL_BITS = 16  # slots and stretches meet by the cell of the unit interval they fall in; more for many sources


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text; null: 0."""
    words = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.filter(words, lambda w: w != "")).cast("long")


def _reversed_bits(number: Column, bits: Column) -> Column:
    text = F.reverse(F.right(F.concat(F.lit("0" * (_BITS + 1)), F.bin(number)), bits))
    return F.when(bits > 0, F.conv(text, 2, 10).cast("long")).otherwise(F.lit(0).cast("long"))


def sources(sized: DataFrame, block: int, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(sid, source, source_size, target, n_blocks, ranks, last, low, high): sources by code point, null
    last; target words; blocks of a pass; ranks that the target takes and the words that the last one
    reads; and their stretch of the unit interval in 2 ** -_BITS. A row per source, in one task."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sums.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.lit([float(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.lit(float(passes)) * F.col("source_size"))
    # A source stops at its limit exactly if it does so after all with a smaller limit for their weight.
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy()
    left = F.sum("source_size").over(everyone) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    filled = ranked.withColumn("full", F.col("limit") * F.sum("weight").over(rest) < F.col("weight") * left)
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(everyone), F.lit(0.0))) / F.sum(
        F.when(~F.col("full"), F.col("weight"))).over(everyone)
    filled = filled.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(F.least("limit", F.col("weight") * level)))
    filled = filled.withColumn("quota", F.least(F.round("target").cast("long"), F.lit(passes) * F.col("source_size")))
    filled = filled.withColumn("n_blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    # Whole passes, and of the one after them the blocks that the rest of the quota takes.
    filled = filled.withColumn("rest", F.when(F.col("quota") > 0, (F.col("quota") - 1) % F.col("source_size") + 1).otherwise(F.lit(0)))
    whole = F.when(F.col("quota") > 0, F.expr("(quota - 1) div source_size")).otherwise(F.lit(0))
    filled = filled.withColumn("ranks", whole * F.col("n_blocks") + F.expr(f"(rest + {block - 1}) div {block}"))
    filled = filled.withColumn("last", F.when(F.col("rest") > 0, (F.col("rest") - 1) % F.lit(block) + 1).otherwise(F.lit(0)))
    share = F.sum("ranks").over(Window.orderBy("sid")) / F.greatest(F.sum("ranks").over(everyone), F.lit(1))
    filled = filled.withColumn("high", F.least(F.round(share * float(1 << _BITS)).cast("long"), F.lit(1 << _BITS)))
    low = F.coalesce(F.lag("high").over(Window.orderBy("sid")), F.lit(0).cast("long"))
    return filled.select("sid", "source", "source_size", "target", "n_blocks", "ranks", "last", low.alias("low"), "high")


def _pieces(bound: Column) -> Column:
    """The residues that the points below the bound have: (bits of the residue, residue)."""
    places = F.filter(F.sequence(F.lit(0), F.lit(_BITS)), lambda p: F.getbit(bound, p) == 1)

    def piece(p):
        top = F.call_function("shiftright", bound, p + 1) * 2
        return F.named_struct(F.lit("bits"), F.lit(_BITS) - p, F.lit("residue"), _reversed_bits(top, F.lit(_BITS) - p))

    return F.transform(places, piece)


def _points_below(n: Column, pieces: Column) -> Column:
    """How many of the first n points lie below the bound of the pieces."""
    one = F.lit(1).cast("long")
    count = lambda x: F.call_function("shiftright", n + F.call_function("shiftleft", one, x["bits"]) - 1 - x["residue"], x["bits"])
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda a, x: a + count(x))


def schedule(spark: SparkSession, weighted: DataFrame, slots: int, n_sources: int) -> DataFrame:
    """(slot, sid, rank, pass, block, last): what each slot reads; last is how many words of its block,
    of a source's last rank, and null for the others, which read it whole. Every rank of a source has
    one slot."""
    points = spark.range(slots).select(F.col("id").alias("slot"), _reversed_bits(F.col("id"), F.lit(_BITS)).alias("point"))
    shift = _BITS - min(max(_CELL_BITS, n_sources.bit_length() + 2), _BITS - 8)
    points = points.withColumn("cell", F.shiftright("point", shift))
    spans = weighted.where("high > low").select(
        "sid", "low", "high", "n_blocks", "ranks", "last",
        F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))).alias("cell"))
    met = points.join(spans, "cell").where("point >= low AND point < high")
    bounds = weighted.select("sid", _pieces(F.col("low")).alias("below_low"), _pieces(F.col("high")).alias("below_high"))
    met = met.join(small_side(bounds, n_sources, BROADCAST_BOUNDS), "sid")

    def met_before(n):
        return _points_below(n, F.col("below_high")) - _points_below(n, F.col("below_low"))

    ranked = met.select("slot", "sid", "n_blocks", "ranks", "last", met_before(F.col("slot")).alias("rank")).where("rank < ranks")
    # The ranks that no point falls to: a few of each source.
    left = weighted.join(small_side(bounds, n_sources, BROADCAST_BOUNDS), "sid").withColumn("had", met_before(F.lit(slots).cast("long"))).where("had < ranks")
    before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    left = left.withColumn("base", F.lit(slots) + F.coalesce(F.sum(F.col("ranks") - F.col("had")).over(before), F.lit(0)))
    left = left.select("sid", "n_blocks", "ranks", "last", "had", "base", F.explode(F.expr("sequence(had, ranks - 1)")).alias("rank"))
    left = left.select((F.col("base") + F.col("rank") - F.col("had")).alias("slot"), "sid", "n_blocks", "ranks", "last", "rank")
    every = ranked.unionByName(left)
    return every.select("slot", "sid", "rank", F.expr("rank div n_blocks").alias("pass"), F.expr("rank % n_blocks").alias("block"),
                        F.when(F.col("rank") == F.col("ranks") - 1, F.col("last")).alias("last"))


def _shuffled(sized: DataFrame, n_rows: int) -> DataFrame:
    """With `begin`: the words of the document's source before it, in hash order."""
    bits = max(math.ceil(math.log2(max(n_rows, 1)) / 2) + 1, 0)
    order = F.xxhash64(F.lit("shuffled"), "doc_id", "h")
    rows = sized.withColumn("order", order).withColumn("stretch", F.shiftrightunsigned("order", 64 - bits) if bits else F.lit(0).cast("long"))
    sums = rows.groupBy("sid", "stretch").agg(F.sum("size").alias("words"))
    base = F.coalesce(F.sum("words").over(Window.partitionBy("sid").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("sid").alias("s"), F.col("stretch").alias("t"), base.alias("base"))
    own = Window.partitionBy("sid", "stretch").orderBy("order", "doc_id", "h", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(own), F.lit(0)))
    rows = rows.join(sums, [F.col("sid") == F.col("s"), F.col("stretch") == F.col("t")])
    return rows.select("doc_id", "h", "sid", "size", (F.col("base") + F.col("inner")).alias("begin"))


def mixture(docs: DataFrame, slots: int = SLOTS, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(doc_id, h, source, size, source_size, target, taken) of every row of docs (doc_id, text, source):
    taken is how many of its words the schedule reads, repeats counted."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("h"), word_count(F.col("text")).alias("size"))
    rows = staged(rows, "sized")
    n_rows, words = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = min(max(-(-words // slots), 1), BLOCK)
    weighted = staged(sources(rows, block, weights, passes), "sources")
    n_sources, n_ranks = weighted.agg(F.count("*"), F.coalesce(F.sum("ranks"), F.lit(0))).first()
    plan = schedule(spark, weighted, n_ranks, n_sources)
    uses = plan.groupBy("sid", "block").agg(F.count_if(F.col("last").isNull()).alias("uses"), F.max("last").alias("last"))

    known = weighted.select("sid", F.col("source").alias("name"))
    rows = rows.join(small_side(known, n_sources, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("name"))).drop("name", "source")
    placed = _shuffled(rows.where("size > 0"), n_rows)
    end = F.col("begin") + F.col("size")
    cut = F.sequence(F.expr(f"begin div {block}"), F.expr(f"(begin + size - 1) div {block}"))
    pieces = placed.select("*", F.explode(cut).alias("block"))
    low, high = F.greatest(F.col("begin") - F.col("block") * block, F.lit(0)), F.least(end - F.col("block") * block, F.lit(block))
    read = pieces.select("*", low.alias("from"), high.alias("to")).join(uses, ["sid", "block"], "left")
    part = F.greatest(F.least("to", F.coalesce("last", F.lit(0))) - F.col("from"), F.lit(0))
    length = F.coalesce((F.col("to") - F.col("from")) * F.col("uses"), F.lit(0)) + part
    taken = read.groupBy("doc_id", "h", "sid", "size", "begin").agg(F.sum(length).cast("long").alias("taken")).drop("begin")
    # Rows without words have no place, and none of them is told from another of its id.
    taken = taken.unionByName(rows.where("size = 0").select("doc_id", "h", "sid", "size", F.lit(0).cast("long").alias("taken")))
    named = small_side(weighted.select("sid", "source", "source_size", "target"), n_sources, BROADCAST_SOURCES)
    return taken.join(named, "sid").select("doc_id", "h", "source", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The mixed corpus, with the columns of docs: a document as often as it is read whole, and once
    more cut to the words read of it in part. `n_chars` is that of the text that stays."""
    mix = mixture(docs, slots).groupBy(F.col("doc_id").alias("_mix_id"), F.col("h").alias("_mix_hash"), F.col("source").alias("_mix_source"))
    mix = mix.agg(F.sum("size").alias("size"), F.sum("taken").alias("_taken"), F.count("*").alias("_rows")).where("_taken > 0")
    mix = mix.select("_mix_id", "_mix_hash", "_mix_source", F.expr("size div _rows").alias("_size"), "_taken")
    # A row is told by id, text and source: a text that two sources have is read for each of them. Repeats go
    # after the join, by its very keys, so texts are shuffled once.
    none = F.lit(0).cast(docs.schema["doc_id"].dataType)

    def told(doc_id: Column, source: Column) -> dict[str, Column]:
        source = source.cast("string")
        return {"_mix_id": F.coalesce(doc_id, none), "_mix_no_id": doc_id.isNull(), "_mix_of": F.coalesce(source, F.lit("")), "_mix_no_of": source.isNull()}

    mix = mix.select(*(c.alias(k) for k, c in told(F.col("_mix_id"), F.col("_mix_source")).items()), F.col("_mix_hash").alias("_hash"), "_size", "_taken")
    own = told(F.col("doc_id"), F.col("source")) | {"_hash": F.xxhash64("text")}
    rows = docs.withColumns(own).join(mix, [*own]).dropDuplicates([*own])
    copies = F.sequence(F.lit(1).cast("long"), F.expr("(_taken + _size - 1) div _size"))
    rows = rows.withColumn("_copy", F.explode(copies))
    part = F.when(F.col("_copy") * F.col("_size") > F.col("_taken"), F.col("_taken") % F.col("_size"))
    cut = F.regexp_extract("text", r"^[\x20\x09-\x0D]*", 0)
    first = F.concat(cut, F.concat_ws(" ", F.slice(F.split(F.substr("text", F.length(cut) + 1), r"[\x20\x09-\x0D]+"), F.lit(1), part.cast("int"))))
    text = F.when(part.isNull(), F.col("text")).otherwise(first)
    kept = [c for c in docs.columns]
    rows = rows.withColumn("text", text)
    if "n_chars" in kept:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*kept)
