"""Demand by bitmaps: exact distinct counts that can be merged.

Postings get numbers, dense in ranges of 2^15 bits, and the postings of a term and month are a bitmap for each
range. A month's count is the number of its bits, a term's total that of the months' bitmaps put
together, so rows are shuffled once and not expanded, and the text of a posting's key goes no further than the
numbering. Kept as a table, bitmaps of new rows are put together with the old ones (`merge_bitmaps`), which a
count can't be.

Numbers follow the months inside each partition of keys, so a range has few months and a bitmap is made by
one task. A posting without a month counts in the total only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.lake import staged

KEY = ["source", "job_id"]
NUMBER = "posting_no"
RANGE = 1 << 15
GRAIN = ["skill", "category", "year_month"]


def number_postings(postings: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(source, job_id, posting_no) of every posting (source, job_id, year_month), and of those already
    `known`, which keep their numbers. A table: numbers are given once and not found again by a second
    run over the same rows. A posting without a source or id has no number."""
    rows = postings.where("source IS NOT NULL AND job_id IS NOT NULL").groupBy(*KEY).agg(F.min("year_month").alias("_month"))
    first = 0
    if known is not None:
        rows = rows.join(known.select(*KEY), KEY, "left_anti")
        last = known.agg(F.max(NUMBER)).first()[0]
        first = 0 if last is None else (last // RANGE + 1) * RANGE
    given = rows.sortWithinPartitions("_month", *KEY).withColumn(NUMBER, F.monotonically_increasing_id() + F.lit(first))
    given = given.select(*KEY, NUMBER)
    return staged(given if known is None else known.select(*KEY, NUMBER).unionByName(given), "numbers")


def demand_bitmaps(skills: DataFrame, numbers: DataFrame) -> DataFrame:
    """(skill, category, year_month, bucket, bitmap) of the long table."""
    rows = skills.select(*GRAIN, *KEY).join(numbers, KEY)
    rows = rows.select(*GRAIN, F.bitmap_bucket_number(NUMBER).alias("bucket"), F.bitmap_bit_position(NUMBER).alias("_bit"))
    return rows.groupBy(*GRAIN, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def merge_bitmaps(*tables: DataFrame) -> DataFrame:
    """The bitmaps of all tables put together: rows that are in several count once."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.groupBy(*GRAIN, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def rollup_from_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """What `demand_rollup` gives: distinct postings by (skill, month) and by skill."""
    columns = ["skill", "category", "year_month", "is_total", "postings"]
    bits = F.sum(F.bitmap_count("bitmap")).alias("postings")
    months = bitmaps.groupBy(*GRAIN).agg(bits).withColumn("is_total", F.lit(False))
    whole = bitmaps.groupBy("skill", "category", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    totals = whole.groupBy("skill", "category").agg(bits).withColumn("is_total", F.lit(True)).withColumn("year_month", F.lit(None).cast("string"))
    return months.select(columns).unionByName(totals.select(columns))
