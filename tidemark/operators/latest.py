"""Keep-latest operators.

Both group by a key and take the greatest row, as a struct that starts with the order columns.
Struct comparison puts nulls lowest, so the greatest is "descending, nulls last"; the columns
after the order columns break ties, so the result does not depend on the order of the input.
A group-by reduces each key to one row per task before the shuffle, so a key with very many
copies does not end up in one task, as it would with a window over the key.

The greatest row is found by sorting, so whole rows, long texts included, are sorted before and after
the shuffle. Rows of Parquet files have a place, file and number in it, and need not be: the `located`
forms find the winners on narrow rows (digest of the key, order columns, place) and fetch each winner's
row once, by its place. No long column is in a sort; places are all different, so a key with very many
copies is no hot key of that join either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEDUP_ORDER = ("posted_date", "fetched_at", "source", "job_id")


def dedup_key() -> list[Column]:
    """Normalized company and title, and region. The source is left out on purpose: the same
    posting seen in two sources is one posting."""

    def norm(name: str) -> Column:
        return F.lower(F.trim(F.coalesce(F.col(name), F.lit(""))))

    return [norm("company"), norm("title"), F.col("region")]


def _latest(df: DataFrame, keys: Sequence[Column], order: Sequence[str], *aggs: Column):
    names = [f"_k{i}" for i in range(len(keys))]
    row = F.struct(*order, *[c for c in df.columns if c not in order])
    grouped = df.groupBy(*[k.alias(n) for k, n in zip(keys, names)])
    return grouped.agg(F.max(row).alias("_row"), *aggs)


def dedup_latest(
    df: DataFrame,
    keys: Sequence[Column] | None = None,
    order: Sequence[str] = DEDUP_ORDER,
    date: str = "posted_date",
) -> DataFrame:
    """Latest row of each key, with first_seen, last_seen and times_seen of all its rows."""
    seen = {
        "first_seen": F.min(date),
        "last_seen": F.max(date),
        "times_seen": F.count(F.lit(1)),
    }
    keys = dedup_key() if keys is None else keys
    best = _latest(df, keys, order, *[c.alias(n) for n, c in seen.items()])
    return best.select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns], *seen)


def _digest(keys: Sequence[Column]) -> Column:
    """128 bits of a key; a null is no empty text, and texts run together are told apart by their lengths."""
    part = [F.coalesce(F.concat(F.length(k.cast("string")).cast("string"), F.lit(":"), k.cast("string")), F.lit("-")) for k in keys]
    return F.unhex(F.md5(F.concat(*part)))


def _place() -> list[Column]:
    return [F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]


def _winners(narrow: DataFrame, rank: Sequence[str], *aggs: Column) -> DataFrame:
    """(_file, _row, aggregates) of the greatest row of each digest, by `rank` and then by place."""
    best = narrow.groupBy("_digest").agg(F.max(F.struct(*rank, "_file", "_row")).alias("_best"), *aggs)
    return best.select("_best._file", "_best._row", *[c for c in best.columns if c not in ("_digest", "_best")])


def _narrow(df: DataFrame, keys: Sequence[Column], order: Sequence[str], content: bool, *more: str) -> DataFrame:
    """The columns that decide. With `content` rows that agree in key and order are decided by a hash of
    the whole row, so that the result does not depend on how rows lie in files; that reads all columns."""
    tie = F.xxhash64(*df.columns) if content else F.lit(0).cast("long")
    extra = [c for c in dict.fromkeys(more) if c not in order]
    return df.select(_digest(keys).alias("_digest"), *order, *extra, tie.alias("_tie"), *_place())


def _fetched(df: DataFrame, won: DataFrame, *extra: str) -> DataFrame:
    """The rows at the places. The narrow side is hashed, so the rows themselves are not sorted."""
    rows = df.select("*", *_place())
    return rows.join(won.hint("shuffle_hash"), ["_file", "_row"]).select(*[F.col(f"`{c}`") for c in df.columns], *extra)


def dedup_located(
    df: DataFrame,
    keys: Sequence[Column] | None = None,
    order: Sequence[str] = DEDUP_ORDER,
    date: str = "posted_date",
    content: bool = True,
) -> DataFrame:
    """`dedup_latest` for rows read from Parquet files and since then only filtered or given other
    columns. Full ties are decided by a hash of the row (`content`), else by place."""
    seen = {
        "first_seen": F.min(date),
        "last_seen": F.max(date),
        "times_seen": F.count(F.lit(1)),
    }
    narrow = _narrow(df, dedup_key() if keys is None else keys, order, content, date)
    won = _winners(narrow, [*order, "_tie"], *[c.alias(n) for n, c in seen.items()])
    return _fetched(df, won, *seen)


def latest_located(
    df: DataFrame,
    key: Sequence[str] = ("source", "job_id"),
    order: Sequence[str] = ("fetched_at",),
    content: bool = True,
) -> DataFrame:
    """`latest_version` for rows read from Parquet files."""
    narrow = _narrow(df, [F.col(k) for k in key], order, content)
    return _fetched(df, _winners(narrow, [*order, "_tie"]))


def upsert_located(
    existing: DataFrame,
    updates: DataFrame,
    key: Sequence[str] = ("source", "job_id"),
    order: Sequence[str] = ("fetched_at",),
    content: bool = True,
) -> DataFrame:
    """`upsert_latest` for two frames read from Parquet files."""
    keys = [F.col(k) for k in key]
    updates = updates.select(*[F.col(f"`{c}`") for c in existing.columns])
    both = _narrow(existing, keys, order, content).withColumn("_new", F.lit(0)).unionByName(
        _narrow(updates, keys, order, content).withColumn("_new", F.lit(1)))
    # One row for each key goes into two joins; files of the two frames are different.
    won = _winners(both, [*order, "_new", "_tie"])
    return _fetched(existing, won).unionByName(_fetched(updates, won))


def upsert_latest(
    existing: DataFrame,
    updates: DataFrame,
    key: Sequence[str] = ("source", "job_id"),
    order: Sequence[str] = ("fetched_at",),
) -> DataFrame:
    """Both frames with one row per key: the latest by `order`, an update before an existing
    row where these are equal. The row is replaced whole, nulls included."""
    rank = [*order, "_new"]
    both = existing.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    best = _latest(both, [F.col(k) for k in key], rank)
    return best.select(*[F.col(f"_row.`{c}`").alias(c) for c in existing.columns])


def latest_version(
    df: DataFrame,
    key: Sequence[str] = ("source", "job_id"),
    order: Sequence[str] = ("fetched_at",),
) -> DataFrame:
    """One row per key, the latest by `order`: the view of an append-only table."""
    best = _latest(df, [F.col(k) for k in key], order)
    return best.select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns])
