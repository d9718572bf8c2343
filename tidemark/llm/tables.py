"""Reading tables and keeping rows apart: small helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lowered and nothing else. `lower` is several times faster than `translate`, and the same on
    ASCII texts."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def split_words(text: Column) -> Column:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the A-Z lowered text (null: none), with an empty
    string before or after them where the text does not begin or end with a word."""
    return F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text: Column) -> Column:
    """The words alone."""
    return F.filter(split_words(text), lambda w: w != "")


def small_side(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """The frame with a broadcast hint if its counted rows are at most the limit. Beyond it the same
    join shuffles, which adaptive execution splits where a key is hot."""
    return F.broadcast(df) if rows <= limit else df


def among(df: DataFrame, column: str, values: DataFrame, rows: int, few: int, limit: int) -> DataFrame:
    """The rows whose column is one of the values (one column of that name, distinct, counted): by a
    set in the plan while they are few, else by a join."""
    if rows <= few:
        return df.where(F.col(column).isin([r[0] for r in values.select(column).collect()]))
    return df.join(small_side(values.select(column), rows, limit), column, "left_semi")
