"""Exact percentiles without a sort of the rows and without a group held in one place.

A discrete percentile is an order statistic, so it commutes with rounding: the percentile of the
rounded values is the rounded percentile. Rows are therefore counted by (group, rounded value)
first, which combines before the shuffle, and only the counts are ordered. Pay inside the band
has at most band-width + 1 whole values, which bounds every group of counts, however many rows
the group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.pay import PAY_BAND

# The percentiles of the benchmark and their column names.
PAY_PERCENTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}

#: Rows of the sketch that brackets a quantile. Four of so many parts of the rows lie in the bracket.
BRACKET = 100_000


def rank_select(
    counts: DataFrame, by: Sequence[str], value: str, weight: str = "n"
) -> DataFrame:
    """(by..., p25, p50, p75, sample_size) from the number of rows per value: the smallest value
    whose cumulative count reaches the share of the total."""
    group = Window.partitionBy(*by)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns(
        {"_upto": F.sum(weight).over(upto), "_total": F.sum(weight).over(group)}
    )
    return ranked.groupBy(*by).agg(
        *[
            F.min(F.when(F.col("_upto") >= F.col("_total") * p, F.col(value))).alias(name)
            for name, p in PAY_PERCENTILES.items()
        ],
        F.max("_total").alias("sample_size"),
    )


def in_band(value: str, band: tuple[float, float] = PAY_BAND) -> Column:
    """The value where it is inside the band; the query fails where one is outside, which is what bounds the
    number of counts. Null stays null."""
    outside = F.raise_error(F.concat(F.lit(f"{value} outside {band}: "), F.col(value).cast("string")))
    return F.when(F.col(value).isNull() | F.col(value).between(*band), F.col(value)).otherwise(outside.cast("double"))


def _in_band(df: DataFrame, value: str, band: tuple[float, float]) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).withColumn(value, in_band(value, band))


def approx_percentiles(value: str, accuracy: int) -> list[Column]:
    """The same columns as aggregates of a bounded sketch."""
    sketch = F.percentile_approx(value, list(PAY_PERCENTILES.values()), accuracy)
    picked = [F.round(sketch[i]).cast("double").alias(n) for i, n in enumerate(PAY_PERCENTILES)]
    return [*picked, F.count(F.lit(1)).alias("sample_size")]


def pay_percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: str = "salary_monthly_mid",
    accuracy: int | None = None,
    band: tuple[float, float] = PAY_BAND,
) -> DataFrame:
    """Percentiles, rounded to whole amounts, and row count per group of the rows with a value.

    Exact by default, for values inside the band, which bounds the number of whole amounts; `accuracy` uses percentile_approx instead (1000 is its usual setting).
    """
    known = df.filter(F.col(value).isNotNull())
    if accuracy is not None:
        return known.groupBy(*by).agg(*approx_percentiles(value, accuracy))
    known = _in_band(df, value, band)
    counts = known.groupBy(*by, F.round(value).alias("_pay")).agg(F.count(F.lit(1)).alias("n"))
    return rank_select(counts, by, "_pay")


def bracket(value: str, prob: float, accuracy: int = BRACKET) -> list[Column]:
    """Aggregates (total, low, high): the number of values, and two of them that the quantile lies between,
    from a bounded sketch that is off by at most one of `accuracy` parts of the rows."""
    off = 2 / accuracy
    sketch = F.percentile_approx(value, [max(prob - off, 0.0), min(prob + off, 1.0)], accuracy)
    return [F.count(value).alias("total"), sketch[0].alias("low"), sketch[1].alias("high")]


def quantile_within(df: DataFrame, value: str, prob: float, into: str, total: int, low: float | None, high: float | None, band: tuple[float, float] = PAY_BAND) -> DataFrame:
    """One row with the unrounded discrete quantile, given its bracket, null when there are no values. One
    pass counts the values outside the bracket and, one by one, those inside. A rank outside, which the sketch
    rules out, fails the query."""
    known = _in_band(df.select(value), value, band)
    x = F.col(value)
    side = F.when(x < low, -1).when(x > high, 1).otherwise(0)
    counts = known.groupBy(side.alias("_side"), F.when(side == 0, x).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    every = Window.partitionBy(F.lit(0)).orderBy("_side", "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counts.withColumn("_upto", F.sum("_n").over(every)).filter(F.col("_upto") >= F.lit(total) * F.lit(prob))
    first = reached.agg(F.min_by(F.struct("_side", "_value"), F.struct("_side", "_value")).alias("_first"))
    outside = F.raise_error(F.lit(f"the {prob} quantile of {value} is not between {low} and {high}")).cast("double")
    return first.select(F.when(F.col("_first._side") != 0, outside).otherwise(F.col("_first._value")).alias(into))


def exact_quantile(
    df: DataFrame, value: str, prob: float, into: str, band: tuple[float, float] = PAY_BAND
) -> DataFrame:
    """One row with the unrounded discrete quantile of a column, null when there are no values, from two
    scans: a sketch brackets it, which is a job of its own, and a pass counts."""
    known = _in_band(df.select(value), value, band)
    return quantile_within(df, value, prob, into, *known.agg(*bracket(value, prob)).first(), band)
