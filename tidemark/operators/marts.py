"""Marts: demand, overview, pay benchmark and market totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import posting_uid
from tidemark.operators.percentiles import (
    approx_percentiles,
    bracket,
    in_band,
    quantile_within,
    pay_percentiles,
    rank_select,
)

# Label of a rolled-up cell, smallest published sample, names of the totals.
ALL = "ALL"
MIN_SAMPLE = 3
KPI_POSTINGS = "total_postings"
KPI_SKILLS = "distinct_skills"
KPI_COMPANIES = "distinct_companies"
KPI_MEDIAN = "median_monthly_salary"


def _uid() -> Column:
    return posting_uid(F.col("source"), F.col("job_id"))


def demand_monthly(skills: DataFrame) -> DataFrame:
    """(skill, year_month, postings): distinct postings; rows without a month are left out."""
    return (
        skills.filter(F.col("year_month").isNotNull())
        .groupBy("skill", "year_month")
        .agg(F.count_distinct(_uid()).alias("postings"))
    )


def skill_totals(skills: DataFrame) -> DataFrame:
    """(skill, category, total_postings), over all rows with or without a month. The category
    belongs to the skill (it is joined by skill), so it is a key, not an aggregate: an aggregate
    of text would make the whole distinct count sort-based."""
    return skills.groupBy("skill", "category").agg(F.count_distinct(_uid()).alias("total_postings"))


def demand_rollup(skills: DataFrame) -> DataFrame:
    """Distinct postings by (skill, month) and by skill from one pass over the rows:
    (skill, category, year_month, is_total, postings). It feeds both demand marts."""
    sets = [["skill", "category", "year_month"], ["skill", "category"]]
    return (
        skills.withColumn("_uid", _uid())
        .groupingSets(sets, "skill", "category", "year_month")
        .agg(
            (F.grouping("year_month") == 1).alias("is_total"),
            F.count_distinct("_uid").alias("postings"),
        )
    )


def monthly_from_rollup(rollup: DataFrame) -> DataFrame:
    months = rollup.filter(~F.col("is_total") & F.col("year_month").isNotNull())
    return months.select("skill", "year_month", "postings")


def mom_change(monthly: DataFrame, calendar: bool = False) -> DataFrame:
    """Adds prev_count and mom_pct. The previous month is the previous one present, or, with
    `calendar`, the month before (null where it is absent)."""
    by_month = Window.partitionBy("skill").orderBy("year_month")
    return _with_change(monthly, by_month, F.lit(True), calendar)


def _with_change(df: DataFrame, window, is_month: Column, calendar: bool) -> DataFrame:
    prev = F.when(F.lag(is_month).over(window), F.lag("postings").over(window))
    if calendar:
        month = F.try_to_date("year_month", "yyyy-MM")
        prev = F.when(F.add_months(F.lag(month).over(window), 1) == month, prev)
    change = F.when(
        F.col("prev_count") > 0,
        F.round((F.col("postings") - F.col("prev_count")) / F.col("prev_count") * 100, 1),
    )
    return df.withColumn("prev_count", prev).withColumn("mom_pct", change)


def overview_from_rollup(rollup: DataFrame, calendar: bool = False) -> DataFrame:
    """Totals of each skill beside its latest month; a skill without months keeps nulls there.

    The month rows and the total row of a skill are brought together once, by skill: the order
    puts the rows without a month first, and the greatest month row is the latest.
    """
    is_month = ~F.col("is_total") & F.col("year_month").isNotNull()
    by_month = Window.partitionBy("skill").orderBy("_is_month", "year_month")
    rows = _with_change(
        rollup.withColumn("_is_month", is_month), by_month, F.col("_is_month"), calendar
    )
    month = F.struct("year_month", "postings", "prev_count", "mom_pct")
    return (
        rows.groupBy("skill", "category")
        .agg(
            F.max(F.when(F.col("is_total"), F.col("postings"))).alias("total_postings"),
            F.max(F.when(F.col("_is_month"), month)).alias("_latest"),
        )
        .select(
            "skill",
            "category",
            "total_postings",
            F.col("_latest.year_month").alias("latest_month"),
            F.col("_latest.postings").alias("latest_count"),
            F.col("_latest.prev_count").alias("prev_count"),
            F.col("_latest.mom_pct").alias("mom_pct"),
        )
    )


def skill_overview(skills: DataFrame, calendar: bool = False) -> DataFrame:
    return overview_from_rollup(demand_rollup(skills), calendar)


def salary_benchmark(
    skills: DataFrame, min_sample: int = MIN_SAMPLE, accuracy: int | None = None
) -> DataFrame:
    """Pay percentiles by skill, by (skill, region) and by (skill, seniority) from one pass; the
    columns rolled up hold 'ALL'. Groups below the smallest sample are left out."""
    pay = "salary_monthly_mid"
    if accuracy is None:
        return benchmark_from_counts(pay_counts(skills), min_sample)
    known = skills.filter(F.col(pay).isNotNull())
    sets = [["skill"], ["skill", "region"], ["skill", "seniority"]]
    grouped = known.groupingSets(sets, "skill", "region", "seniority")
    return _benchmark(grouped.agg(*_rolled(), *approx_percentiles(pay, accuracy)), min_sample)


CELL = ["skill", "region", "seniority"]


def pay_counts(skills: DataFrame) -> DataFrame:
    """(skill, region, seniority, pay, n): rows with pay by cell and whole amount. Counts of new rows are added
    to counts kept from earlier runs (`merge_counts`), and percentiles of both follow from the sum."""
    known = skills.filter(F.col("salary_monthly_mid").isNotNull())
    return known.groupBy(*CELL, F.round("salary_monthly_mid").alias("pay")).agg(F.count(F.lit(1)).alias("n"))


def merge_counts(*tables: DataFrame) -> DataFrame:
    """The sum of counts. A table with negative counts takes rows back, as of a posting that was replaced;
    what is down to nothing is left out."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.groupBy(*CELL, "pay").agg(F.sum("n").alias("n")).filter("n <> 0")


def benchmark_from_counts(counts: DataFrame, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """The pay benchmark of counted amounts. The grains expand distinct amounts of a cell, not rows."""
    sets = [["skill", "pay"], ["skill", "region", "pay"], ["skill", "seniority", "pay"]]
    grouped = counts.groupingSets(sets, *CELL, "pay").agg(*_rolled(), F.sum("n").alias("n"))
    return _benchmark(rank_select(grouped, [*CELL, "_all_regions", "_all_seniorities"], "pay"), min_sample)


def _rolled() -> list[Column]:
    return [F.grouping("region").alias("_all_regions"), F.grouping("seniority").alias("_all_seniorities")]


def _benchmark(out: DataFrame, min_sample: int) -> DataFrame:
    def cell(name: str, flag: str) -> Column:
        return F.when(F.col(flag) == 1, F.lit(ALL)).otherwise(F.col(name)).alias(name)

    return out.filter(F.col("sample_size") >= min_sample).select(
        "skill",
        cell("region", "_all_regions"),
        cell("seniority", "_all_seniorities"),
        "p25", "p50", "p75", "sample_size",
    )


def market_kpi(postings: DataFrame, skills: DataFrame, accuracy: int | None = None) -> DataFrame:
    """(metric, value) rows. A null company counts as one company; no pay gives a median of 0.

    The postings are read twice more for an exact median: once for a sketch that brackets it, and once to count
    around the bracket. The totals and the sketch are jobs of their own with one row each for the driver. The sketch
    is never in one aggregate with the distinct count, which would keep a sketch for every company and merge them all
    in one task."""
    pay = "salary_monthly_mid"
    spark = postings.sparkSession
    null_company = F.coalesce(F.max(F.col("company").isNull().cast("int")), F.lit(0))
    counted = postings.agg(F.count(F.lit(1)).alias(KPI_POSTINGS), (F.count_distinct("company") + null_company).alias(KPI_COMPANIES))
    found = _as_rows(skills.agg(F.count_distinct("skill").alias(KPI_SKILLS)))
    if accuracy is not None:
        median = F.coalesce(F.percentile_approx(pay, 0.5, accuracy), F.lit(0.0)).alias(KPI_MEDIAN)
        return _as_rows(counted).unionByName(_as_rows(postings.agg(median))).unionByName(found)
    around = postings.select(in_band(pay).alias(pay)).agg(*bracket(pay, 0.5)).first()
    known = spark.createDataFrame([tuple(counted.first())], f"{KPI_POSTINGS} long, {KPI_COMPANIES} long")
    median = quantile_within(postings, pay, 0.5, KPI_MEDIAN, *around).select(F.coalesce(KPI_MEDIAN, F.lit(0.0)).alias(KPI_MEDIAN))
    return _as_rows(known).unionByName(found).unionByName(_as_rows(median))


def _as_rows(one_row: DataFrame) -> DataFrame:
    values = [F.col(c).cast("double").alias(c) for c in one_row.columns]
    return one_row.select(*values).unpivot([], list(one_row.columns), "metric", "value")


__all__ = [
    "benchmark_from_counts",
    "demand_monthly",
    "demand_rollup",
    "market_kpi",
    "merge_counts",
    "mom_change",
    "monthly_from_rollup",
    "overview_from_rollup",
    "pay_counts",
    "pay_percentiles",
    "salary_benchmark",
    "skill_overview",
    "skill_totals",
]
