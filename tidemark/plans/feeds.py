"""Ordered and bounded queries over the marts. Arguments are checked before a plan is built and
enter it as literals. Ties are broken by name, so a limited result is always the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.marts import ALL


def _bounded(limit: int, most: int) -> int:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}, not {limit}")
    return limit


def skills(overview: DataFrame, category: str | None = None, limit: int = 100) -> DataFrame:
    """Skills with the most postings, of one category or of all."""
    limit = _bounded(limit, 500)
    if category:
        overview = overview.filter(F.col("category") == F.lit(category))
    return overview.orderBy(F.desc("total_postings"), "skill").limit(limit)


def trending(overview: DataFrame, limit: int = 10, min_postings: int = 5) -> DataFrame:
    """Skills with the largest month-over-month change."""
    limit = _bounded(limit, 100)
    kept = overview.filter(
        F.col("mom_pct").isNotNull() & (F.col("total_postings") >= min_postings)
    )
    return kept.orderBy(F.desc("mom_pct"), "skill").limit(limit)


def trend(monthly: DataFrame, skill: str, require: bool = False) -> DataFrame:
    """Months of one skill in order. With `require`, no rows raise LookupError."""
    rows = monthly.filter(F.col("skill") == F.lit(skill)).select("year_month", "postings")
    if require and rows.isEmpty():
        raise LookupError(f"no demand data for skill {skill!r}")
    return rows.orderBy("year_month")


def salary(
    benchmark: DataFrame,
    skill: str | None = None,
    region: str = ALL,
    seniority: str = ALL,
    limit: int = 100,
) -> DataFrame:
    """Benchmark rows of one region and seniority, highest median first."""
    limit = _bounded(limit, 500)
    kept = benchmark.filter(
        (F.col("region") == F.lit(region)) & (F.col("seniority") == F.lit(seniority))
    )
    if skill:
        kept = kept.filter(F.col("skill") == F.lit(skill))
    return kept.orderBy(F.desc_nulls_last("p50"), "skill", "region", "seniority").limit(limit)


def kpi(market: DataFrame) -> DataFrame:
    return market.select("metric", "value").orderBy("metric")


def skill_medians(benchmark: DataFrame, skills: Sequence[str]) -> DataFrame:
    """(skill, p50) over all regions and seniorities, for the chosen skills that have one."""
    rolled = (F.col("region") == ALL) & (F.col("seniority") == ALL)
    return benchmark.filter(rolled & F.col("skill").isin(*skills)).select("skill", "p50")


def trend_pivot(monthly: DataFrame, skills: Sequence[str]) -> DataFrame:
    """One row per month with a column of postings for each chosen skill."""
    chosen = monthly.filter(F.col("skill").isin(*skills))
    return chosen.groupBy("year_month").pivot("skill", list(skills)).agg(F.max("postings"))
