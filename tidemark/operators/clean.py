"""Clean stage: conform, typed values, and the derived columns of a posting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators.conform import conform


def posting_text() -> Column:
    """The text terms are looked for in."""
    return X.full_text(F.col("title"), F.col("description"), F.col("requirements"))


def clean(
    df: DataFrame,
    seniority_rules: Sequence[tuple[str, str]] = X.SENIORITY_RULES,
    region: Column | None = None,
    with_text: bool = True,
) -> DataFrame:
    """Postings with an id and a title, plus year_month, seniority, region and full_text.

    `region` replaces the rule for Chinese addresses. `with_text=False` leaves full_text out,
    for a plan that shuffles the rows first and derives the text afterwards.
    """
    derived = {
        "year_month": X.year_month(F.col("posted_date"), F.col("fetched_at")),
        "seniority": X.bucket_rules(F.col("experience"), seniority_rules),
        "region": X.region_extract(F.col("city")) if region is None else region,
    }
    if with_text:
        derived["full_text"] = posting_text()
    kept = conform(df).filter(F.col("job_id").isNotNull() & F.col("title").isNotNull())
    return kept.withColumns(derived)
