"""Term stage: terms per posting, and the long (posting, term) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.terms import Gazetteer

LONG_COLUMNS = (
    "skill", "source", "job_id", "year_month", "region", "seniority",
    "salary_monthly_mid", "company", "title",
)

#: Terms, of two short texts each, up to which the category table is broadcast; more are joined by a shuffle.
BROADCAST_TERMS = 500_000


def term_match(
    df: DataFrame, gazetteer: Gazetteer, text: str = "full_text", into: str = "skills"
) -> DataFrame:
    """Adds the array of terms found in the text; empty where there is none."""
    return df.withColumn(into, gazetteer.matches(F.col(text)))


def term_extract(df: DataFrame, gazetteer: Gazetteer, text: str = "full_text") -> DataFrame:
    """One row per posting and term with the term's category; postings without terms drop out."""
    found = df.select(*LONG_COLUMNS[1:], F.explode(gazetteer.matches(F.col(text))).alias("skill"))
    # Spark cannot tell the size of rows made on the driver, but the gazetteer can.
    dim = gazetteer.dim(df.sparkSession)
    if len(gazetteer.categories) <= BROADCAST_TERMS:
        dim = F.broadcast(dim)
    return found.select(*LONG_COLUMNS).join(dim, "skill", "left")
