"""Pay stage: bounds and mid as monthly amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import pay as P


def pay_norm(df: DataFrame, band: tuple[float, float] = P.PAY_BAND) -> DataFrame:
    """Adds salary_monthly_min, _max and _mid. A mid outside the band becomes null; the row
    and its bounds stay."""
    unit = F.col("salary_type")
    low = P.to_monthly(F.col("salary_min"), unit)
    high = P.to_monthly(F.col("salary_max"), unit)
    return df.withColumns(
        {
            "salary_monthly_min": low,
            "salary_monthly_max": high,
            "salary_monthly_mid": P.banded(P.mid_pay(low, high), band),
        }
    )
