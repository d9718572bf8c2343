"""Fixed schemas of the posting tables and the marts, and the check before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple) -> T.StructType:
    """(name, type) is nullable; (name, type, False) is not."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


# The 18 columns of a normalized posting, in order.
POSTING = _struct(
    ("source", _S),
    ("job_id", _S),
    ("title", _S),
    ("company", _S),
    ("description", _S),
    ("requirements", _S),
    ("salary_text", _S),
    ("salary_min", _D),
    ("salary_max", _D),
    ("salary_type", _S),
    ("city", _S),
    ("headcount", _I),
    ("education", _S),
    ("experience", _S),
    ("category", _S),
    ("url", _S),
    ("posted_date", _S),
    ("fetched_at", _S),
)

# The columns of the four marts.
SKILL_DEMAND_MONTHLY = _struct(
    ("skill", _S, False),
    ("year_month", _S, False),
    ("postings", _L, False),
)
SKILL_OVERVIEW = _struct(
    ("skill", _S, False),
    ("category", _S),
    ("total_postings", _L, False),
    ("latest_month", _S),
    ("latest_count", _L),
    ("prev_count", _L),
    ("mom_pct", _D),
)
SKILL_SALARY_BENCHMARK = _struct(
    ("skill", _S, False),
    ("region", _S, False),
    ("seniority", _S, False),
    ("p25", _D),
    ("p50", _D),
    ("p75", _D),
    ("sample_size", _L, False),
)
MARKET_KPI = _struct(
    ("metric", _S, False),
    ("value", _D),
)

MARTS: dict[str, T.StructType] = {
    "skill_demand_monthly": SKILL_DEMAND_MONTHLY,
    "skill_overview": SKILL_OVERVIEW,
    "skill_salary_benchmark": SKILL_SALARY_BENCHMARK,
    "market_kpi": MARKET_KPI,
}


def check_columns(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Raise unless `df` has exactly the schema's columns and types, in order."""
    want = [(f.name, f.dataType) for f in schema]
    have = [(f.name, f.dataType) for f in df.schema]
    if want != have:
        raise ValueError(f"{name}: expected {_show(want)}, got {_show(have)}")
    return df


def _show(fields: list) -> str:
    return ", ".join(f"{n} {t.simpleString()}" for n, t in fields)
