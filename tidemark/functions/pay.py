"""Pay unit, monthly pay and the plausibility band."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import once

# Pay unit labels of the flat source, and the words looked for in free text
# (in this order) by the nested one. The word for "negotiable" is common to both.
UNIT_LABELS = {"月薪": "month", "年薪": "year", "時薪": "hour", "日薪": "day", "論件計酬": "piece"}
UNIT_WORDS = {"月薪": "month", "年薪": "year", "時薪": "hour", "日薪": "day"}
NEGOTIABLE_WORD = "面議"
NEGOTIABLE = "negotiable"

# Hours and days of a month, months of a year, band of plausible monthly pay.
MONTHLY_FACTORS = {"month": 1, "hour": 176, "day": 22}
MONTHLY_DIVISORS = {"year": 12.0}
PAY_BAND = (10_000, 1_000_000)


def unit_from_label(label: Column, labels: Mapping[str, str] = UNIT_LABELS) -> Column:
    """Unit of an exact label, else negotiable where the word occurs, else null."""

    def unit(text: Column) -> Column:
        exact = F.coalesce(*[F.when(text == k, F.lit(v)) for k, v in labels.items()])
        return F.coalesce(exact, F.when(text.contains(NEGOTIABLE_WORD), F.lit(NEGOTIABLE)))

    return once(label, unit)


def unit_from_text(text: Column, words: Mapping[str, str] = UNIT_WORDS) -> Column:
    """Negotiable where the word occurs, else the first unit word found, else null."""
    return F.coalesce(
        F.when(text.contains(NEGOTIABLE_WORD), F.lit(NEGOTIABLE)),
        *[F.when(text.contains(k), F.lit(v)) for k, v in words.items()],
    )


def to_monthly(
    amount: Column,
    unit: Column,
    factors: Mapping[str, float] = MONTHLY_FACTORS,
    divisors: Mapping[str, float] = MONTHLY_DIVISORS,
) -> Column:
    """Amount per month. A unit that neither table knows (piece, negotiable, null) gives null."""
    known = {u: amount * f if f != 1 else amount for u, f in factors.items()}
    known |= {u: amount / d for u, d in divisors.items()}
    return F.coalesce(*[F.when(unit == u, per_month) for u, per_month in known.items()])


def mid_pay(low: Column, high: Column) -> Column:
    """Mean of both bounds, else the one that exists."""
    return F.coalesce((low + high) / 2.0, low, high)


def banded(amount: Column, band: tuple[float, float] = PAY_BAND) -> Column:
    """The amount inside the closed band, else null."""
    return F.when(amount.between(*band), amount)
