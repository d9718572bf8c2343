"""Text, number and date expressions of the parse and clean stages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seniority rules in order (label, pattern), and the label when none matches.
SENIORITY_RULES = (
    ("senior", "5年|資深|senior|10年|7年"),
    ("mid", "2年|3年|4年|mid"),
)
SENIORITY_DEFAULT = "junior"

# Own rules: the same labels from the first number of years in the text, and from the words
# in any letter case. Offered beside the fixed ones, under which "12年" is mid and "8年" junior.
YEARS_RULES = (
    ("senior", r"(?iu)資深|senior|(?<!\d)0*([5-9]|[1-9]\d+)\s*年"),
    ("mid", r"(?iu)\bmid|(?<!\d)0*[2-4]\s*年"),
)

# Region patterns and the label when none matches.
CITY_PATTERN = r"(?d)^(.{2,3}?[市縣])[\s\S]*$"
REGION_PATTERN = r"(遠端|.{2,3}?[市縣])"
REGION_DEFAULT = "其他"

# Unicode white space plus the four separators U+001C..U+001F.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# A number that is not negative, with underscores between digits allowed.
_DIGITS = "[0-9]+(?:_[0-9]+)*"
_NUMBER = rf"\+?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_WIDE_DIGITS, _PLAIN_DIGITS = "０１２３４５６７８９", "0123456789"


def once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """fn(value) with the value computed once per row, however often fn uses it. Without this
    the optimizer copies the expression to every use, also into the branches of a condition."""
    return F.get(F.transform(F.array(value), fn), 0)


def strip(text: Column) -> Column:
    """Trim Unicode white space (F.trim takes ASCII spaces only)."""
    return F.btrim(text, F.lit(_SPACES))


def none_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def parse_number(value: Column, commas: bool = True) -> Column:
    """Positive finite double, or null. `commas` drops thousands commas first."""
    # translate drops a character that has no counterpart
    text = F.translate(value.cast("string"), _WIDE_DIGITS + ("," if commas else ""), _PLAIN_DIGITS)
    digits = F.regexp_extract(strip(text), rf"\A({_NUMBER})\z", 1)
    number = F.translate(digits, "_", "").try_cast("double")
    return F.get(F.filter(F.array(number), lambda n: (n > 0) & (n < float("inf"))), 0)


def headcount(value: Column, commas: bool = True) -> Column:
    """Whole part of a positive number as int; zero is null."""
    whole = parse_number(value, commas).try_cast("int")
    return once(whole, lambda n: F.when(n != 0, n))


def city_prefix(city: Column) -> Column:
    """Leading 2-3 characters up to 市 or 縣, else the whole trimmed text; empty is null."""
    return F.when(city != "", F.regexp_replace(strip(city), CITY_PATTERN, "$1"))


def region_extract(city: Column) -> Column:
    """First city-like match anywhere in the text, else the default label."""
    hit = F.regexp_extract(F.coalesce(city, F.lit("")), REGION_PATTERN, 1)
    return once(hit, lambda h: F.when(h == "", F.lit(REGION_DEFAULT)).otherwise(h))


def iso_date(value: Column, digits_only: bool = False) -> Column:
    """Eight characters yyyymmdd to yyyy-mm-dd, else null. `digits_only` drops other
    characters first. The date itself is not checked."""
    def dashed(text: Column) -> Column:
        parts = [F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)]
        return F.when(F.length(text) == 8, F.concat_ws("-", *parts))

    text = value.cast("string")
    return once(F.regexp_replace(text, r"(?U)\D", ""), dashed) if digits_only else dashed(text)


def year_month(posted: Column, fetched: Column) -> Column:
    return F.coalesce(F.substring(posted, 1, 7), F.substring(fetched, 1, 7))


def bucket_rules(
    text: Column,
    rules: Sequence[tuple[str, str]] = SENIORITY_RULES,
    default: str = SENIORITY_DEFAULT,
) -> Column:
    """Label of the first rule whose pattern is found in the text (null counts as empty)."""
    text = F.coalesce(text, F.lit(""))
    return F.coalesce(
        *[F.when(text.rlike(pattern), F.lit(label)) for label, pattern in rules],
        F.lit(default),
    )


def full_text(*parts: Column) -> Column:
    """Lower-cased parts joined by a space; a null part keeps its separator."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def join_present(*parts: Column, sep: str = " | ") -> Column:
    """Join the non-empty parts; concat_ws skips nulls."""
    return F.concat_ws(sep, *[none_if_empty(p) for p in parts])


def utc_now_iso() -> Column:
    """Time of the query as an ISO string in UTC."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
