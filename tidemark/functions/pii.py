"""Removal of e-mail addresses and phone numbers from free text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import once


class Rule(NamedTuple):
    """A pattern and its replacement. `hints` are literals, one of which every match contains;
    a text without any is left alone without running the pattern over it."""

    pattern: str
    replacement: str
    hints: tuple[str, ...] = ()


# Patterns and replacements, applied in order. (?U) makes \d and \s cover
# full-width digits and ideographic spaces. What a match starts with is looked at before anything
# that costs more, and a run before an @ is not gone back into.
EMAIL_RULE = Rule(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email-removed]", ("@",))
PHONE_RULE = Rule(
    r"(?U)(?=[+08])(?<!\d)(?:\+?886[-\s]?|0)\d{1,2}[-\s]?\d{3,4}[-\s]?\d{3,4}(?!\d)",
    "[phone-removed]",
    ("0", "886"),
)
PARITY_RULES = (EMAIL_RULE, PHONE_RULE)

# Own rule: mobiles written in three groups, which the rule above leaves in the text.
MOBILE_RULE = Rule(
    r"(?U)(?=[+08])(?<!\d)(?:\+?886[-\s]?|0)9\d{2}[-\s]?\d{3}[-\s]?\d{3}(?!\d)",
    "[phone-removed]",
    ("09", "886"),
)
DEFAULT_RULES = (EMAIL_RULE, PHONE_RULE, MOBILE_RULE)


def scrub(text: Column, rules: Sequence[tuple] = DEFAULT_RULES) -> Column:
    """Apply the rules in order; null and empty text stay as they are."""
    for rule in rules:
        text = _apply(Rule(*rule), text)
    return text


def _apply(rule: Rule, text: Column) -> Column:
    if not rule.hints:
        return F.regexp_replace(text, rule.pattern, rule.replacement)
    replaced = lambda t: F.regexp_replace(t, rule.pattern, rule.replacement)
    hinted = lambda t: reduce(or_, [t.contains(h) for h in rule.hints])
    return once(text, lambda t: F.when(hinted(t), replaced(t)).otherwise(t))
