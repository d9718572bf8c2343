"""Gazetteer of terms and the expression that finds them in a text.

An alias of letters, digits, space and ``. + # /`` (ASCII, lower case) is *bounded*: it must
not touch another ``[a-z0-9]``. Any other alias is a *substring*. Since the boundary class is
the same as the word class, the longest ``[a-z0-9]+`` run of a bounded alias, its anchor, is a
whole word of every text the alias occurs in. Any other alias is anchored by its first two
characters (or its only one). So a text is cut into its distinct words and runs once, these are looked
up among the anchors by hash, and only the aliases of the anchors found are looked at again: the time
does not grow with the gazetteer. Every row is handled on its own: no join, no shuffle, no Python.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import once

BOUNDED, SUBSTRING = "bounded", "substring"

_WORD = re.compile("[a-z0-9]+")
# Fixed value: the characters of a bounded alias.
_BOUNDED_ALIAS = re.compile("[a-z0-9 .+#/]+")


@dataclass(frozen=True)
class Alias:
    canonical: str
    category: str
    alias: str
    mode: str

    @property
    def anchor(self) -> str | None:
        """Longest word of a bounded alias; None where it has no word."""
        words = _WORD.findall(self.alias) if self.mode == BOUNDED else []
        return max(words, key=len, default=None)


class Gazetteer:
    """Terms in order, each with its category and aliases."""

    def __init__(self, aliases: Iterable[Alias]):
        seen: dict[Alias, None] = {}
        for a in aliases:
            text = a.alias.strip().lower()
            if text:
                seen[replace(a, alias=text)] = None
        self.aliases = tuple(seen)
        # A term listed twice keeps its first position and its last category.
        self.categories: dict[str, str] = {}
        for a in self.aliases:
            self.categories[a.canonical] = a.category
        self.terms = tuple(self.categories)

    @classmethod
    def from_mapping(
        cls,
        tree: Mapping[str, Mapping[str, Iterable[str]]],
        modes: Mapping[str, str] | None = None,
    ) -> Gazetteer:
        """From category -> term -> aliases. `modes` sets the mode of single aliases."""
        modes = {k.strip().lower(): v for k, v in (modes or {}).items()}

        def mode(alias: str) -> str:
            text = alias.strip().lower()
            return modes.get(text) or (BOUNDED if _BOUNDED_ALIAS.fullmatch(text) else SUBSTRING)

        return cls(
            Alias(str(term), str(category), str(alias), mode(str(alias)))
            for category, terms in tree.items()
            for term, aliases in terms.items()
            for alias in aliases
        )

    @classmethod
    def from_yaml(cls, path: str, modes: Mapping[str, str] | None = None) -> Gazetteer:
        """From a YAML file of category -> term -> aliases."""
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls.from_mapping(yaml.safe_load(f), modes)

    def dim(self, spark: SparkSession) -> DataFrame:
        """(skill, category), one row per term."""
        return spark.createDataFrame(list(self.categories.items()), "skill string, category string")

    def table(self, spark: SparkSession) -> DataFrame:
        """(skill, category, alias, mode, position), one row per alias, for the join form of matching."""
        at = {term: i for i, term in enumerate(self.terms)}
        rows = [(a.canonical, self.categories[a.canonical], a.alias, a.mode, at[a.canonical]) for a in self.aliases]
        return spark.createDataFrame(rows, "skill string, category string, alias string, mode string, position long")

    def matches(self, text: Column) -> Column:
        """array<string> of the terms found in the text, each once, in gazetteer order.

        The text is taken as it is; lower-case it first (see functions.text.full_text).
        """
        position = {term: i + 1 for i, term in enumerate(self.terms)}
        words: dict[str, dict] = {}
        runs: dict[str, dict] = {}
        for a in self.aliases:
            where = position[a.canonical]
            table, anchor = (words, a.anchor) if a.anchor is not None else (runs, a.alias[:2])
            entry = table.setdefault(anchor, {"sure": [], "check": []})
            # Without a word there is no letter or digit to touch, except around it.
            pattern = _bounded_pattern(a.alias) if a.mode == BOUNDED else None
            if anchor == a.alias and (table is words or pattern is None):
                entry["sure"].append(where)
            else:
                entry["check"].append({"alias": a.alias, "pattern": pattern, "position": where})
        if not self.aliases:
            return F.array().cast("array<string>")

        def found(text: Column) -> Column:
            parts = []
            if words:
                parts.append(_anchored(text, F.split(text, "[^a-z0-9]+"), words))
            if runs:
                parts.append(_anchored(text, _runs(text, runs), runs))
            positions = F.sort_array(F.array_distinct(F.concat(*parts)))
            return F.transform(positions, lambda i: F.element_at(F.lit(list(self.terms)), i))

        return once(F.coalesce(text, F.lit("")), found)


def _bounded_pattern(alias: str) -> str:
    # The literal comes first, so that the matcher skips along the text by it and looks at the
    # characters around a hit only.
    literal = alias.replace("\\E", r"\E\\E\Q")
    return rf"\Q{literal}\E(?<![a-z0-9]\Q{literal}\E)(?![a-z0-9])"


def char_class(characters: Iterable[str], ranges: int = 4) -> str:
    """Class of a pattern with the characters, and with the ones between where those behind U+00FF are in more ranges.
    Up to there they are named one by one, which is one look-up in a table."""
    points = sorted({ord(c) for c in characters})
    near, far = [p for p in points if p < 256], [p for p in points if p > 255]
    gaps = sorted((a - b, a, b) for a, b in zip(far, far[1:], strict=False) if b - a > 1)[: ranges - 1]
    cuts = sorted((a, b) for _, a, b in gaps)
    spans = zip([*far[:1], *(b for _, b in cuts)], [*(a for a, _ in cuts), *far[-1:]], strict=True)
    return "[" + "".join(f"\\x{{{p:x}}}" for p in near) + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


def _class(characters: Iterable[str]) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(set(characters))) + "]"


def _runs(text: Column, anchors: Iterable[str]) -> Column:
    """The characters of the text, and every two that stand side by side, that may be one of the anchors:
    one constant pattern looks for the first and second characters of anchors at every place."""
    one = [a for a in anchors if len(a) == 1]
    two = [a for a in anchors if len(a) == 2]
    parts = []
    if one:
        parts.append(F.regexp_extract_all(text, F.lit(f"({_class(one)})"), 1))
    if two:
        pattern = f"(?=({_class(a[0] for a in two)}{_class(a[1] for a in two)}))"
        parts.append(F.regexp_extract_all(text, F.lit(pattern), 1))
    return F.concat(*parts)


def _anchored(text: Column, parts: Column, anchored: dict[str, dict]) -> Column:
    """Positions of the terms whose anchor is one of the parts of the text: those of aliases that are
    the anchor, and those of longer aliases that are found in the text."""
    check = "struct<alias:string,pattern:string,position:int>"
    entry = _hash_table(anchored, f"struct<sure:array<int>,check:array<{check}>>")
    entries = F.filter(F.transform(F.array_distinct(parts), entry), lambda e: e.isNotNull())

    def positions(e: Column) -> Column:
        # A pattern is compiled for each row and alias, so only for aliases that do occur.
        hits = F.filter(e["check"], lambda c: F.when(F.contains(text, c["alias"]), c["pattern"].isNull() | F.rlike(text, c["pattern"])))
        return F.concat(e["sure"], F.transform(hits, lambda c: c["position"]))

    return F.flatten(F.transform(entries, positions))


def _hash_table(mapping: dict[str, dict], ddl: str):
    """word -> its entry or null, from a constant. A map is searched from end to end, so the entries
    are dealt out by checksum to an array of maps of a few entries each. from_json on a literal is
    folded by the optimizer."""
    buckets: list[dict] = [{} for _ in range(max(len(mapping) // 2, 1))]
    for word, entry in mapping.items():
        buckets[zlib.crc32(word.encode()) % len(buckets)][word] = entry
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{ddl}>>")

    def lookup(word: Column) -> Column:
        bucket = F.get(table, (F.crc32(word) % len(buckets)).cast("int"))
        return F.try_element_at(bucket, word)

    return lookup
