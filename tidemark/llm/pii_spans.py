"""Offset-preserving detection of disguised personal data.

A transducer rewrites a text piece by piece: look-alike letters and digits of other scripts to ASCII,
invisible characters to nothing, spelled digits and `plus` to their signs, and `at` and `dot` in
brackets, or bare where they build an address, to `@` and `.`. Spelled digits are rewritten in runs of two
and more, and alone next to a digit or a dot; what is no identifier the patterns leave out. A run of fewer
than RUN words next to an identifier of the text as it is stays, as in "+1 415 555 0123 two times". A bare
`at` needs a domain with a known last label after it, with dots as signs, words or in brackets.
It keeps, for every piece, where it came from. Identifiers are found in the rewritten text and their ends mapped back to the characters of the source.

Base spans are found in the text as it is and always stay. A span of the rewritten text is added where
it is not equal to, or inside, a base span of its kind. Patterns that would look at a long run again and again
are anchored at its beginning, so time grows with the text.

Null or empty text: no spans. Every row is handled by itself: nulls and repeats in ids are kept, texts of
any length are taken whole, and other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
# A match never begins inside a run of digits: an earlier one would hold it.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        # Nothing before the last match's end can be part of the next one.
        step, start = 64, at
        while start > end:
            low = max(end, at - step)
            own = None
            for own in _NOT_LOCAL.finditer(text, low, at):
                pass
            start = own.end() if own else low
            if own or low == end:
                break
            step *= 4
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            end = domain.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", end)
    return out


def _valid_phone(found: str) -> bool:
    return 10 <= sum(c.isdigit() for c in found) <= 15


def _valid_card(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the identifiers in the text as it is, in order."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if _valid_card(m[0])]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if _valid_phone(m[0])]
    return sorted(out)


# Look-alikes of ASCII letters; fixed values, Cyrillic and then Greek.
_LETTERS = dict(zip("аеорсухіјѕԁһԛԝАВЕКМНОРСТХІЈЅ", "aeopcyxijsdhqwABEKMHOPCTXIJS", strict=True)) | dict(
    zip("οανιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oaviABEZHIKMNOPTYX", strict=True))
_SIGNS = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)} | {"。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "﹫": "@"}
_DIGIT_ROWS = {chr(zero + d): str(d) for zero in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
_NOTHING = dict.fromkeys("­​‌‍⁠﻿", "")
_CHARACTERS = _LETTERS | _SIGNS | _DIGIT_ROWS | _NOTHING
_NUMBER_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

#: Spelled digits of a run that is rewritten even next to an identifier.
RUN = 6

# Last labels that make bare `at` and `dot` an address; fixed values.
_TOP = "com|org|net|edu|gov|info|io|co|eu|uk|de|fr|es|it|nl|ch|at|us|ca|au|in|jp|cn|br|ru"

_character = "[" + "".join(map(re.escape, _CHARACTERS)) + "]"
_number = "|".join(_NUMBER_WORDS)
_apart = r"[ \t,-]{1,3}"
_bracket_dot = r"[ \t]{0,3}[\[({<][ \t]{0,2}(?:dot|\.)[ \t]{0,2}[\])}>][ \t]{0,3}"
_dots = rf"(?: dot |\.|{_bracket_dot})"
_REWRITE = re.compile(
    rf"(?P<character>{_character})"
    rf"|(?P<digits>\b(?:plus[ \t,.-]{{1,3}})?(?:{_number})\b(?:{_apart}(?:{_number})\b)*+)"
    r"|(?P<plus>\bplus[ \t]{1,3}(?=[0-9]))"
    r"|(?P<at>[ \t]{0,3}[\[({<][ \t]{0,2}(?:at|@)[ \t]{0,2}[\])}>][ \t]{0,3})"
    rf"|(?P<dot>{_bracket_dot})"
    rf"|(?P<bare>(?<=[A-Za-z0-9]) at (?=[A-Za-z0-9-]{{1,63}}(?:{_dots}[A-Za-z0-9-]{{1,63}}){{0,4}}{_dots}(?:{_TOP})\b))"
    r"|(?P<bare_dot>(?<=[A-Za-z0-9]) dot (?=[A-Za-z0-9]))",
    re.IGNORECASE | re.ASCII)
# What makes a single spelled digit one: a digit or a dot beside it.
_BEFORE = re.compile(rf"(?:[0-9][ \t,.-]{{1,3}}|(?<=[A-Za-z0-9]) dot |[\[({{<][ \t]{{0,2}}(?:dot|\.)[ \t]{{0,2}}[\])}}>][ \t]{{0,3}}|\b(?:{_number})\.)\Z", re.IGNORECASE | re.ASCII)
_AFTER = re.compile(rf"[ \t,.-]{{1,3}}[0-9]| dot [A-Za-z0-9]|{_bracket_dot}|\.(?:{_number})\b", re.IGNORECASE | re.ASCII)
_GAP = re.compile(r"[ \t,.-]{0,3}")
_CHARACTER = re.compile(_character)
_FAR = re.compile("[\u00ad\u0250-\U0010ffff]")  # holds all of them, and is quicker to look for
_PAIR = re.compile(rf"(?:{_number})(?:[ \t,-]{{1,3}}|\.)(?:{_number})\b|\b(?:{_number}|plus)[ \t,.-]{{1,3}}[0-9]|[0-9][ \t,.-]{{1,3}}(?:{_number})\b")
_AT = re.compile(rf" at [a-z0-9-]{{1,63}}(?:{_dots}[a-z0-9-]{{1,63}}){{0,4}}{_dots}(?:{_TOP})\b")
_BRACKET = re.compile(r"[\[({<][ \t]{0,2}(?:at|AT|At|@|dot|DOT|Dot|\.)[ \t]{0,2}[\])}>]")
_WORDS = tuple(_NUMBER_WORDS) + ("plus",)


def _worth(text: str) -> bool:
    """Whether the text has something to rewrite at all: quick tests, as most texts have nothing."""
    if not text.isascii() and _FAR.search(text) and _CHARACTER.search(text) or _BRACKET.search(text):
        return True
    low = text.lower()
    if " dot " in low or " at " in low and _AT.search(low):
        return True
    return any(w in low for w in _WORDS) and bool(_PAIR.search(low))


_NUMBER = re.compile(rf"plus|{_number}", re.IGNORECASE | re.ASCII)


class Rewritten:
    """The rewritten text, and for the start of each piece its place there and in the source."""

    def __init__(self, source: str, base: list[tuple[int, int, int]] = ()):
        numbers = [(s, e) for s, kind, e in base if kind]
        begins, finishes = {s for s, _ in numbers}, {e for _, e in numbers}
        out, self.starts, self.froms, self.copied, length, at = [], [], [], [], 0, 0

        def piece(new: str, begin: int, end: int, copied: bool):
            nonlocal length
            if new or not copied:
                self.starts.append(length)
                self.froms.append((begin, end))
                self.copied.append(copied)
                out.append(new)
                length += len(new)

        def meant(m):
            """Whether a run of spelled digits is rewritten."""
            n = len(_NUMBER.findall(m[0])) - (m[0][0] in "pP")
            if n >= RUN:
                return True
            before = source[max(m.start() - 3, 0) : m.start()]
            gap = len(before) - len(before.rstrip(" \t,.-"))
            if m.start() - gap in finishes or _GAP.match(source, m.end()).end() in begins:
                return False
            return n > 1 or bool(_AFTER.match(source, m.end()) or _BEFORE.search(source[max(m.start() - 16, 0) : m.start()]))

        for m in _REWRITE.finditer(source):
            if m.lastgroup == "digits" and not meant(m):
                continue
            piece(source[at : m.start()], at, m.start(), True)
            at = m.start()
            if m.lastgroup == "digits":
                for w in _NUMBER.finditer(source, m.start(), m.end()):
                    word = w[0].lower()
                    piece("+" if word == "plus" else _NUMBER_WORDS[word], w.start(), w.end(), False)
                    at = w.end()
            else:
                new = _CHARACTERS[m[0]] if m.lastgroup == "character" else "@" if m.lastgroup in ("at", "bare") else "+" if m.lastgroup == "plus" else "."
                piece(new, m.start(), m.end(), False)
                at = m.end()
        piece(source[at:], at, len(source), True)
        self.text = "".join(out)

    def _piece(self, position: int) -> int:
        # The last piece that begins here: pieces that became nothing are before it.
        return bisect.bisect_right(self.starts, position) - 1

    def source_span(self, start: int, end: int) -> tuple[int, int]:
        i, j = self._piece(start), self._piece(end - 1)
        begin = self.froms[i][0] + (start - self.starts[i] if self.copied[i] else 0)
        finish = self.froms[j][0] + (end - self.starts[j]) if self.copied[j] else self.froms[j][1]
        return begin, finish


def all_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans with those of the rewritten text that no base span of the kind holds."""
    if not _worth(text):
        return base
    rewritten = Rewritten(text, base)
    held: dict[int, tuple[list[int], list[int]]] = {}
    for start, kind, end in base:
        starts, ends = held.setdefault(kind, ([], []))
        starts.append(start), ends.append(end)
    more = set()
    for start, kind, end in base_spans(rewritten.text):
        begin, finish = rewritten.source_span(start, end)
        starts, ends = held.get(kind, ([], []))
        i = bisect.bisect_right(starts, begin) - 1
        if i < 0 or ends[i] < finish:
            more.add((begin, kind, finish))
    return sorted({*base, *more})


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _find(batches):
    for batch in batches:
        counts = {f"n_{k}": [] for k in KINDS}
        digests, spans, found = [], [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = base_spans(text)
            for i, k in enumerate(KINDS):
                counts[f"n_{k}"].append(sum(s[1] == i for s in base))
            digests.append(hashlib.sha256(written(base).encode()).hexdigest())
            every = all_spans(text, base)
            spans.append(written(every))
            found.append(len(every))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), **{k: pa.array(v, pa.int64()) for k, v in counts.items()},
            "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string()), "n_spans": pa.array(found, pa.int64())})


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans (all, as kind:start:end) and n_spans, for
    every row of docs (doc_id, text). Places count characters of the text; ends are exclusive."""
    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_find, f"doc_id long, {kinds}, base_sha256 string, spans string, n_spans long")
