"""Phrase collocations and their automata against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import collocations as C

LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def counted(rows):
    """Counts of phrases of one to three words, and words, of each language."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            f.update(("und" if lang is None else lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return f, n


def expected(rows, least=10, top=2000, share=50):
    f, n = counted(rows)
    out = {}
    chosen = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = Counter()
    for p, a in chosen.items():
        if len(p) == 4:
            for part in ((p[0], *p[1:3]), (p[0], *p[2:])):
                inside[part] = max(inside[part], a)
    for p, a in chosen.items():
        if len(p) == 3 and 100 * inside[p] >= share * a:
            continue
        cuts = []
        for k in range(2, len(p)):
            left, right = f[p[:k]], f[(p[0], *p[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        s, _, left, right = min(cuts)
        out.setdefault(p[0], []).append((-s, -a, " ".join(p[1:]).encode(), left, right))
    return Counter((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, own in out.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:top]))


@pytest.fixture(scope="module")
def texts(sample):
    rng = random.Random(8)
    words = ["Of", "THE", "new", "york", "état", "x-1", "中文", "été\x00", "a", "b"]
    rows = [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return rows + [("en", t) for _, t, *_ in sample] + [("xx", None), (None, ""), ("yy", " .,; \n")]


def frame(spark, rows):
    return spark.createDataFrame([(a, t, 1, "w", 2, "r") for a, t in rows], "lang string, text string, range int, automaton string, k int, w1 string")


def test_collocations_equal_brute_force(spark, texts, monkeypatch):
    # One shard a task; very many with many unions; and ranges reached in two steps.
    for bytes_, pending, fan in ((C.SHARD_BYTES, C.PENDING, C.FAN), (2000, 500, C.FAN), (4000, 3000, 3)):
        monkeypatch.setattr(C, "SHARD_BYTES", bytes_)
        monkeypatch.setattr(C, "PENDING", pending)
        automata = C.count_automata(frame(spark, texts), shard_bytes=bytes_, fan=fan)
        f, n = counted(texts)
        got = {(r.lang, *(x for x in (r.w1, r.w2, r.w3) if x is not None)): r.f for r in automata.select("automaton").mapInArrow(C._rows, C._ROW).collect()}
        assert got == {p: a for p, a in f.items() if a >= 10} | {(lang,): x for lang, x in n.items() if x}
        assert Counter(tuple(r[c] for c in COLUMNS) for r in C.collocations(frame(spark, texts)).collect()) == expected(texts)


def test_other_parameters(spark, texts):
    got = Counter(tuple(r[c] for c in COLUMNS) for r in C.collocations(frame(spark, texts), least=3, top=25, share=80).collect())
    assert got == expected(texts, 3, 25, 80)


def test_empty_table(spark):
    df = C.collocations(frame(spark, []))
    assert df.columns == list(COLUMNS) and df.count() == 0


def test_automaton_holds_its_paths_and_shares_states():
    rng = random.Random(1)
    for size in (0, 1, 5, 400):
        f = Counter()
        for _ in range(size):
            f[(rng.choice(["en", "fr"]), *(rng.choice("abcdé") for _ in range(rng.randint(0, 3))))] += rng.choice([1, 70_000, 5_000_000_000])
        names, words = ["en", "fr"], list("abcdé")
        w = [np.array([words.index(p[i]) + 1 if i < len(p) else 0 for p in f], np.int64) for i in (1, 2, 3)]
        grams = C.Grams(names, pa.array(words, pa.large_string()), np.array([names.index(p[0]) for p in f], np.int64), tuple(w), np.array(list(f.values()), np.int64)).summed()
        made = C.build(grams)
        again = C.paths(made)
        table = [None, *again.words.to_pylist()]
        got = {(again.langs[a], *(table[x] for x in rest if x)): v for a, *rest, v in zip(again.lang.tolist(), *(x.tolist() for x in again.w), again.weight.tolist(), strict=True)}
        assert got == dict(f)
        assert all(C.lookup(made, *p) == v for p, v in f.items()) and C.lookup(made, "en", "zz") == 0 and C.lookup(made, "xx") == 0
        both = C.paths(C.build(C.merged([again, grams]).summed()))
        assert both.weight.sum() == 2 * sum(f.values()) and len(both) == len(f)
    many = C.Grams(["en"], pa.array([f"w{i}" for i in range(2000)], pa.large_string()), np.zeros(4000, np.int64),
                   (np.repeat(np.arange(1, 2001), 2), np.ones(4000, np.int64), np.tile([0, 2], 2000)), np.ones(4000, np.int64)).summed()
    assert len(C.build(many)) < 4000 * 12 and C._unpacked(C.build(many), 0)[0].size == 2000
