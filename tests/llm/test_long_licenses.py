"""License templates of any length, against all blocks."""

import random
import re
from collections import Counter

from tidemark.llm import licenses

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def stride_of(n):
    s = licenses.STRIDE
    while s < n:
        s *= 2
    return s


def expected(rows, templates, percent):
    """(doc_id, labels) by looking at every block of every document."""
    out = Counter()
    for doc_id, text in rows:
        w, found = PLAIN.findall((text or "").lower()), set()
        for label, texts in templates.items():
            for t in texts:
                own = PLAIN.findall(t.lower())
                s, words = stride_of(len(own)), set(own)
                if any(100 * len(words & set(w[b : b + 2 * s])) >= percent * len(words) for b in range(0, max(len(w), 1), s)):
                    found.add(label)
        out[(doc_id, ",".join(sorted(found)))] += 1
    return out


def made(rng, n, vocabulary):
    return [rng.choice(vocabulary) if rng.random() < 0.6 else f"u{rng.randrange(10**6)}" for _ in range(n)]


def test_templates_of_any_length_equal_all_blocks(spark, documents):
    rng = random.Random(4)
    common = [f"c{i}" for i in range(80)]
    templates = {f"l{n}": (" ".join(made(rng, n, common)),) for n in (5, 31, 32, 33, 160, 700, 1600)}
    rows = [(i, " ".join(made(rng, rng.randrange(400), common))) for i in range(20)]
    for k, (label, (text,)) in enumerate(templates.items()):
        for j, share in enumerate((0.0, 0.1, 0.2, 0.4)):
            w = [x if rng.random() >= share else "zz" for x in text.split()]
            rows.append((100 * k + 1000 + j, " ".join(made(rng, rng.randrange(300), common) + w + made(rng, 50, common))))
    for percent in (85, 60):
        got = licenses.scan_licenses(documents(rows), templates, percent)
        assert Counter((r.doc_id, r.labels) for r in got.collect()) == expected(rows, templates, percent)
    table = spark.createDataFrame([(a, t, 3) for a, ts in templates.items() for t in ts] + [(None, "x", 1), ("none", None, 1), ("blank", " . ", 1)], "label string, text string, stride int")
    assert Counter((r.doc_id, r.labels) for r in licenses.scan_licenses(documents(rows), table).collect()) == expected(rows, templates, 85)


def test_words_beyond_the_plan_are_joined(spark, documents, monkeypatch):
    rng = random.Random(5)
    templates = {"a": (" ".join(f"w{i}" for i in range(600)),), "b": (" ".join(f"w{i}" for i in range(300, 700)),)}
    rows = [(i, " ".join(f"w{j}" for j in range(700) if rng.random() < share)) for i, share in enumerate((0.5, 0.8, 0.87, 0.95, 1.0))] + [(9, None), (None, "w1")]
    want = expected(rows, templates, 85)
    for few, limit in ((10, 10**6), (10, 10)):
        monkeypatch.setattr(licenses, "FEW_WORDS", few)
        monkeypatch.setattr(licenses, "BROADCAST_WORDS", limit)
        assert Counter((r.doc_id, r.labels) for r in licenses.scan_licenses(documents(rows), templates).collect()) == want


def test_no_templates(documents):
    rows = [(1, "the mit license"), (2, "x")]
    assert {r.doc_id: r.labels for r in licenses.scan_licenses(documents(rows), {"a": (" ",)}).collect()} == {1: "mit", 2: ""}
