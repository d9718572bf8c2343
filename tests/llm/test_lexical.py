"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical

LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def expected(docs, items, top=10):
    held = [(d, Counter(w), len(w)) for d, t in docs if (w := terms(t))]
    n_docs, n_words, df = len(held), sum(n for *_, n in held), Counter(x for _, c, _ in held for x in c)
    out = Counter()
    for item, text in set(items):
        scores = []
        for d, c, n in held:
            m = 100 - 75 + 75 * n * n_docs // n_words
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1_000_000_000 * c[x] // (1000 * c[x] + 8 * m)) for x, k in Counter(terms(text)).items() if c[x])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out.update((item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top]))
    return out


def rows_of(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.fixture(scope="module")
def items(sample):
    rng = random.Random(4)
    words = [w for _, t, *_ in sample for w in terms(t)[:60]]
    made = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(40)]
    return made + [(100 + i, " ".join(terms(t)[5:30]).upper()) for i, (_, t, *_) in enumerate(sample[:20])] + [
        (200, None), (201, ""), (202, "...!"), (203, "no-such-wordx"), (204, "the the the of"), (205, "one two"), (205, "one two"), (205, "other"), (None, "one"), (206, "É é")]


def test_ranks_equal_brute_force(spark, documents, sample, items, monkeypatch):
    docs = [(r[0], r[1]) for r in sample]
    asked = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in items], "item_id long, text string, score long, terms string, rank int")
    want = expected(docs, items)
    assert rows_of(lexical.search_documents(documents(sample), asked)) == want and len(want) > 300
    # Many small shards and blocks of items.
    monkeypatch.setattr(lexical, "SHARD_DOCS", 7)
    assert rows_of(lexical.search_documents(documents(sample), asked, block_terms=200)) == want


def test_search_skips_nothing_that_ranks():
    rng = np.random.default_rng(2)
    for trial in range(150):
        n, v = int(rng.integers(1, 400)), 12
        share = rng.random(v) ** 2
        lists = [(t, np.flatnonzero(rng.random(n) < share[t])) for t in range(v)]
        lists = [(t, d) for t, d in lists if len(d)]
        if not lists:
            continue
        impacts = [rng.integers(1, 5 if trial % 2 else 900, len(d)) for _, d in lists]
        ids = rng.permutation(n).astype(np.int64)
        shard = lexical.Shard(ids, np.zeros(n, np.uint8), np.array([t for t, _ in lists]), np.concatenate([[0], np.cumsum([len(d) for _, d in lists])]),
                              np.concatenate([d for _, d in lists]), np.concatenate(impacts).astype(np.int64))
        asked = np.sort(rng.choice(v + 3, int(rng.integers(1, v)), replace=False))
        weights = rng.integers(0, 40, len(asked))
        best = lexical.Best(10)
        lexical.search(shard, asked, weights, best, window=int(rng.integers(3, 200)))
        scores = np.zeros(n, np.int64)
        for (t, d), x in zip(lists, impacts, strict=True):
            scores[d] += x * int(weights[asked == t].sum())
        want = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if s > 0)[:10]
        assert [(-s, i) for s, i in zip(best.scores.tolist(), best.ids.tolist(), strict=True)] == want


def test_empty_tables(spark, documents, sample):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical.search_documents(documents([]), items).count() == 0
    found = lexical.search_documents(documents(sample), items.limit(0))
    assert found.count() == 0 and dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
