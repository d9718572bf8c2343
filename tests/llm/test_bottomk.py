"""Bottom-k near duplicates against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import bottomk

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text, size=2):
    w = SPACED.findall((text or "").translate(LOW))
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def expected(rows, size=2, percent=80):
    sets = [(r[0], shingles(r[1], size)) for r in rows]
    parent = {a: a for a, _ in sets if a is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return Counter((a, len(x), None if a is None else find(a), a is None or find(a) == a) for a, x in sets)


def rows_of(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_components_equal_brute_force(documents, sample):
    rng = random.Random(3)
    base = [f"t{i}" for i in range(80)]
    rows = sample + [(7000 + i, " ".join(base[: 80 - i % 4] + rng.choices("xyz", k=rng.randint(0, 15)))) for i in range(60)]
    rows += [(7100 + i, rows[-1][1].upper()) for i in range(5)]
    # A passage shared by texts that do not link, and texts of few words around the threshold.
    rows += [(7200 + i, " ".join(base[:30] + [f"own{i}x{j}" for j in range(30)])) for i in range(40)]
    rows += [(7300 + i, " ".join(f"s{x}" for x in sorted(rng.sample(range(9), rng.randint(1, 9))))) for i in range(150)]
    chain = [f"c{i}" for i in range(400)]
    rows += [(7500 + i, " ".join(chain[i * 12 : i * 12 + 200])) for i in range(16)]
    rows += [(7001, "another text of an id that has one"), (None, rows[-1][1]), (None, None)]
    got = rows_of(bottomk.near_duplicates(documents(rows)))
    assert got == expected(rows)
    assert len({c for _, _, c, _ in got}) < len(rows) - 150


def test_empty_table_and_other_thresholds(spark, documents):
    empty = bottomk.near_duplicates(documents([]))
    assert empty.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")] and empty.count() == 0
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcdef", k=rng.randint(3, 9)))) for i in range(120)]
    assert rows_of(bottomk.near_duplicates(documents(rows), 1, 90)) == expected(rows, 1, 90)
    with pytest.raises(ValueError):
        bottomk.near_duplicates(documents(rows), k=8)


def test_every_linked_pair_of_whole_sets_has_a_common_run():
    rng = random.Random(9)
    for _ in range(30_000):
        union = rng.randint(1, 40)
        common = rng.randint(-(-80 * union // 100), union)
        values = np.array(rng.sample(range(1, 1 << 40), union), np.uint64)
        own = rng.sample(range(union), union - common)
        cut = rng.randint(0, len(own))
        a, b = np.sort(np.delete(values, own[:cut])), np.sort(np.delete(values, own[cut:]))
        keys = [{(x, int(v)) for x in bottomk.run_lengths(len(s), 80) for v in bottomk._keys(s, x)} for s in (a, b)]
        assert keys[0] & keys[1] and bottomk.may_link(a, len(a), b, len(b), 64, 80) and bottomk.linked(a, b, 80)


def test_sketches_of_large_sets_find_and_pass_linked_pairs():
    rng = np.random.default_rng(4)
    assert bottomk.missed(64, 80) < 1e-9
    for _ in range(3_000):
        values = rng.integers(1, 1 << 63, rng.integers(120, 900), dtype=np.uint64)
        common = -(-80 * len(values) // 100)
        cut = common + (len(values) - common) // 2
        a, b = np.unique(values[:cut])[:64], np.unique(np.concatenate([values[:common], values[cut:]]))[:64]
        assert set(bottomk._keys(a, 3)) & set(bottomk._keys(b, 3)) and bottomk.may_link(a, cut, b, cut, 64, 80)
