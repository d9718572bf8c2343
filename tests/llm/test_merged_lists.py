"""Steps of the n-gram join that decide how much it shuffles."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import ngram_join

PERCENT = 75


def may_link(x, y):
    (_, _, n1, p1), (_, _, n2, p2) = x, y
    return 100 * min(n1, n2) >= PERCENT * max(n1, n2) and (100 + PERCENT) * min(n1 - p1, n2 - p2) >= PERCENT * (n1 + n2)


def postings(rows):
    kinds = {"shingle": pa.int64(), "doc_id": pa.int64(), "n": pa.int32(), "pos": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], list(kinds))


@pytest.mark.parametrize("seed", range(40))
def test_short_lists_end_as_pairs_and_long_ones_keep_every_member(seed):
    rng = random.Random(seed)
    rows = [(k, rng.randint(0, 60), n := rng.randint(8, 14), rng.randint(0, n // 4))
            for k in range(rng.randint(1, 8)) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 10, 40]))]
    cuts = sorted(rng.choices(range(len(rows) + 1), k=rng.randint(0, 12)))
    batches = [postings(rows[a:b]) for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
    got = [tuple(x.values()) for b in ngram_join._merged(PERCENT)(iter(batches)) for x in b.to_pylist()]
    want = []
    for k in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == k]
        if len(own) <= ngram_join.SMALL:
            want += [(None, *y[1:], *x[1:]) for j, y in enumerate(own) for x in own[:j] if x[1] != y[1] and may_link(x, y)]
        else:
            want += [(*r, *own[0][1:]) for r in own]
    order = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_wide_signatures_rule_out_large_sets_and_no_link(spark):
    rng = np.random.default_rng(3)
    pairs, linked = [], []
    for i, n in enumerate([1, 3, 64, 65, 500, 511, 512, 513, 600, 1024, 1025, 5000] * 3):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for apart in (0, n // 8, n // 7, n):  # members that b has instead of a's, and, every other time, none instead
            more = rng.integers(0, 1 << 63, apart if i % 2 else 0, dtype=np.uint64)
            b = np.unique(np.concatenate([a[apart:], more]))
            if len(b):
                pairs.append((len(pairs), len(a), ngram_join._wide(a).tolist(), len(b), ngram_join._wide(b).tolist()))
                both = len(np.intersect1d(a, b))
                linked.append((100 * both >= PERCENT * (len(a) + len(b) - both), both))
    df = spark.createDataFrame(pairs, "i int, a_n long, a_wide array<long>, b_n long, b_wide array<long>")
    kept = {r.i for r in df.where(ngram_join._wide_allow(PERCENT)).collect()}
    assert kept >= {i for i, (links, _) in enumerate(linked) if links}
    assert not kept & {i for i, (_, both) in enumerate(linked) if not both and pairs[i][1] >= 500}
