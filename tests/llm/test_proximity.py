"""Benchmark decontamination: proximity against brute force, and repetitive test texts."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import decontaminate as D

LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return PLAIN.findall((text or "").translate(LOW))


def near_items(rows, items, size=10, near=8):
    """Items with a window of which two of the rarest terms that occur stand near their places."""
    n = Counter(w for _, t in rows for w in plain(t))
    pairs = defaultdict(set)
    for item, text in items:
        w = plain(text)
        length = min(size, len(w))
        for start in range(len(w) - length + 1) if w and item is not None else ():
            own = sorted((n[w[o]], o) for o in range(start, start + length) if n[w[o]])[: D.RAREST]
            pairs[str(item)].update((w[a], w[b], b - a) for _, a in own for _, b in own if a != b)
    out = Counter()
    for doc_id, text in rows:
        at = defaultdict(list)
        for i, x in enumerate(plain(text)):
            at[x].append(i)
        out[(doc_id, sum(any(p != q and abs(q - p - gap) <= near for a, b, gap in own for p in at[a] for q in at[b]) for own in pairs.values()))] += 1
    return out


def checked(spark, documents, rows, items):
    found = D.decontaminate(documents(rows), spark.createDataFrame(items, "item_id long, text string"))
    got = Counter((r.doc_id, r.n_near) for r in found.collect())
    assert got == near_items([r[:2] for r in rows], items)
    return dict(got)


def test_near_equals_brute_force(spark, documents, sample):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)] + ["of", "the"] * 60
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(25)] + [(90, "never one seen two"), (91, "unseen alone"), (92, "of"), (None, "of the"), (93, None)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 300)))) for i in range(60)] + [(None, rows_text) for rows_text in ("of the", items[0][1])]
    rows += [(200 + i, " ".join(["far"] * (250 + i) + items[i][1].split() + ["end"])) for i in range(20)]
    checked(spark, documents, rows + [(r[0], r[1]) for r in sample[:30]], items)


def test_any_one_changed_word_of_a_window_is_found(spark, documents):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    changed = [(i, " ".join(["pad"] * 20 + item[:i] + ["XX"] + item[i + 1 :] + ["pad"] * 20)) for i in range(10)]
    put_in = [(20 + i, " ".join(item[:i] + ["one", "two"] + item[i:])) for i in range(1, 10)]
    left_out = [(40 + i, " ".join(item[:i] + item[i + 1 :])) for i in range(10)]
    clean = [(60, "alpha " + "pad " * 30 + "beta"), (61, "pad pad"), (62, None)]
    found = D.decontaminate(documents(changed + put_in + left_out + clean), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    near = {r.doc_id for r in found.where("n_near > 0").collect()}
    assert near == {i for i, _ in changed + put_in + left_out} and found.where("contaminated").count() == 0


def test_repetitive_items_take_no_memory(spark, documents):
    rng = random.Random(9)
    item = " ".join(f"r{rng.randrange(60)}" for _ in range(2000))
    rows = [(i, f"before {item} between {item}") for i in range(20)] + [(50, " ".join(f"r{rng.randrange(60)}" for _ in range(300))), (51, "clean")]
    found = {r.doc_id: r for r in D.decontaminate(documents(rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert all(found[i].n_hit == 4000 and found[i].items == ["1"] and found[i].n_near == 1 for i in range(20))
    assert found[50].n_hit == 0 and not found[51].contaminated


def test_rows_of_a_long_text_are_bounded(spark, documents):
    item = "one two three four five six seven eight nine ten"
    text = " ".join([item] * 3000)
    found = D.decontaminate(documents([(1, text)]), spark.createDataFrame([(7, item), (8, "four five")], "item_id long, text string"))
    r = found.select("n_words", "n_hit", F.array_join("items", ",").alias("i"), "n_near").first()
    assert tuple(r) == (30_000, 30_000, "7,8", 2)
