"""The pipeline's decontamination stage against brute force, with repeated and null ids."""

import re
from collections import Counter

import corpus_pipeline


def test_decontamination_tells_rows_by_id_and_text(spark, documents, tmp_path):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = [(1, passage), (2, "one two")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"x {passage} y"), (1, "clean text"), (1, "clean text"), (2, f"z {passage}"), (3, "nothing here"), (4, None), (4, "so one two it is"),
            (None, f"{passage} again"), (None, "clean without an id"), (None, None), (None, "one TWO"), (5, ""), (5, "One, two")]

    def words(text):
        return re.findall("[a-z]+", (text or "").lower())

    def holds(text):
        w = words(text)
        return any(w[i : i + len(p)] == p for p in (words(t) for _, t in items) for i in range(len(w)))

    docs = documents(rows)
    got = corpus_pipeline.benchmark_passages(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((d, t) for d, t in rows if not holds(t))


ROWS = [
    (1, "a b c d e f g h i j k l m n o p q r s t", "s1"), (1, "a b c d e f g h i j k l m n o p q r s t", "s1"), (2, "a b c d e f g h i j k l m n o p q r s t", "s2"),
    (3, "a b c d e f g h i j k l m n o p q r s u", "s1"), (4, "other words that stand here alone and are not like any one of the rest", "s1"),
    (4, "a second text of the same id with words enough to stay in the corpus", None), (None, "a text without an id that is long enough to stay where it is", "s2"),
    (None, None, None), (5, None, "s1"), (6, "", "s2"), (7, "too short", "s1"), (8, "again and again " * 30, "s3"), (9, " \n\t", "s3"),
    (10, "x " * 5 + "alpha beta gamma delta epsilon zeta eta theta iota kappa y z", "s1"),
]


def tables(spark, path, items=((1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),)):
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 0), (8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def repeated(words):
    """Words in five-word windows found twice or more, the first included."""
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({j for own in places.values() if len(own) > 1 for i in own for j in range(i, i + 5)})


def shingles(text):
    w = split((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_every_stage_on_nulls_and_repeated_ids(spark, documents, tmp_path):
    sf = tables(spark, tmp_path)
    docs = documents(ROWS)
    # Quality: without labelled rows of both kinds no threshold holds, so the fixed rules alone decide.
    kept = corpus_pipeline.quality(spark, docs, sf)
    good = [r for r in ROWS if len(split(r[1])) >= 10 and 100 * repeated(split(r[1])) <= 20 * len(split(r[1]))]
    assert kept.columns == docs.columns and rows_of(kept) == Counter(good) and len(good) == 8

    # Near duplicates: one id of each group stays, with all its rows.
    near = corpus_pipeline.near_duplicates(spark, kept, sf)
    sets = [(r[0], shingles(r[1])) for r in good if r[0] is not None]
    gone = {b for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 75 * len(x | y)}
    assert near.columns == docs.columns and rows_of(near) == Counter(r for r in good if r[0] not in gone) and gone == {2, 3}

    clean = corpus_pipeline.benchmark_passages(spark, near, sf)
    left = [r for r in good if r[0] not in gone and r[0] != 10]
    assert rows_of(clean) == Counter(left)

    # Mixing: what the corpus holds is what the mix takes, by id, text and source.
    mixed = corpus_pipeline.source_weights(spark, clean, sf)
    taken = Counter()
    for r in corpus_pipeline.mixing.mixture(clean).select("doc_id", "source", "size", "taken").collect():
        taken[(r.doc_id, r.source)] += r.taken
    got = Counter()
    for r in mixed.select("doc_id", "source", "text").collect():
        got[(r.doc_id, r.source)] += len(split(r.text))
    assert mixed.columns == docs.columns and got == +taken and sum(got.values()) > 0

    tokens = corpus_pipeline.token_ids(spark, mixed, sf).collect()
    assert len(tokens) == mixed.count() and min(t.start for t in tokens) == 0
    assert max(t.start + t.n_tokens for t in tokens) == sum(t.n_tokens for t in tokens)


def test_a_text_of_two_sources_is_read_for_both(spark, documents, tmp_path):
    docs = documents([(1, "a b c d", "s1"), (1, "a b c d", "s2"), (2, "e f g h", "s2"), (3, "i j", None)])
    mixed = corpus_pipeline.source_weights(spark, docs, str(tmp_path))
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(split(r.text))
    taken = {r.source: r.n for r in corpus_pipeline.mixing.mixture(docs).groupBy("source").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "n").collect()}
    assert words == +Counter(taken) and words["s1"] > 0 and words["s2"] > 0


def test_every_stage_on_an_empty_table(spark, documents, tmp_path):
    sf, docs = tables(spark, tmp_path), documents([])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0, name
        docs = docs if name == "token ids" else out
