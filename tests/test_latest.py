"""Keep-latest operators: against the window form, and their properties."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import dedup_key, dedup_latest, dedup_located, latest_located, latest_version, upsert_latest, upsert_located

SCHEMA = (
    "source string, job_id string, company string, title string, region string, "
    "posted_date string, fetched_at string"
)


@pytest.fixture(scope="module")
def postings(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        company = rng.choice(["Acme", " acme ", None, "", "B"])
        if rng.random() < 0.4:  # one key with many copies
            company, title, region = "Hot", "Hot", "r"
        else:
            title, region = rng.choice(["Dev", "dev ", "Ops"]), rng.choice(["r", "s", "t"])
        day = rng.choice([None, *(f"2024-01-{d:02d}" for d in range(1, 6))])
        fetched = rng.choice([None, "2024-02-01", "2024-02-02"])
        rows.append((rng.choice("ab"), str(i), company, title, region, day, fetched))
    return spark.createDataFrame(rows, SCHEMA)


def by_hand(df):
    """The latest row of each key from the collected rows, in plain Python."""
    keyed = df.select("*", F.struct(*dedup_key()).alias("_key")).collect()
    groups = {}
    for r in keyed:
        groups.setdefault(tuple(r._key), []).append(r)
    out = []
    for own in groups.values():
        rank = lambda r: [(v is not None, v or "") for v in (r.posted_date, r.fetched_at, r.source, r.job_id)]
        days = [r.posted_date for r in own if r.posted_date is not None]
        last = max(own, key=rank)
        out.append((*last[:-1], min(days, default=None), max(days, default=None), len(own)))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_dedup_equals_the_rows_by_hand(postings):
    assert rows(dedup_latest(postings)) == by_hand(postings)


def test_times_seen_add_up(postings):
    assert dedup_latest(postings).agg(F.sum("times_seen")).first()[0] == postings.count()


def test_dedup_is_idempotent_and_order_free(postings):
    once = dedup_latest(postings).select(postings.columns)
    assert rows(dedup_latest(once).select(postings.columns)) == rows(once)
    shuffled = postings.repartition(7).orderBy(F.desc("job_id"))
    assert rows(dedup_latest(shuffled)) == rows(dedup_latest(postings))


def test_full_ties_are_decided_by_the_rest_of_the_row(spark):
    a = ("s", "1", "c", "t", "r", "2024-01-01", "f")
    b = ("s", "1", "C", "T", "r", "2024-01-01", "f")
    for order in ([a, b], [b, a]):
        got = dedup_latest(spark.createDataFrame(order, SCHEMA)).collect()
        assert len(got) == 1 and (got[0].company, got[0].times_seen) == ("c", 2)


VERSIONS = "source string, job_id string, fetched_at string, title string"


def test_upsert_replaces_the_whole_row(spark):
    old = spark.createDataFrame(
        [("a", "1", "t1", "x"), ("a", "2", "t1", "x"), ("a", "3", "t9", "keep")], VERSIONS
    )
    new = spark.createDataFrame(
        [("a", "1", "t2", None), ("a", "2", "t1", "new"), ("a", "3", "t2", "late"), ("b", "1", None, "n")],
        VERSIONS,
    )
    got = upsert_latest(old, new)
    assert got.columns == old.columns
    assert rows(got) == [
        ("a", "1", "t2", None), ("a", "2", "t1", "new"), ("a", "3", "t9", "keep"), ("b", "1", None, "n"),
    ]
    assert rows(upsert_latest(got, new)) == rows(got)
    assert rows(latest_version(got)) == rows(got)


# The same on narrow rows

@pytest.fixture(scope="module")
def on_disk(spark, postings, tmp_path_factory):
    def write(df, name, parts=3):
        path = str(tmp_path_factory.mktemp("latest") / name)
        df.repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_located_dedup_equals_the_rows_by_hand(postings, on_disk):
    df = on_disk(postings, "a").filter("job_id IS NOT NULL").withColumn("region", F.concat("region", F.lit("!")))
    assert rows(dedup_located(df)) == by_hand(postings.withColumn("region", F.concat("region", F.lit("!"))))
    # Order columns decide every row here, so the place of a row in its file is never asked.
    assert rows(dedup_located(df, content=False)) == rows(dedup_located(df))


def test_located_ties_do_not_depend_on_files(spark, on_disk):
    tied = [("s", "1", c, "t", "r", "2024-01-01", "f") for c in ("c", "C", " c", "c ")] * 5
    found = {str(rows(dedup_located(on_disk(spark.createDataFrame(own, SCHEMA), "t", n)))) for own in (tied, tied[::-1]) for n in (1, 2, 5)}
    assert len(found) == 1 and "20)" in found.pop()


def test_located_keys_tell_nulls_and_lengths_apart(spark, on_disk):
    df = on_disk(spark.createDataFrame([("a", "b", "1"), ("ab", "", "1"), (None, "b", "1"), ("", "b", "1"), ("a", "b", "2"), (None, None, None)], "x string, y string, t string"), "k")
    assert len(rows(latest_located(df, ("x", "y"), ("t",)))) == 5
    assert rows(latest_located(df, ("x", "y"), ("t",))) == rows(latest_version(df, ("x", "y"), ("t",)))


def test_located_upsert_equals_upsert(spark, on_disk):
    rng = random.Random(6)
    versions = [(rng.choice("ab"), str(rng.randrange(40)), rng.choice([None, "t1", "t2", "t3"]), f"x{i}") for i in range(400)]
    old, new = (on_disk(spark.createDataFrame(v, VERSIONS).dropDuplicates(["source", "job_id", "fetched_at"]), "v") for v in (versions[:250], versions[250:]))
    got = upsert_located(old, new)
    assert got.columns == old.columns and rows(got) == rows(upsert_latest(old, new))
    assert rows(upsert_located(old, on_disk(new.limit(0), "e"))) == rows(latest_version(old))


def test_no_long_column_is_sorted(postings, on_disk):
    df = on_disk(postings.withColumn("description", F.repeat("title", 50)), "p")
    for content in (False, True):
        plan = dedup_located(df, content=content)._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if " Sort [" in line or "SortAggregate" in line or "HashAggregate" in line or "SortMergeJoin" in line:
                assert "description" not in line
        assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan
    narrow = dedup_located(df, content=False)._jdf.queryExecution().executedPlan().toString()
    assert sum("ReadSchema" in x and "description" in x for x in narrow.splitlines()) == 1
