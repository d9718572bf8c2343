"""Mergeable aggregates: demand bitmaps and pay counts against counting the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bitmaps as B
from tidemark.operators import marts as M

SCHEMA = "skill string, category string, source string, job_id string, year_month string, region string, seniority string, salary_monthly_mid double"


@pytest.fixture(scope="module")
def skills(spark):
    rng = random.Random(5)
    out = []
    for i in range(4000):
        job, month = str(rng.randrange(900)), rng.choice([None, "2024-01", "2024-02", "2024-03"])
        skill = "hot" if rng.random() < 0.4 else rng.choice("abc")
        out.append((skill, "c", rng.choice("st"), job, month, rng.choice("xy"), rng.choice(["junior", "senior"]), rng.choice([None, 20_000.0 + rng.randrange(9), 50_000.4])))
    return spark.createDataFrame(out, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_bitmaps_equal_distinct_counts(skills):
    numbers = B.number_postings(skills)
    assert numbers.count() == numbers.select(B.NUMBER).distinct().count() == skills.select(*B.KEY).distinct().count()
    got = B.rollup_from_bitmaps(B.demand_bitmaps(skills, numbers))
    assert rows(got) == rows(M.demand_rollup(skills))
    assert rows(M.overview_from_rollup(got)) == rows(M.skill_overview(skills))
    assert rows(M.monthly_from_rollup(got)) == rows(M.demand_monthly(skills))


def test_loads_put_together_equal_one_load(skills):
    parts = [skills.filter(F.pmod(F.xxhash64("job_id", "skill"), F.lit(3)) == i) for i in range(3)]
    numbers, made = None, []
    for p in parts:  # a posting may be in several loads, and keeps its number
        before = numbers
        numbers = B.number_postings(p, numbers)
        if before is not None:
            assert before.exceptAll(numbers).count() == 0
        made.append(B.demand_bitmaps(p, numbers))
    assert numbers.select(B.NUMBER).distinct().count() == skills.select(*B.KEY).distinct().count()
    merged = B.merge_bitmaps(B.merge_bitmaps(made[0], made[1]), made[2])
    assert rows(B.rollup_from_bitmaps(merged)) == rows(M.demand_rollup(skills))
    assert rows(B.rollup_from_bitmaps(B.merge_bitmaps(merged, made[1]))) == rows(M.demand_rollup(skills))


def test_rows_are_not_expanded_and_shuffled_once(skills):
    numbers = B.number_postings(skills)
    plan = B.demand_bitmaps(skills, numbers)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Window" not in plan
    # By posting for the join, and the partial bitmaps; the table of numbers may be broadcast instead.
    assert plan.count("Exchange hashpartitioning") <= 3


def test_empty_tables(skills):
    none = skills.limit(0)
    numbers = B.number_postings(none)
    assert numbers.count() == 0 and B.rollup_from_bitmaps(B.demand_bitmaps(none, numbers)).count() == 0
    assert B.number_postings(skills, numbers).count() == skills.select(*B.KEY).distinct().count()


def test_added_pay_counts_equal_one_load(skills):
    whole = rows(M.salary_benchmark(skills))
    a, b = skills.filter("job_id < '4'"), skills.filter("job_id >= '4'")
    kept = M.merge_counts(M.pay_counts(a), M.pay_counts(b))
    assert rows(M.benchmark_from_counts(kept)) == whole and len(whole) > 8
    back = M.pay_counts(b).withColumn("n", -F.col("n"))
    assert rows(M.benchmark_from_counts(M.merge_counts(kept, back))) == rows(M.salary_benchmark(a))
