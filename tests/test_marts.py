"""Marts on small frames with results worked out by hand, and exact percentiles by brute force."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.errors import SparkRuntimeException

from tidemark.operators import marts as M
from tidemark.operators.percentiles import exact_quantile, pay_percentiles

SKILLS = (
    "skill string, source string, job_id string, year_month string, region string, "
    "seniority string, salary_monthly_mid double, company string, title string, category string"
)


def skill_row(skill, job, month, region="r", seniority="mid", pay=None, source="s"):
    return (skill, source, job, month, region, seniority, pay, "c", "t", f"cat-{skill[0]}")


@pytest.fixture(scope="module")
def skills(spark):
    rows = [
        skill_row("a", "1", "2024-01"), skill_row("a", "2", "2024-01"),
        skill_row("a", "2", "2024-01"),  # the same posting twice counts once
        skill_row("a", "1", "2024-03"), skill_row("a", "3", "2024-03"), skill_row("a", "4", "2024-03"),
        skill_row("a", "5", None),
        skill_row("a", "5", "2024-03", source="other"),
        skill_row("b", "1", None), skill_row("b", "2", None),
        skill_row("c", "1", "2024-02"),
    ]
    return spark.createDataFrame(rows, SKILLS)


def test_demand_monthly(skills):
    want = {("a", "2024-01", 2), ("a", "2024-03", 4), ("c", "2024-02", 1)}
    assert {tuple(r) for r in M.demand_monthly(skills).collect()} == want
    assert {tuple(r) for r in M.monthly_from_rollup(M.demand_rollup(skills)).collect()} == want


def test_skill_totals(skills):
    got = {tuple(r) for r in M.skill_totals(skills).collect()}
    assert got == {("a", "cat-a", 6), ("b", "cat-b", 2), ("c", "cat-c", 1)}


def test_overview(skills):
    got = {r.skill: tuple(r)[1:] for r in M.skill_overview(skills).collect()}
    assert got == {
        "a": ("cat-a", 6, "2024-03", 4, 2, 100.0),
        "b": ("cat-b", 2, None, None, None, None),  # no month: totals only
        "c": ("cat-c", 1, "2024-02", 1, None, None),
    }


def test_overview_against_the_calendar_month(skills):
    got = {r.skill: tuple(r)[3:] for r in M.skill_overview(skills, calendar=True).collect()}
    assert got["a"] == ("2024-03", 4, None, None)  # 2024-02 has no postings


def test_mom_rounds_half_up_to_one_digit(spark):
    monthly = spark.createDataFrame(
        [("a", "2024-01", 8), ("a", "2024-02", 9), ("a", "2024-03", 6), ("b", "2024-01", 1)],
        "skill string, year_month string, postings long",
    )
    got = {(r.skill, r.year_month): (r.prev_count, r.mom_pct) for r in M.mom_change(monthly).collect()}
    assert got == {
        ("a", "2024-01"): (None, None), ("a", "2024-02"): (8, 12.5), ("a", "2024-03"): (9, -33.3),
        ("b", "2024-01"): (None, None),
    }


def disc(values, p):
    """Smallest value with a cumulative share of at least p."""
    ordered = sorted(values)
    return ordered[max(math.ceil(p * len(ordered)), 1) - 1]


@pytest.fixture(scope="module")
def paid(spark):
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        # A third of the rows are one skill with one pay; the others vary in cents.
        hot = rng.random() < 0.34
        pay = 42000.0 if hot else rng.choice([None, round(rng.uniform(10000, 99999), 2), 55000.5])
        skill = "hot" if hot else rng.choice(["a", "b", "rare"] if i < 4 else ["a", "b"])
        rows.append(
            skill_row(skill, str(i), "2024-01", rng.choice(["x", "y", None, "ALL"]),
                      rng.choice(["junior", "mid", "senior"]), pay)
        )
    return rows


def rounded_half_up(x):
    return float(math.floor(x + 0.5))


def test_benchmark_by_brute_force(spark, paid):
    groups = defaultdict(list)
    for r in paid:
        if r[6] is not None:
            for key in ((r[0], "*", "*"), (r[0], r[4], "*"), (r[0], "*", r[5])):
                groups[key].append(r[6])
    want = sorted(
        (tuple("ALL" if k == "*" else k for k in key)
         + tuple(rounded_half_up(disc(v, p)) for p in (0.25, 0.5, 0.75)) + (len(v),)
         for key, v in groups.items() if len(v) >= 3),
        key=str,
    )
    got = M.salary_benchmark(spark.createDataFrame(paid, SKILLS))
    assert got.columns == ["skill", "region", "seniority", "p25", "p50", "p75", "sample_size"]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_percentiles_exact_and_sketched(spark, paid):
    df = spark.createDataFrame(paid, SKILLS)
    exact = sorted(map(tuple, pay_percentiles(df, ["skill"]).collect()))
    sketched = sorted(map(tuple, pay_percentiles(df, ["skill"], accuracy=1_000_000).collect()))
    assert exact == sketched
    coarse = pay_percentiles(df, ["skill"], accuracy=1000)
    assert coarse.columns == ["skill", "p25", "p50", "p75", "sample_size"]
    assert M.salary_benchmark(df, accuracy=1_000_000).count() == M.salary_benchmark(df).count()


@pytest.mark.parametrize("p", [0.01, 0.25, 0.5, 0.99, 1.0])
def test_exact_quantile(spark, p):
    rng = random.Random(11)
    data = [rng.choice([round(rng.uniform(1, 9), 3), 4.25]) for _ in range(1001)]
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double")
    assert exact_quantile(df, "v", p, "q", band=(1, 9)).collect()[0].q == disc(data, p)


def test_values_outside_the_band_fail(spark):
    df = spark.createDataFrame([(4.25,), (50_000.0,)], "v double")
    with pytest.raises(SparkRuntimeException, match="v outside"):
        exact_quantile(df, "v", 0.5, "q").collect()


def test_exact_quantile_without_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert [r.q for r in exact_quantile(df, "v", 0.5, "q").collect()] == [None]


def test_market_kpi(spark, skills):
    postings = spark.createDataFrame(
        [("A", 30000.5), ("a", 40000.0), (None, None), (None, 20000.0), ("A", 50000.0)],
        "company string, salary_monthly_mid double",
    )
    want = {"total_postings": 5.0, "distinct_skills": 3.0, "distinct_companies": 3.0,
            "median_monthly_salary": 30000.5}
    assert {r.metric: r.value for r in M.market_kpi(postings, skills).collect()} == want
    empty = M.market_kpi(postings.limit(0), skills.limit(0))
    assert {r.metric: r.value for r in empty.collect()} == dict.fromkeys(want, 0.0)
    sketched = M.market_kpi(postings, skills, accuracy=1000)
    assert {r.metric: r.value for r in sketched.collect()} == want
