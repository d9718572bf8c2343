"""Feed queries: order, bounds and missing data."""

import pytest

from tidemark.plans import feeds
from tidemark.schemas import SKILL_DEMAND_MONTHLY, SKILL_OVERVIEW, SKILL_SALARY_BENCHMARK


@pytest.fixture(scope="module")
def overview(spark):
    rows = [
        ("z", "x", 10, "2024-02", 5, 4, 25.0), ("y", "x", 10, "2024-02", 5, 4, 25.0),
        ("w", "v", 4, "2024-02", 4, 1, 300.0), ("u", "v", 99, None, None, None, None),
        ("O'Neil %s", "v", 6, "2024-02", 1, 2, -50.0),
    ]
    return spark.createDataFrame(rows, SKILL_OVERVIEW)


@pytest.fixture(scope="module")
def monthly(spark):
    rows = [("a", "2024-02", 2), ("a", "2024-01", 1), ("A", "2024-01", 7), ("b", "2024-02", 3)]
    return spark.createDataFrame(rows, SKILL_DEMAND_MONTHLY)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [
        ("a", "ALL", "ALL", 1.0, 2.0, 3.0, 5), ("b", "ALL", "ALL", 1.0, 9.0, 9.0, 5),
        ("c", "ALL", "ALL", None, None, None, 5), ("a", "r", "ALL", 1.0, 7.0, 9.0, 5),
        ("a", "ALL", "mid", 1.0, 8.0, 9.0, 5),
    ]
    return spark.createDataFrame(rows, SKILL_SALARY_BENCHMARK)


def names(df):
    return [r[0] for r in df.collect()]


def test_skills(overview):
    assert names(feeds.skills(overview)) == ["u", "y", "z", "O'Neil %s", "w"]
    assert names(feeds.skills(overview, category="v", limit=2)) == ["u", "O'Neil %s"]
    assert names(feeds.skills(overview, category="x' OR '1'='1")) == []


def test_trending(overview):
    assert names(feeds.trending(overview)) == ["y", "z", "O'Neil %s"]
    assert names(feeds.trending(overview, min_postings=1, limit=1)) == ["w"]


def test_trend(monthly):
    assert [tuple(r) for r in feeds.trend(monthly, "a").collect()] == [("2024-01", 1), ("2024-02", 2)]
    assert feeds.trend(monthly, "none").collect() == []
    with pytest.raises(LookupError):
        feeds.trend(monthly, "none", require=True)


def test_salary(benchmark):
    assert names(feeds.salary(benchmark)) == ["b", "a", "c"]
    assert [r.p50 for r in feeds.salary(benchmark, skill="a", region="r").collect()] == [7.0]
    assert [r.p50 for r in feeds.salary(benchmark, seniority="mid").collect()] == [8.0]


@pytest.mark.parametrize(
    "call",
    [lambda o, b: feeds.skills(o, limit=0), lambda o, b: feeds.skills(o, limit=501),
     lambda o, b: feeds.trending(o, limit=101), lambda o, b: feeds.salary(b, limit=501)],
)
def test_limits_are_bounded(overview, benchmark, call):
    with pytest.raises(ValueError):
        call(overview, benchmark)


def test_kpi(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0)], "metric string, value double")
    assert names(feeds.kpi(df)) == ["a", "b"]


def test_skill_medians(benchmark):
    got = {tuple(r) for r in feeds.skill_medians(benchmark, ["a", "b", "none"]).collect()}
    assert got == {("a", 2.0), ("b", 9.0)}


def test_trend_pivot(monthly):
    df = feeds.trend_pivot(monthly, ["a", "b", "none"])
    assert df.columns == ["year_month", "a", "b", "none"]
    assert {tuple(r) for r in df.collect()} == {("2024-01", 1, None, None), ("2024-02", 2, 3, None)}
