"""Versions of the marts and look-ups in them."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.terms import Gazetteer
from tidemark.operators import marts as M
from tidemark.plans import pipeline
from tidemark.sources import lake

TERMS = Gazetteer.from_mapping({"c": {"Py": ["py"], "Go": ["go"]}})
MARTS = ("skill_demand_monthly", "skill_overview", "skill_salary_benchmark", "market_kpi")


def bronze(spark, n):
    rows = [("s", str(i), f"py go {i}", f"co{i}", "2024-01-05", "2024-02-01") for i in range(n)]
    return spark.createDataFrame(rows, "source string, job_id string, title string, company string, posted_date string, fetched_at string")


def seen(spark, gold):
    version = lake.current_version(spark, gold)
    kpi = {r.metric: r.value for r in lake.read_mart(spark, gold, "market_kpi", version).collect()}
    overview = {r.skill: r.total_postings for r in lake.read_mart(spark, gold, "skill_overview", version).collect()}
    return kpi["total_postings"], overview


def test_readers_see_one_run(spark, tmp_path, monkeypatch):
    root, gold = str(tmp_path), str(tmp_path / "gold")
    pipeline.run(bronze(spark, 3), root, TERMS)
    assert seen(spark, gold) == (3.0, {"Py": 3, "Go": 3})
    old = lake.read_mart(spark, gold, "skill_overview")
    # The third mart fails: the four of the run before are still the current ones.
    with monkeypatch.context() as m:
        m.setattr(M, "salary_benchmark", lambda *_, **__: spark.range(1))
        with pytest.raises(ValueError):
            pipeline.run(bronze(spark, 4), root, TERMS)
    assert seen(spark, gold) == (3.0, {"Py": 3, "Go": 3})
    pipeline.run(bronze(spark, 5), root, TERMS)
    assert seen(spark, gold) == (5.0, {"Py": 5, "Go": 5})
    assert old.count() == 2  # a reader of the version before is not disturbed
    pipeline.run(bronze(spark, 6), root, TERMS)
    assert len(os.listdir(gold + "/versions")) == lake.KEPT_VERSIONS and seen(spark, gold)[0] == 6.0


def test_two_writers_never_share_a_version(spark, tmp_path):
    gold = str(tmp_path)
    a, b = lake.new_version(spark, gold), lake.new_version(spark, gold)
    assert a != b and lake.current_version(spark, gold) is None
    lake.commit_version(spark, gold, b)
    assert lake.current_version(spark, gold) == b
    with pytest.raises(Exception, match="exist"):
        lake.commit_version(spark, gold, b)


def test_marts_without_versions_are_read_as_before(spark, tmp_path):
    df = spark.createDataFrame([("total_postings", 1.0)], "metric string, value double")
    df = df.select(F.coalesce("metric", F.lit("")).alias("metric"), "value")
    lake.write_mart(df, "market_kpi", root=str(tmp_path))
    assert lake.read_mart(spark, str(tmp_path), "market_kpi").count() == 1


def scanned(df):
    """Rows that the scan of a written plan put out."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collect()
    node = plan
    while node.children().size():
        node = node.children().head()
    return node.metrics().get("numOutputRows").get().value()


def test_lookup_skips_row_groups_and_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake, "MART_GROUP_BYTES", 16 << 10)
    rows = spark.range(200_000).select(F.concat(F.lit("skill "), F.lpad((F.col("id") * 7919 % 5000).cast("string"), 5, "0")).alias("skill"),
                                       F.concat(F.lit("20"), F.lpad((F.col("id") % 40).cast("string"), 2, "0"), F.lit("-01")).alias("year_month"), F.col("id").alias("postings"))
    lake.write_mart(rows, "skill_demand_monthly", root=str(tmp_path))
    mart = lake.read_mart(spark, str(tmp_path), "skill_demand_monthly")
    one = mart.where("skill = 'skill 01234'")
    assert "PushedFilters: [IsNotNull(skill), EqualTo(skill,skill 01234)]" in one._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", True)
    assert one.count() == 40
    read, every = scanned(mart.where("skill = 'skill 01234'")), mart.count()
    assert every == 200_000 and read < every / 10
