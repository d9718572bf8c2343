"""Landing, silver and mart tables."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import lake


def postings(spark, *rows):
    return spark.createDataFrame(rows, "source string, job_id string, title string, fetched_at string")


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_landing_a_key_again_replaces_it(spark, tmp_path, fmt):
    path = str(tmp_path / "bronze")
    lake.land_bronze(postings(spark, ("s", "1", "old", "t1"), ("s", "2", "only", "t1")), path, fmt)
    lake.land_bronze(postings(spark, ("s", "1", None, "t2"), ("u", "1", "other", "t1")), path, fmt)
    latest = lake.scan_bronze(spark, path, fmt)
    assert latest.columns == schemas.POSTING.names
    got = {(r.source, r.job_id): r.title for r in latest.collect()}
    assert got == {("s", "1"): None, ("s", "2"): "only", ("u", "1"): "other"}
    assert lake.scan_bronze(spark, path, fmt, latest=False).count() == 4
    lake.compact_bronze(spark, path, str(tmp_path / "compact"), fmt)
    compact = lake.scan_bronze(spark, str(tmp_path / "compact"), fmt, latest=False)
    assert sorted(map(str, compact.collect())) == sorted(map(str, latest.collect()))


def test_source_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    lake.land_bronze(postings(spark, ("s", "1", "a", "t"), ("u", "1", "b", "t")), path)
    rows = lake.scan_bronze(spark, path, latest=False).filter("source = 'u'")
    assert "PartitionFilters: [isnotnull(source" in plan(rows) and rows.count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_object_per_posting(spark, tmp_path):
    for source, job, extra in (("s", "1", {"salary_min": 5}), ("u", "9", {"unknown": True})):
        folder = tmp_path / "bronze" / source
        folder.mkdir(parents=True)
        body = {"source": source, "job_id": job, "headcount": None, **extra}
        (folder / f"{source}-{job}.json").write_text(json.dumps(body, indent=2))
    df = lake.scan_bronze_objects(spark, str(tmp_path / "bronze" / "*" / "*.json"))
    assert df.columns == schemas.POSTING.names
    assert {(r.source, r.job_id, r.salary_min) for r in df.collect()} == {("s", "1", 5.0), ("u", "9", None)}


def test_silver_roundtrip_overwrites(spark, tmp_path):
    for n in (3, 2):
        lake.write_silver(spark.range(n), str(tmp_path), "t")
    assert lake.read_silver(spark, str(tmp_path), "t").count() == 2


def demand(spark, *rows, types="skill string, year_month string, postings long"):
    return spark.createDataFrame(rows, types)


def test_mart_write_and_read(spark, tmp_path):
    lake.write_mart(demand(spark, ("a", "2024-01", 1)), "skill_demand_monthly", str(tmp_path))
    got = lake.read_mart(spark, str(tmp_path), "skill_demand_monthly")
    assert [tuple(r) for r in got.collect()] == [("a", "2024-01", 1)]


def test_mart_columns_and_types_are_checked(spark, tmp_path):
    wrong_type = demand(spark, ("a", "2024-01", 1), types="skill string, year_month string, postings int")
    wrong_order = demand(spark, ("a", "2024-01", 1)).select("year_month", "skill", "postings")
    for df in (wrong_type, wrong_order):
        with pytest.raises(ValueError, match="skill_demand_monthly"):
            lake.write_mart(df, "skill_demand_monthly", str(tmp_path))


def test_mart_null_in_a_key_fails_the_write(spark, tmp_path):
    with pytest.raises(Exception, match="skill_demand_monthly.year_month is null"):
        lake.write_mart(demand(spark, ("a", None, 1)), "skill_demand_monthly", str(tmp_path))


def test_mart_target_is_one_of_two(spark, tmp_path):
    df = demand(spark, ("a", "2024-01", 1))
    for target in ({}, {"root": str(tmp_path), "jdbc": {"url": "x"}}):
        with pytest.raises(ValueError):
            lake.write_mart(df, "skill_demand_monthly", **target)


def test_jdbc_options(spark, monkeypatch):
    """No database here: only what the writer is told."""
    seen = {}

    class Writer:
        def mode(self, m):
            return seen.update(mode=m) or self

        def format(self, f):
            return seen.update(format=f) or self

        def options(self, **o):
            return seen.update(o) or self

        def save(self):
            seen["saved"] = True

    class Checked:
        write = Writer()

    monkeypatch.setattr(lake, "check_mart", lambda df, name: Checked())
    lake.write_mart(None, "market_kpi", jdbc={"url": "jdbc:x", "user": "u"})
    assert seen == {"mode": "overwrite", "format": "jdbc", "url": "jdbc:x", "user": "u",
                    "dbtable": "market_kpi", "truncate": "true", "saved": True}


def test_staged_tables_go_to_the_folder_the_session_names(spark, tmp_path):
    class Conf:
        def get(self, key, default):
            assert key == "spark.checkpoint.dir"
            return str(tmp_path)

    class Session:
        conf = Conf()

    assert lake.new_folder(Session(), "x").startswith(str(tmp_path))
    assert lake.staged(spark.range(3), "t").agg(F.sum("id")).first()[0] == 3


def test_record_cap_needs_a_limit(spark):
    from tidemark.sources import flat

    with pytest.raises(TypeError):
        flat.record_cap(spark.range(3), "id")
    assert flat.record_cap(spark.range(9), "id", limit=2).count() == 2


def test_scratch_removes_what_is_not_kept(spark):
    import os

    rows = spark.range(10).toDF("x")
    before = spark.conf.get(lake.RELEASE, "false")
    with lake.scratch(spark) as outer:
        with lake.scratch(spark) as inner:
            gone, early = lake.staged(rows, "gone"), lake.staged(rows, "early")
            inner.drop(early)
            assert not os.path.exists(early.staged_path)
            kept = inner.keep(gone.where("x > 3").groupBy("x").count(), "kept")
        assert not os.path.exists(gone.staged_path) and kept.count() == 6
        result = outer.keep(kept, "result")
    assert not os.path.exists(kept.staged_path) and result.count() == 6
    with pytest.raises(ValueError), lake.scratch(spark):
        lost = lake.staged(rows, "lost")
        raise ValueError
    assert not os.path.exists(lost.staged_path) and spark.conf.get(lake.RELEASE) == before
