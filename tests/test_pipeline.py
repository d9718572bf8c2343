"""Raw files of both sources through landing, silver tables and marts, against results worked
out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.terms import Gazetteer
from tidemark.plans import feeds, pipeline
from tidemark.sources import flat, lake, nested

TERMS = Gazetteer.from_mapping({"lang": {"Python": ["python"], "C++": ["c++"]}, "ops": {"Docker": ["docker"]}})


def record(hire, day, title="Dev", company="Acme", text="python", low="40000", exp="1年"):
    return {
        "OCCU_DESC（a）": title, "COMPNAME（b）": company, "JOB_DETAIL（c）": text, "SALARYCD（d）": "月薪",
        "NT_L（e）": low, "NT_U（f）": low, "CITYNAME（g）": "台北市信義區", "EXPERIENCE（h）": exp,
        "URL_QUERY（i）": f"https://x.example/?HIRE_ID={hire}", "TRANDATE（j）": day,
    }


FLAT = [
    record("1", "20260110"),
    record("2", "20260210", title="dev ", company="ACME", text="python c++"),  # same posting, later
    record("3", "20260215", title="Ops", text="docker", low="60,000", exp="5年以上"),
    record("4", "20260111", title="Lead", text="Python and Docker", low="90000"),
    record("5", "20260212", title="Clerk", text="none"),
    record("6", "20260216", title="Data", text="python", low="5000"),  # pay outside the band
]
NESTED = [
    {"jobId": "9", "data": {
        "header": {"jobName": "Mobile", "custName": "Beta", "appearDate": "20260120"},
        "jobDetail": {"salary": "時薪 500", "salaryMin": 500, "addressRegion": "遠端"},
        "condition": {"workExp": "3年", "skill": [{"description": "Python"}]},
    }},
    {"jobId": "10", "data": {"header": {"custName": "no title"}}},
]


@pytest.fixture(scope="module", params=[False, True])
def lake_root(request, spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for name, records in (("a", FLAT), ("b", NESTED)):
        (root / f"{name}.json").write_text(json.dumps(records, ensure_ascii=False), encoding="utf-8")
    parsed = nested.union_sources(
        flat.parse_flat(flat.read_document(spark, str(root / "a.json")), fetched_at=F.lit("2026-03-01")),
        nested.parse_nested(
            nested.read_payloads(spark, str(root / "b.json"), multi_line=True), fetched_at=F.lit("2026-03-01")
        ),
    )
    bronze = str(root / "bronze")
    lake.land_bronze(parsed, bronze)
    lake.land_bronze(parsed, bronze)  # a second landing of the same postings changes nothing
    counts = pipeline.run(
        lake.scan_bronze(spark, bronze), str(root), TERMS, intermediate=request.param
    )
    return str(root), counts, request.param


def mart(spark, root, name):
    return lake.read_mart(spark, f"{root}/gold", name)


def test_counts(lake_root):
    assert lake_root[1] == {"cleaned": 7, "deduplicated": 6, "with_pay": 5, "skill_rows": 7, "distinct_skills": 3}


def test_silver_tables(spark, lake_root):
    root, _, intermediate = lake_root
    norm = {r.job_id: r for r in lake.read_silver(spark, f"{root}/silver", "postings_norm").collect()}
    assert set(norm) == {"2", "3", "4", "5", "6", "9"}
    kept = norm["2"]
    assert (kept.first_seen, kept.last_seen, kept.times_seen) == ("2026-01-10", "2026-02-10", 2)
    assert kept.full_text == "dev  python c++ 經驗:1年"
    assert norm["9"].region == "遠端" and norm["9"].salary_monthly_mid == 88000.0
    assert norm["6"].salary_monthly_mid is None and norm["6"].salary_monthly_min == 5000.0
    if intermediate:
        assert lake.read_silver(spark, f"{root}/silver", "postings_clean").count() == 7
        dedup = lake.read_silver(spark, f"{root}/silver", "postings_dedup")
        assert dedup.columns[-4:] == ["first_seen", "last_seen", "times_seen", "full_text"]


def test_marts(spark, lake_root):
    root = lake_root[0]
    assert {tuple(r) for r in mart(spark, root, "skill_demand_monthly").collect()} == {
        ("Python", "2026-01", 2), ("Python", "2026-02", 2), ("C++", "2026-02", 1),
        ("Docker", "2026-01", 1), ("Docker", "2026-02", 1),
    }
    assert {tuple(r) for r in mart(spark, root, "skill_overview").collect()} == {
        ("Python", "lang", 4, "2026-02", 2, 2, 0.0), ("C++", "lang", 1, "2026-02", 1, None, None),
        ("Docker", "ops", 2, "2026-02", 1, 1, 0.0),
    }
    # Python has pay 40000, 90000 and 88000; no other group has three postings with pay.
    assert [tuple(r) for r in mart(spark, root, "skill_salary_benchmark").collect()] == [
        ("Python", "ALL", "ALL", 40000.0, 88000.0, 90000.0, 3),
    ]
    assert {r.metric: r.value for r in mart(spark, root, "market_kpi").collect()} == {
        "total_postings": 6.0, "distinct_skills": 3.0, "distinct_companies": 3.0,
        "median_monthly_salary": 60000.0,
    }


def test_feeds_over_the_marts(spark, lake_root):
    root = lake_root[0]
    overview = mart(spark, root, "skill_overview")
    assert [r.skill for r in feeds.skills(overview, category="lang").collect()] == ["Python", "C++"]
    assert [r.skill for r in feeds.trending(overview, min_postings=2).collect()] == ["Docker", "Python"]
    medians = feeds.skill_medians(mart(spark, root, "skill_salary_benchmark"), ["Python", "Docker"])
    assert [tuple(r) for r in medians.collect()] == [("Python", 88000.0)]
