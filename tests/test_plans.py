"""Physical plans: what is shuffled, what is broadcast, what reaches the scan."""

import pytest

from checks.queries import QUERIES
from checks.views import PART_TERMS
from tidemark.operators import bitmaps
from tidemark.operators import marts as M
from tidemark.operators.latest import dedup_latest
from tidemark.operators.terms import term_extract
from tidemark.sources import lake
from checks import views as V

SF = "/root/testdata/sf0.001"
WRITING = {"bronze_scan", "bronze_landing", "bronze_merge", "bronze_intake", "silver_roundtrip", "mart_sink", "stage_counts"}
# Readers of JSON arrays in byte ranges are Python.
PYTHON = {"parse_flat_json", "parse_nested_json"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def norm(spark):
    return lake.staged(V.norm(spark, SF), "norm")


@pytest.fixture(scope="module")
def skills(norm):
    return lake.staged(term_extract(norm, PART_TERMS), "skills")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING - PYTHON))
def test_no_query_runs_python_or_a_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


def test_term_extract_shuffles_nothing_and_matches_once(norm):
    text = plan(term_extract(norm, PART_TERMS))
    assert " Exchange " not in text and "BroadcastHashJoin" in text
    assert text.count("[^a-z0-9]+") == 1  # the words of a text are cut once


def test_term_extract_reads_only_its_columns(norm):
    text = plan(term_extract(norm, PART_TERMS))
    assert "description" not in text and "times_seen" not in text


def test_dedup_combines_before_its_only_shuffle(norm):
    text = plan(dedup_latest(norm))
    assert text.count(" Exchange hashpartitioning") == 1
    assert text.index("functions=[max(") < text.index(" Exchange ") < text.index("functions=[partial_max(")
    assert "Window" not in text


def test_demand_marts_read_the_rows_once(skills):
    text = plan(M.skill_overview(skills))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 3
    assert "SortAggregate(key=[skill" not in text.split("Window")[-1]  # distinct counts are hashed


def test_benchmark_reads_the_rows_once_and_pushes_the_filter(skills):
    text = plan(M.salary_benchmark(skills))
    assert text.count("FileScan") == 1
    assert "PushedFilters: [IsNotNull(salary_monthly_mid)]" in text
    assert "ReadSchema: struct<skill:string,region:string,seniority:string,salary_monthly_mid:double>" in text
    # Shuffles: counts by cell and amount, those counts by grain and amount, and by group.
    assert text.count("Exchange hashpartitioning") == 3
    # The grains multiply counts, not rows: the first aggregate and its shuffle lie below the expansion.
    assert "Exchange hashpartitioning" in text[text.index("Expand") :]


def test_kpi_reads_the_postings_once_more_after_its_sketch(norm, skills):
    text = plan(M.market_kpi(norm, skills))
    assert text.count("FileScan") == 2  # the postings for the median, the long table for its terms
    assert "ReadSchema: struct<salary_monthly_mid:double>" in text


def test_bitmaps_shuffle_the_long_table_once(norm, skills):
    numbers = bitmaps.number_postings(norm)
    text = plan(bitmaps.demand_bitmaps(skills, numbers))
    assert "Expand" not in text and text.count("FileScan") == 2
    assert "ReadSchema: struct<skill:string,source:string,job_id:string,year_month:string,category:string>" in text


def test_term_join_is_an_equi_join_on_anchors(spark):
    text = plan(QUERIES["term_match_join"](spark, SF))
    assert "salt" in text and "anchor" in text and "Python" not in text


def test_feeds_take_the_top_without_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["feed_skills"](spark, SF))


def test_kpi_keeps_no_sketch_by_company(norm, skills, monkeypatch):
    plans, first = [], type(norm).first
    monkeypatch.setattr(type(norm), "first", lambda df: plans.append(plan(df)) or first(df))
    M.market_kpi(norm, skills)
    plans.append(plan(M.market_kpi(norm, skills, accuracy=1000)))
    assert sum("percentile_approx" in p for p in plans) == 2
    aggregates = [line for p in plans for line in p.splitlines() if "percentile_approx" in line]
    assert not [a for a in aggregates if "company" in a]


def test_both_loads_of_the_merged_benchmark_read_one_long_table(spark, monkeypatch):
    plans, staged = [], lake.staged
    monkeypatch.setattr(lake, "staged", lambda df, name: plans.append(plan(df)) or staged(df, name))
    QUERIES["salary_benchmark_merged"](spark, SF)
    assert sum("lineitem" in p for p in plans) == 1


def test_lines_of_an_order_are_shuffled_by_order_once(spark):
    text = plan(V.order_texts(spark, SF))
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1 and "partial_collect_set(p_name" in text
