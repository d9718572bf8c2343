"""Batch pipeline: landing table to silver tables to marts.

Rows are shuffled once, for the keep-latest step. Clean runs before it on the scan's tasks and
pay after it on the reducers' tasks, so those stages add no pass; the text the terms are looked
for in is derived after the shuffle instead of being carried through it. Stage counts are
observed on the rows as they are written, so they cost no job and a recomputed task does not
count twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.terms import Gazetteer
from tidemark.operators import marts as M
from tidemark.operators.clean import clean, posting_text
from tidemark.operators.latest import dedup_latest, dedup_located
from tidemark.operators.pay import pay_norm
from tidemark.operators.terms import term_extract
from tidemark.sources import lake

SILVER_TEXT = "full_text"


def postings_norm(bronze: DataFrame, region: Column | None = None) -> DataFrame:
    """Clean, deduplicated and pay-normalized postings."""
    latest = dedup_latest(clean(bronze, region=region, with_text=False))
    return pay_norm(latest.withColumn(SILVER_TEXT, posting_text()))


def posting_skills(bronze: DataFrame, gazetteer: Gazetteer, region: Column | None = None):
    return term_extract(postings_norm(bronze, region), gazetteer)


def run(
    bronze: DataFrame,
    root: str,
    gazetteer: Gazetteer,
    jdbc: Mapping[str, str] | None = None,
    region: Column | None = None,
    intermediate: bool = False,
    accuracy: int | None = None,
) -> dict[str, int]:
    """Write silver tables under `root`/silver and a version of the marts under `root`/gold (or to a
    database), and return the stage counts. `intermediate` also writes the tables before the pay stage."""
    spark = bronze.sparkSession
    silver = f"{root}/silver"
    counts = write_silver_tables(bronze, silver, gazetteer, region, intermediate)
    write_marts(spark, silver, None if jdbc else f"{root}/gold", jdbc, accuracy)
    return counts


def write_silver_tables(
    bronze: DataFrame,
    silver: str,
    gazetteer: Gazetteer,
    region: Column | None = None,
    intermediate: bool = False,
) -> dict[str, int]:
    spark = bronze.sparkSession
    if intermediate:
        lake.write_silver(clean(bronze, region=region), silver, "postings_clean")
        cleaned = lake.read_silver(spark, silver, "postings_clean")
        latest = dedup_located(cleaned.drop(SILVER_TEXT)).withColumn(SILVER_TEXT, posting_text())
        lake.write_silver(latest, silver, "postings_dedup")
        norm = pay_norm(lake.read_silver(spark, silver, "postings_dedup"))
    else:
        norm = postings_norm(bronze, region)

    stage = Observation("postings_norm")
    lake.write_silver(
        norm.observe(
            stage,
            F.coalesce(F.sum("times_seen"), F.lit(0)).alias("cleaned"),
            F.count(F.lit(1)).alias("deduplicated"),
            F.count("salary_monthly_mid").alias("with_pay"),
        ),
        silver,
        "postings_norm",
    )
    found = Observation("posting_skills")
    norm = lake.read_silver(spark, silver, "postings_norm")
    lake.write_silver(
        term_extract(norm, gazetteer).observe(
            found,
            F.count(F.lit(1)).alias("skill_rows"),
            # At most the terms of the gazetteer.
            F.size(F.collect_set("skill")).cast("long").alias("distinct_skills"),
        ),
        silver,
        "posting_skills",
    )
    return {**stage.get, **found.get}


def write_marts(
    spark: SparkSession,
    silver: str,
    gold: str | None,
    jdbc: Mapping[str, str] | None = None,
    accuracy: int | None = None,
) -> None:
    norm = lake.read_silver(spark, silver, "postings_norm")
    skills = lake.read_silver(spark, silver, "posting_skills")
    # Rows by skill and month: at most a few per term, and both demand marts come from them.
    lake.write_silver(M.demand_rollup(skills), silver, "demand_rollup")
    rollup = lake.read_silver(spark, silver, "demand_rollup")
    marts = {
        "skill_demand_monthly": M.monthly_from_rollup(rollup),
        "skill_overview": M.overview_from_rollup(rollup),
        "skill_salary_benchmark": M.salary_benchmark(skills, accuracy=accuracy),
        "market_kpi": M.market_kpi(norm, skills, accuracy),
    }
    version = None if gold is None else lake.new_version(spark, gold)
    where = None if gold is None else lake.version_path(gold, version)
    # The marts do not depend on each other; side by side, one fills the cores another leaves idle.
    with ThreadPoolExecutor(len(marts)) as pool:
        writes = [
            pool.submit(inheritable_thread_target(spark)(lake.write_mart), df, name, where, jdbc)
            for name, df in marts.items()
        ]
        for write in writes:
            write.result()
    if gold is not None:
        lake.commit_version(spark, gold, version)
