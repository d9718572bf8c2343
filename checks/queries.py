"""One query per operator, over the whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V
from tidemark.functions import keys as K
from tidemark.functions import pay as P
from tidemark.functions import pii
from tidemark.functions import text as X
from tidemark.operators import bitmaps
from tidemark.operators import marts as M
from tidemark.operators import terms as T
from tidemark.operators import term_join
from tidemark.operators.clean import clean, posting_text
from tidemark.operators.conform import conform
from tidemark.operators.latest import dedup_latest, dedup_located, upsert_latest, upsert_located
from tidemark.operators.pay import pay_norm
from tidemark.operators.percentiles import pay_percentiles
from tidemark.plans import feeds, pipeline
from tidemark.sources import flat, lake, nested

PAREN_PHONE_RULE = (r"\(\d{3}\) \d{3}-\d{4}", "[phone-removed]")
SPLIT_DAY = "2024-01-16"
COPY_BYTES = 4 << 20

QUERIES = {}


def query(fn, name: str | None = None):
    QUERIES[name or fn.__name__] = fn
    return fn


def named(name: str):
    """Register under another name, where the function's own would hide an operator."""
    return lambda fn: query(fn, name)


# Sources and sinks

@query
def bronze_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = lake.new_folder(spark, "bronze")
    lake.land_bronze(V.postings(spark, sf), path, "json")
    return lake.scan_bronze(spark, path, "json")


@query
def bronze_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Every posting is landed, then those of one source again with another title."""
    path = lake.new_folder(spark, "bronze")
    first = conform(V.postings(spark, sf))
    lake.land_bronze(first, path)
    again = first.filter("source = 'f'").withColumns(
        {"title": F.upper(F.reverse("title")), "fetched_at": F.concat("fetched_at", F.lit("T01"))}
    )
    lake.land_bronze(again, path)
    return lake.scan_bronze(spark, path)


@query
def bronze_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Three merges into the current table: every posting, those of one source again with another title and
    a month later, and those of another as they were before, which changes nothing."""
    path = lake.new_folder(spark, "current")
    first = lake.staged(conform(V.postings(spark, sf)), "first")
    lake.merge_current(first, path)
    lake.merge_current(V.reposted(first), path)
    lake.merge_current(first.filter("source = 'o'").withColumns({"title": F.lit("early"), "fetched_at": F.lit("1990-01-01")}), path)
    return lake.read_current(spark, path)


@query
def bronze_intake(spark: SparkSession, sf: str) -> DataFrame:
    """Files put into a folder one after the other, taken in after each, and once with nothing new."""
    source, root = lake.new_folder(spark, "incoming"), lake.new_folder(spark, "lake")
    first = lake.staged(conform(V.postings(spark, sf)), "first")
    for batch in (first, V.reposted(first)):
        batch.write.mode("append").options(ignoreNullFields=False, compression="gzip").json(source)
        lake.intake(spark, source, root, files_per_batch=3)
    lake.intake(spark, source, root)
    return lake.read_current(spark, f"{root}/current")


@query
def silver_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = lake.new_folder(spark, "silver")
    lake.write_silver(clean(V.postings(spark, sf), region=V.region()), root, "postings_clean")
    return lake.read_silver(spark, root, "postings_clean")


@query
def mart_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The whole pipeline to its marts, and the benchmark read back."""
    return _mart(spark, sf, "skill_salary_benchmark")


@query
def mart_sink_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(spark, sf, "skill_demand_monthly")


@query
def mart_sink_overview(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(spark, sf, "skill_overview")


@query
def mart_sink_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(spark, sf, "market_kpi")


def _mart(spark: SparkSession, sf: str, name: str) -> DataFrame:
    root = lake.new_folder(spark, "lake")
    pipeline.run(V.postings(spark, sf), root, V.PART_TERMS, region=V.region())
    return lake.read_mart(spark, f"{root}/gold", name)


@query
def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    silver = lake.new_folder(spark, "silver")
    counts = pipeline.write_silver_tables(
        V.postings(spark, sf), silver, V.PART_TERMS, V.region()
    )
    return spark.createDataFrame(list(counts.items()), "stage string, n_rows long")


@named("conform")
def conform_posting(spark: SparkSession, sf: str) -> DataFrame:
    return conform(V.postings(spark, sf))


@query
def parse_flat(spark: SparkSession, sf: str) -> DataFrame:
    return flat.parse_flat(V.flat_records(spark, sf), fetched_at=F.lit(V.FETCHED))


@query
def parse_nested(spark: SparkSession, sf: str) -> DataFrame:
    return nested.parse_nested(V.nested_payloads(spark, sf), fetched_at=F.lit(V.FETCHED))


def _one_array(spark: SparkSession, records: DataFrame, top: str, end: str) -> str:
    """The records in one file that is a JSON array. Tasks write a file each, and these are put one after another
    as bytes, each removed once it is there."""
    path, parts = lake.new_folder(spark, "array"), lake.new_folder(spark, "parts")
    records.select(F.concat(F.to_json(F.struct(*records.columns)), F.lit(","))).write.text(parts)
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    whole, folder = hadoop.fs.Path(f"{path}/array.json"), hadoop.fs.Path(parts)
    store = whole.getFileSystem(conf)
    out = store.create(whole)
    try:
        out.write(bytearray(f"{top}\n".encode()))
        for name in sorted(f.getPath().getName() for f in store.listStatus(folder)):
            if name.startswith("part-"):
                part = hadoop.fs.Path(folder, name)
                lines = store.open(part)
                try:
                    hadoop.io.IOUtils.copyBytes(lines, out, COPY_BYTES, False)
                finally:
                    lines.close()
                store.delete(part, False)
        out.write(bytearray(f"{end}\n".encode()))
    finally:
        out.close()
    lake.remove(spark, parts)
    return path


@query
def parse_flat_json(spark: SparkSession, sf: str) -> DataFrame:
    """Records with array, object and number fields, from one wrapped array in one file."""
    records = V.flat_records(spark, sf).withColumns({
        "TAGS": F.array(F.lit("a"), F.lit('b"]}')), "GEO": F.struct(F.lit(1.5).alias("x"), F.lit("{").alias("y")), "N": F.lit(7)})
    path = _one_array(spark, records, '{"total": [1], "data": [', "null]}")
    return flat.parse_flat(flat.read_array(spark, path, 1 << 20), fetched_at=F.lit(V.FETCHED))


@query
def parse_nested_json(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads whose lists are objects, texts and numbers, from one array in one file."""
    path = _one_array(spark, V.nested_payloads(spark, sf), "[", "null]")
    return nested.parse_nested(nested.read_array(spark, path, 1 << 20), fetched_at=F.lit(V.FETCHED))


@query
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    return nested.union_sources(parse_flat(spark, sf), parse_nested(spark, sf))


@query
def topic_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = flat.topic_filter(flat.bare_columns(V.flat_records(spark, sf)))
    return kept.select(
        F.col("OCCU_DESC").alias("title"),
        F.col("CJOB_NAME1").alias("category"),
        F.col("CJOB_NAME2").alias("subcategory"),
        F.col("URL_QUERY").alias("url"),
    )


@query
def record_cap(spark: SparkSession, sf: str) -> DataFrame:
    return flat.record_cap(union_sources(spark, sf), "source", "job_id", limit=1500)


@named("upsert_latest")
def upsert_latest_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as versions of (event_type, user_id), the second half of the month upserted."""
    events = V.table(spark, sf, "events")
    old, new = events.filter(F.col("ts") < SPLIT_DAY), events.filter(F.col("ts") >= SPLIT_DAY)
    return upsert_latest(old, new, ("event_type", "user_id"), ("ts", "event_id"))


@named("upsert_located")
def upsert_located_events(spark: SparkSession, sf: str) -> DataFrame:
    """The same on narrow rows."""
    events = V.table(spark, sf, "events")
    old, new = events.filter(F.col("ts") < SPLIT_DAY), events.filter(F.col("ts") >= SPLIT_DAY)
    return upsert_located(old, new, ("event_type", "user_id"), ("ts", "event_id"))


# Scalar functions

@query
def parse_number(spark: SparkSession, sf: str) -> DataFrame:
    text = F.format_number("c_acctbal", 2)
    return V.table(spark, sf, "customer").select(
        "c_custkey",
        X.parse_number(text).alias("with_commas"),
        X.parse_number(text, commas=False).alias("without_commas"),
        X.headcount(text).alias("whole"),
        X.parse_number(F.col("c_name")).alias("not_a_number"),
    )


@query
def city_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return _cities(spark, sf, X.city_prefix(F.col("city")))


@query
def region_extract(spark: SparkSession, sf: str) -> DataFrame:
    return _cities(spark, sf, X.region_extract(F.col("city")))


def _cities(spark, sf, expression) -> DataFrame:
    """City texts of every customer."""
    nation = F.col("c_nationkey")
    city = (
        F.when(nation % 5 == 0, F.concat(F.lit("台北市"), "c_mktsegment"))
        .when(nation % 5 == 1, F.concat(F.lit("於新竹縣"), "c_mktsegment"))
        .when(nation % 5 == 2, F.concat(F.lit(" 遠端"), "c_mktsegment"))
        .when(nation % 5 == 3, F.col("c_mktsegment"))
        .otherwise(F.lit(""))
    )
    customers = V.table(spark, sf, "customer").withColumn("city", city)
    return customers.select("c_custkey", "city", expression.alias("result"))


@query
def iso_date(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    slashed = F.date_format("o_orderdate", "yyyy/MM/dd")
    return V.table(spark, sf, "orders").select(
        "o_orderkey",
        X.iso_date(day).alias("compact"),
        X.iso_date(slashed).alias("slashed"),
        X.iso_date(slashed, digits_only=True).alias("slashed_digits"),
    )


@query
def url_id(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    return V.table(spark, sf, "pages").select(
        "page_id",
        K.url_param(url, "page").alias("param"),
        K.url_id(url, F.lit(None).cast("string"), "page").alias("id"),
        K.url_id(url, F.lit("t"), "page", 10**10).alias("short_id"),
    )


@query
def pay_unit(spark: SparkSession, sf: str) -> DataFrame:
    label = (
        F.when(F.col("o_orderkey") % 7 == 0, "論件計酬")
        .when(F.col("o_orderstatus") == "F", "月薪")
        .when(F.col("o_orderstatus") == "O", "年薪")
        .otherwise("時薪 面議")
    )
    text = F.concat(label, "o_orderpriority")
    return V.table(spark, sf, "orders").select(
        "o_orderkey",
        P.unit_from_label(label).alias("from_label"),
        P.unit_from_label(text).alias("from_longer_label"),
        P.unit_from_text(text).alias("from_text"),
    )


@query
def join_parts(spark: SparkSession, sf: str) -> DataFrame:
    payloads = V.nested_payloads(spark, sf)
    return payloads.select(F.col("jobId").alias("job_id"), nested.join_parts(payloads).alias("requirements"))


@query
def scrub_pii(spark: SparkSession, sf: str) -> DataFrame:
    rules = (*pii.DEFAULT_RULES, PAREN_PHONE_RULE)
    return V.table(spark, sf, "documents").select(
        "doc_id", pii.scrub(F.col("text"), rules).alias("text")
    )


@query
def bronze_key(spark: SparkSession, sf: str) -> DataFrame:
    key = K.bronze_key(F.col("source"), F.col("job_id"))
    uid = K.posting_uid(F.col("source"), F.col("job_id"))
    return V.postings(spark, sf).select(key.alias("bronze_key"), uid.alias("uid"))


@query
def year_month(spark: SparkSession, sf: str) -> DataFrame:
    month = X.year_month(F.col("posted_date"), F.col("fetched_at"))
    return V.postings(spark, sf).select("job_id", month.alias("year_month"))


@query
def bucket_rules(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("experience")
    return V.postings(spark, sf).select(
        "job_id",
        X.bucket_rules(text).alias("seniority"),
        X.bucket_rules(text, X.YEARS_RULES).alias("by_years"),
    )


@query
def full_text(spark: SparkSession, sf: str) -> DataFrame:
    return V.postings(spark, sf).select("job_id", posting_text().alias("full_text"))


@named("clean")
def clean_postings(spark: SparkSession, sf: str) -> DataFrame:
    return clean(V.postings(spark, sf), region=V.region())


@query
def pay_monthly(spark: SparkSession, sf: str) -> DataFrame:
    unit = F.col("salary_type")
    return V.postings(spark, sf).select(
        "job_id",
        P.to_monthly(F.col("salary_min"), unit).alias("monthly_min"),
        P.to_monthly(F.col("salary_max"), unit).alias("monthly_max"),
    )


@named("pay_norm")
def pay_norm_postings(spark: SparkSession, sf: str) -> DataFrame:
    return pay_norm(clean(V.postings(spark, sf), region=V.region())).select(
        "source", "job_id", "salary_monthly_min", "salary_monthly_max", "salary_monthly_mid"
    )


# Keep-latest

@named("dedup_latest")
def dedup_latest_postings(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_latest(clean(V.postings(spark, sf), region=V.region()))


@named("dedup_located")
def dedup_located_postings(spark: SparkSession, sf: str) -> DataFrame:
    """The same on narrow rows, from the clean postings on disk."""
    return dedup_located(silver_roundtrip(spark, sf))


@query
def dedup_seen(spark: SparkSession, sf: str) -> DataFrame:
    latest = dedup_latest(clean(V.postings(spark, sf), region=V.region(), with_text=False))
    return latest.select("company", "title", "region", "first_seen", "last_seen", "times_seen")


# Terms

@named("term_match")
def term_match_postings(spark: SparkSession, sf: str) -> DataFrame:
    matched = T.term_match(clean(V.postings(spark, sf), region=V.region()), V.PART_TERMS)
    return matched.select("source", "job_id", F.array_join("skills", ",").alias("skills"))


@query
def term_match_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Terms of four languages in whole documents."""
    found = V.LANGUAGE_TERMS.matches(F.lower("text"))
    return V.table(spark, sf, "documents").select(
        "doc_id", "lang", F.array_join(found, ",").alias("terms")
    )


@named("term_match_join")
def term_match_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """A gazetteer of hundreds of thousands of aliases, as a table, in whole documents."""
    documents = V.table(spark, sf, "documents").select("doc_id", F.lower("text").alias("full_text"))
    found = term_join.term_match_join(documents, V.corpus_aliases(spark, sf))
    return found.select("doc_id", F.size("skills").alias("n_terms"), F.md5(F.array_join("skills", ",")).alias("terms_md5"))


@query
def term_extract(spark: SparkSession, sf: str) -> DataFrame:
    return V.skills(spark, sf)


# Aggregates and marts

@query
def demand_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return M.demand_monthly(V.skills(spark, sf))


@query
def skill_totals(spark: SparkSession, sf: str) -> DataFrame:
    return M.skill_totals(V.skills(spark, sf))


@query
def mom_change(spark: SparkSession, sf: str) -> DataFrame:
    return M.mom_change(demand_monthly(spark, sf))


@query
def mom_change_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return M.mom_change(demand_monthly(spark, sf), calendar=True)


@query
def demand_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """Postings by month and in all, from bitmaps of two loads put together."""
    norm = lake.staged(V.norm(spark, sf), "norm")
    first = F.col("fetched_at") < "1995-01-01"
    numbers = bitmaps.number_postings(norm.filter(first))
    numbers = bitmaps.number_postings(norm, numbers)
    loads = [bitmaps.demand_bitmaps(T.term_extract(norm.filter(own), V.PART_TERMS), numbers) for own in (first, ~first)]
    return bitmaps.rollup_from_bitmaps(bitmaps.merge_bitmaps(*loads))


@query
def skill_overview(spark: SparkSession, sf: str) -> DataFrame:
    return M.skill_overview(V.skills(spark, sf))


@named("pay_percentiles")
def pay_percentiles_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return pay_percentiles(V.skills(spark, sf), ["skill", "region", "seniority"])


@query
def pay_percentiles_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """The sketch, exact for groups of fewer rows than its accuracy."""
    by = ["skill", "region", "seniority"]
    return pay_percentiles(V.skills(spark, sf), by, accuracy=10_000_000)


@query
def salary_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return M.salary_benchmark(V.skills(spark, sf))


@query
def salary_benchmark_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The benchmark from counts of two loads, kept as tables and added up."""
    skills = lake.staged(V.skills(spark, sf), "skills")
    first = F.col("seniority") == "senior"
    loads = [lake.staged(M.pay_counts(skills.filter(own)), "pay-counts") for own in (first, ~first)]
    return M.benchmark_from_counts(M.merge_counts(*loads))


@query
def market_kpi(spark: SparkSession, sf: str) -> DataFrame:
    norm = lake.staged(V.norm(spark, sf), "norm")
    return M.market_kpi(norm, T.term_extract(norm, V.PART_TERMS))


@query
def regions_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    """The benchmark of a chain with the default region rule and missing companies."""
    return M.salary_benchmark(T.term_extract(pipeline.postings_norm(V.sparse_postings(spark, sf)), V.PART_TERMS))


@query
def sparse_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the same chain: missing companies are one company."""
    norm = lake.staged(pipeline.postings_norm(V.sparse_postings(spark, sf)), "norm")
    return M.market_kpi(norm, T.term_extract(norm, V.PART_TERMS))


# Feeds

@query
def feed_skills(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.skills(skill_overview(spark, sf), category="product")


@query
def feed_trending(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.trending(skill_overview(spark, sf))


@query
def feed_trend(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.trend(demand_monthly(spark, sf), "red-widget")


@query
def feed_salary(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.salary(salary_benchmark(spark, sf), seniority="senior")


@query
def feed_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.kpi(market_kpi(spark, sf))


@query
def skill_medians(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.skill_medians(salary_benchmark(spark, sf), ["widget", "red", "any-idget", "none"])


@query
def trend_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.trend_pivot(demand_monthly(spark, sf), ["widget", "red", "bolt"])
