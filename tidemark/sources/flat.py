"""Flat source: one record per opening, all values strings, keys with a full-width suffix."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.functions import pay as P
from tidemark.functions import pii
from tidemark.functions import text as X
from tidemark.operators.conform import conform
from tidemark.sources import json_array

# Source label, mark that starts a key's suffix, wrappers of the array, names of
# the record's keys, parameter with the id, labels of the requirement parts.
SOURCE = "govt"
SUFFIX_MARK = "（"
WRAPPERS = ("data", "result")
KEYS = (
    "OCCU_DESC", "COMPNAME", "JOB_DETAIL", "SALARYCD", "NT_L", "NT_U", "CITYNAME", "JOB_PERSON",
    "EDGRDESC", "EXPERIENCE", "WKTIME", "CJOB_NAME1", "CJOB_NAME2", "URL_QUERY", "TRANDATE",
)
ID_PARAM = "HIRE_ID"
REQUIREMENT_LABELS = {"EXPERIENCE": "經驗:", "EDGRDESC": "學歷:", "WKTIME": "工時:"}

# Words of the topic filter, any letter case.
TOPIC_WORDS = (
    "資訊", "軟體", "軟件", "工程師", "程式", "系統", "網路", "網頁", "前端", "後端", "全端",
    "數據", "資料", "演算法", "韌體", "雲端", "資安", "測試", "developer", "engineer", "software",
    "data", "backend", "frontend", "fullstack", "devops", "程序", "开发", "python", "java",
)
TOPIC_PATTERN = "(?iu)(" + "|".join(TOPIC_WORDS) + ")"


def bare_key(key: str) -> str:
    """Key text before the suffix mark."""
    return key.split(SUFFIX_MARK)[0].strip()


def bare_columns(df: DataFrame) -> DataFrame:
    """The known keys as string columns. Where several columns have the same bare key the first
    non-null value counts; an absent key is null."""
    same: dict[str, list[Column]] = {}
    for name in df.columns:
        same.setdefault(bare_key(name), []).append(F.col(f"`{name}`").cast("string"))
    return df.select(*[F.coalesce(*same.get(k, [F.lit(None).cast("string")])).alias(k) for k in KEYS])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records as JSON lines, the form that splits. Keys need not be the same in every record;
    nothing is inferred, so the files are read once."""
    return _columns_of(spark.read.text(path))


def read_array(spark: SparkSession, path: str, range_bytes: int = json_array.RANGE_BYTES) -> DataFrame:
    """Records of one JSON array per file, bare or inside a wrapper, read in byte ranges by many tasks."""
    return _columns_of(json_array.read_records(spark, path, WRAPPERS, range_bytes))


def _columns_of(texts: DataFrame) -> DataFrame:
    record = F.from_json("value", "map<string,string>")
    keys = F.transform(F.map_keys("_r"), lambda k: X.strip(F.substring_index(k, SUFFIX_MARK, 1)))
    lines = (
        texts.select(record.alias("_r"))
        # Of keys that are the same without their suffix the last one counts.
        .select(F.reverse(keys).alias("_k"), F.reverse(F.map_values("_r")).alias("_v"))
    )

    def value(key: str) -> Column:
        return F.get("_v", F.array_position("_k", key) - 1)

    return lines.select(*[value(k).alias(k) for k in KEYS])


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array per file, bare or inside a wrapper. Such a file is read by one task."""
    df = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    wrapped = [w for w in WRAPPERS if w in df.columns]
    if wrapped:
        parts = []
        for i, name in enumerate(wrapped):
            # A later wrapper counts only where the ones before it hold no records.
            empty = [F.coalesce(F.size(w), F.lit(0)) <= 0 for w in wrapped[:i]]
            parts.append(df.filter(F.lit(True) if not empty else empty[0]).select(F.inline(name)))
        df = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return bare_columns(df)


def topic_filter(df: DataFrame, pattern: str = TOPIC_PATTERN, columns=None) -> DataFrame:
    """Records whose title or category names contain a topic word."""
    columns = columns or ("OCCU_DESC", "CJOB_NAME1", "CJOB_NAME2")
    return df.filter(F.concat_ws(" ", *columns).rlike(pattern))


def record_cap(df: DataFrame, *order: Column | str, limit: int) -> DataFrame:
    """The first `limit` records in the given order."""
    return df.orderBy(*order).limit(limit)


def parse_flat(
    df: DataFrame,
    source: str = SOURCE,
    pii_rules=pii.DEFAULT_RULES,
    id_modulus: int | None = None,
    fetched_at: Column | None = None,
) -> DataFrame:
    """Normalized postings from records with bare or suffixed keys."""
    raw = bare_columns(df)
    r = {k: F.col(k) for k in KEYS}
    unit_label = X.strip(F.coalesce(r["SALARYCD"], F.lit("")))
    labelled = [F.when(r[k] != "", F.concat(F.lit(v), r[k])) for k, v in REQUIREMENT_LABELS.items()]
    requirements = X.once(X.join_present(*labelled), X.none_if_empty)
    columns = {
        "source": F.lit(source),
        "job_id": K.url_id(r["URL_QUERY"], r["OCCU_DESC"], ID_PARAM, id_modulus),
        "title": r["OCCU_DESC"],
        "company": r["COMPNAME"],
        "description": pii.scrub(r["JOB_DETAIL"], pii_rules),
        "requirements": pii.scrub(requirements, pii_rules),
        "salary_text": unit_label,
        "salary_min": X.parse_number(r["NT_L"]),
        "salary_max": X.parse_number(r["NT_U"]),
        "salary_type": P.unit_from_label(unit_label),
        "city": X.city_prefix(r["CITYNAME"]),
        "headcount": X.headcount(r["JOB_PERSON"]),
        "education": r["EDGRDESC"],
        "experience": r["EXPERIENCE"],
        "category": r["CJOB_NAME1"],
        "url": r["URL_QUERY"],
        "posted_date": X.iso_date(r["TRANDATE"]),
        "fetched_at": X.utc_now_iso() if fetched_at is None else fetched_at,
    }
    return conform(raw.select(*[c.alias(n) for n, c in columns.items()]))


def ingest_flat(
    df: DataFrame, topic_only: bool = True, limit: int | None = None, **parse_options
) -> DataFrame:
    """Topic filter, then parse, then an optional cap by job_id."""
    raw = bare_columns(df)
    parsed = parse_flat(topic_filter(raw) if topic_only else raw, **parse_options)
    return parsed if limit is None else record_cap(parsed, "job_id", limit=limit)
