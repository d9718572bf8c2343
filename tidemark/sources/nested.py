"""Nested source: one detail payload per opening, with header, jobDetail and condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import pay as P
from tidemark.functions import pii
from tidemark.functions import text as X
from tidemark.operators.conform import conform
from tidemark.sources import json_array

# Source label, start of a posting's URL, item lists and texts that make up the
# requirements, in order.
SOURCE = "job104"
URL_PREFIX = "https://www.104.com.tw/job/"
ITEM_LISTS = ("skill", "specialty", "tools")
ITEM_TEXTS = ("workExp", "edu", "major", "other", "language")

# Fields that may be something else than a plain string are read as variant.
_BODY = """
    header struct<jobName string, custName string, appearDate string>,
    jobDetail struct<jobDescription string, salary string, salaryMin string, salaryMax string,
                     addressRegion string, jobAddrNoDesc string, needEmp string,
                     jobCategory variant>,
    condition struct<workExp variant, edu variant, major variant, other variant, language variant,
                     skill variant, specialty variant, tools variant>
"""
PAYLOAD = f"jobId string, data struct<jobId string, {_BODY}>, {_BODY}"


def read_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Payloads as JSON lines, or (multi_line) as one JSON array or object per file."""
    return spark.read.schema(PAYLOAD).option("multiLine", multi_line).json(path)


def read_array(spark: SparkSession, path: str, range_bytes: int = json_array.RANGE_BYTES) -> DataFrame:
    """Payloads of one JSON array per file, read in byte ranges by many tasks."""
    records = json_array.read_records(spark, path, range_bytes=range_bytes)
    return records.select(F.from_json("value", PAYLOAD).alias("_r")).select("_r.*")


class _Record:
    """Typed access to the fields a frame may or may not have."""

    def __init__(self, df: DataFrame):
        self.schema = df.schema
        self.roots = ["data", ""] if "data" in df.columns else [""]

    def type_of(self, path: str) -> T.DataType | None:
        kind: T.DataType = self.schema
        for name in path.split("."):
            if not isinstance(kind, T.StructType) or name not in kind.names:
                return None
            kind = kind[name].dataType
        return kind

    def fields(self, path: str) -> list[tuple[Column, T.DataType]]:
        """(value, type) at the path, inside the wrapper first; outside it only without one."""
        found = []
        for root in self.roots:
            full = f"{root}.{path}" if root else path
            kind = self.type_of(full)
            if kind is not None:
                value = F.col(full)
                if not root and len(self.roots) > 1:
                    value = F.when(F.col("data").isNull(), value)
                found.append((value, kind))
        return found

    def text(self, path: str) -> Column:
        return _first([_scalar_text(v, t) for v, t in self.fields(path)])

    def string(self, path: str) -> Column:
        """The value where it is a string; numbers, arrays and objects are no text."""
        return _first([_string_only(v, t) for v, t in self.fields(path)])

    def items(self, path: str) -> Column:
        """array<string> of the item texts; null or '' where an item has none."""
        return _first([_item_texts(v, t) for v, t in self.fields(path)], "array<string>")

    def first_item(self, path: str) -> Column:
        """Description of the first item of a list, or the plain text."""
        return _first([_head_text(v, t) for v, t in self.fields(path)])


def _first(values: list[Column], kind: str = "string") -> Column:
    return F.coalesce(*values) if values else F.lit(None).cast(kind)


def _get(item: Column, kind: T.DataType, field: str) -> Column:
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(item, f"$.{field}", "string")
    if isinstance(kind, T.StructType) and field in kind.names:
        return item[field].cast("string")
    return F.lit(None).cast("string")


def _plain_text(variant: Column) -> Column:
    is_text = F.schema_of_variant(variant) == "STRING"
    return F.when(is_text, F.try_variant_get(variant, "$", "string"))


def _scalar_text(value: Column, kind: T.DataType) -> Column:
    """Text of a string, number or boolean; null for arrays and objects of a variant."""
    if not isinstance(kind, T.VariantType):
        return value.cast("string")
    nested = F.schema_of_variant(value).rlike("^(ARRAY|OBJECT)")
    return F.when(~nested, F.try_variant_get(value, "$", "string"))


def _string_only(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.VariantType):
        return _plain_text(value)
    return value if isinstance(kind, T.StringType) else F.lit(None).cast("string")


def _as_list(value: Column, kind: T.DataType) -> tuple[Column, T.DataType]:
    if isinstance(kind, T.VariantType):
        is_list = F.schema_of_variant(value).startswith("ARRAY")
        return F.when(is_list, F.try_variant_get(value, "$", "array<variant>")), kind
    if isinstance(kind, T.ArrayType):
        return value, kind.elementType
    return F.lit(None).cast("array<string>"), T.StringType()


def _item_texts(value: Column, kind: T.DataType) -> Column:
    items, element = _as_list(value, kind)

    def text(item: Column) -> Column:
        if isinstance(element, T.StringType):
            return item
        named = F.coalesce(
            *[X.none_if_empty(_get(item, element, name)) for name in ("description", "name")]
        )
        if isinstance(element, T.VariantType):
            return F.coalesce(named, _plain_text(item))
        return named

    return F.transform(items, text)


def _head_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return value
    items, element = _as_list(value, kind)
    head = _get(F.get(items, 0), element, "description")
    if isinstance(kind, T.VariantType):
        return F.coalesce(head, _plain_text(value))
    return head


def join_parts(df: DataFrame) -> Column:
    """Requirements of a payload: item texts, then the single texts, empties left out."""
    record = _Record(df)
    lists = [F.coalesce(record.items(f"condition.{k}"), F.array()) for k in ITEM_LISTS]
    texts = [F.array(record.string(f"condition.{k}")) for k in ITEM_TEXTS]
    parts = F.filter(F.concat(*lists, *texts), lambda p: p.isNotNull() & (p != ""))
    return F.array_join(parts, " | ")


def parse_nested(
    df: DataFrame,
    source: str = SOURCE,
    url_prefix: str = URL_PREFIX,
    pii_rules=pii.DEFAULT_RULES,
    fetched_at: Column | None = None,
) -> DataFrame:
    """Normalized postings from payloads, with or without the `data` wrapper. Lists may be
    arrays of structs, arrays of strings or variants; absent fields count as null."""
    record = _Record(df)
    ids = [F.col(p).cast("string") for p in ("jobId", "data.jobId") if record.type_of(p) is not None]
    job_id = _first([X.none_if_empty(i) for i in ids])
    salary_text = record.text("jobDetail.salary")
    region = F.coalesce(
        X.none_if_empty(record.text("jobDetail.addressRegion")), record.text("jobDetail.jobAddrNoDesc")
    )
    columns = {
        "source": F.lit(source),
        "job_id": job_id,
        "title": record.text("header.jobName"),
        "company": record.text("header.custName"),
        "description": pii.scrub(record.text("jobDetail.jobDescription"), pii_rules),
        "requirements": pii.scrub(join_parts(df), pii_rules),
        "salary_text": salary_text,
        "salary_min": X.parse_number(record.text("jobDetail.salaryMin"), commas=False),
        "salary_max": X.parse_number(record.text("jobDetail.salaryMax"), commas=False),
        "salary_type": P.unit_from_text(salary_text),
        "city": region,
        "headcount": X.headcount(record.text("jobDetail.needEmp"), commas=False),
        "education": record.text("condition.edu"),
        "experience": record.text("condition.workExp"),
        "category": record.first_item("jobDetail.jobCategory"),
        "url": F.concat(F.lit(url_prefix), job_id),
        "posted_date": X.iso_date(record.text("header.appearDate"), digits_only=True),
        "fetched_at": X.utc_now_iso() if fetched_at is None else fetched_at,
    }
    return conform(df.select(*[c.alias(n) for n, c in columns.items()]))


def union_sources(*parsed: DataFrame) -> DataFrame:
    """Postings of all sources in one frame."""
    out = parsed[0]
    for df in parsed[1:]:
        out = out.unionByName(df)
    return out
