"""Both raw sources, from files in each of their shapes to normalized postings."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import pii
from tidemark.operators.conform import conform
from tidemark.schemas import POSTING
from tidemark.sources import flat, nested

AT = "2026-02-01T00:00:00+00:00"

FLAT = [
    {
        "OCCU_DESC（職務名稱）": "後端工程師",
        "COMPNAME（公司名稱）": "範例公司",
        "JOB_DETAIL（工作內容）": "python, a@b.co, 02-2345-6789",
        "SALARYCD（核薪方式）": " 月薪 ",
        "NT_L（薪資範圍下限）": "48,000",
        "NT_U（薪資範圍上限）": "0",
        "CITYNAME（工作地點）": "台北市信義區",
        "JOB_PERSON（雇用人數）": "3",
        "EXPERIENCE（工作經驗）": "5年以上",
        "EDGRDESC（最低學歷要求）": "",
        "WKTIME（工作時間）": "日班",
        "CJOB_NAME1（職務大類別名稱）": "資訊",
        "URL_QUERY（職缺資料URL）": "https://x.example/d?E=1&HIRE_ID=77",
        "TRANDATE（職缺更新日期）": "20260115",
    },
    {"OCCU_DESC（別名）": "cook", "CITYNAME": "遠端信義區", "SALARYCD": "面議(x)", "TRANDATE": "2026"},
]
FLAT_ROWS = [
    ("govt", "77", "後端工程師", "範例公司", "python, [email-removed], [phone-removed]",
     "經驗:5年以上 | 工時:日班", "月薪", 48000.0, None, "month", "台北市", 3, "", "5年以上", "資訊",
     "https://x.example/d?E=1&HIRE_ID=77", "2026-01-15", AT),
    ("govt", None, "cook", None, None, None, "面議(x)", None, None, "negotiable", "遠端信義區", None,
     None, None, None, None, None, AT),
]


def parsed_flat(df):
    rows = flat.parse_flat(df, fetched_at=F.lit(AT)).orderBy(F.desc("company")).collect()
    assert all(r.job_id for r in rows)
    return [tuple(r) if r.url else (r.source, None, *tuple(r)[2:]) for r in rows]


def dump(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False, indent=1), encoding="utf-8")
    return str(path)


def lines(path, records):
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records), encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("wrap", [None, "data", "result"])
def test_flat_document(spark, tmp_path, wrap):
    path = dump(tmp_path / "a.json", {wrap: FLAT} if wrap else FLAT)
    assert parsed_flat(flat.read_document(spark, path)) == FLAT_ROWS


def test_flat_document_with_both_wrappers_uses_the_first(spark, tmp_path):
    path = dump(tmp_path / "a.json", {"data": FLAT, "result": FLAT})
    assert flat.read_document(spark, path).count() == 2


def test_flat_lines(spark, tmp_path):
    assert parsed_flat(flat.read_lines(spark, lines(tmp_path / "a.jsonl", FLAT))) == FLAT_ROWS


def test_flat_schema(spark, tmp_path):
    df = flat.parse_flat(flat.read_lines(spark, lines(tmp_path / "a.jsonl", FLAT)))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in POSTING]
    assert df.first().fetched_at.endswith("+00:00")


def test_ingest_filters_by_topic_and_caps(spark, tmp_path):
    records = FLAT + [{**FLAT[0], "OCCU_DESC（職務名稱）": "DATA clerk", "URL_QUERY": None}]
    raw = flat.read_lines(spark, lines(tmp_path / "a.jsonl", records))
    titles = {r.title for r in flat.ingest_flat(raw).collect()}
    assert titles == {"後端工程師", "DATA clerk"}
    assert flat.ingest_flat(raw, topic_only=False).count() == 3
    ids = sorted(r.job_id for r in flat.ingest_flat(raw, topic_only=False).collect())
    assert [r.job_id for r in flat.ingest_flat(raw, topic_only=False, limit=2).collect()] == ids[:2]


PAYLOADS = [
    {
        "jobId": "7000001",
        "data": {
            "header": {"jobName": "Engineer", "custName": "Firm", "appearDate": "2026/01/02"},
            "jobDetail": {
                "jobDescription": "mail a@b.co", "salary": "月薪40,000~50,000元",
                "salaryMin": 40000, "salaryMax": 50000, "addressRegion": "", "jobAddrNoDesc": "台中市",
                "needEmp": "2", "jobCategory": [{"description": "cat"}, {"description": "x"}],
            },
            "condition": {
                "workExp": "1年", "edu": "大學", "major": "", "other": "call 0912345678",
                "skill": [{"description": "s1"}, {"description": "", "name": "n1"}, "plain", {}],
                "specialty": None, "tools": ["t1", ""],
            },
        },
    },
    {"jobId": 8, "header": {"jobName": "Bare"}, "jobDetail": {"jobCategory": "scalar", "salaryMin": "0"}},
    {"data": {"jobId": "9", "header": None, "condition": {"skill": [], "language": "英文"}}},
]
NESTED_ROWS = [
    ("job104", "7000001", "Engineer", "Firm", "mail [email-removed]",
     "s1 | n1 | plain | t1 | 1年 | 大學 | call [phone-removed]", "月薪40,000~50,000元", 40000.0, 50000.0,
     "month", "台中市", 2, "大學", "1年", "cat", "https://www.104.com.tw/job/7000001", "2026-01-02", AT),
    ("job104", "8", "Bare", None, None, "", None, None, None, None, None, None, None, None, "scalar",
     "https://www.104.com.tw/job/8", None, AT),
    ("job104", "9", None, None, None, "英文", None, None, None, None, None, None, None, None, None,
     "https://www.104.com.tw/job/9", None, AT),
]


@pytest.mark.parametrize("multi_line", [True, False])
def test_nested_files(spark, tmp_path, multi_line):
    path = (dump if multi_line else lines)(tmp_path / "n.json", PAYLOADS)
    df = nested.parse_nested(nested.read_payloads(spark, path, multi_line), fetched_at=F.lit(AT))
    assert [tuple(r) for r in df.orderBy("job_id").collect()] == NESTED_ROWS


def test_nested_typed_frames(spark):
    """Arrays of structs and arrays of strings, absent sections, no wrapper."""
    df = spark.createDataFrame(
        [("1", (["a", "", None], [("d", "n"), (None, "n2"), ("", "")]), ([("c1",), ("c2",)],))],
        "jobId string, condition struct<skill array<string>,"
        " tools array<struct<description string, name string>>>,"
        " jobDetail struct<jobCategory array<struct<description string>>>",
    )
    row = nested.parse_nested(df).first()
    assert (row.job_id, row.requirements, row.category, row.title) == ("1", "a | d | n2", "c1", None)


def test_union_of_sources(spark, tmp_path):
    a = flat.parse_flat(flat.read_lines(spark, lines(tmp_path / "a.jsonl", FLAT)))
    b = nested.parse_nested(nested.read_payloads(spark, lines(tmp_path / "n.jsonl", PAYLOADS)))
    both = nested.union_sources(a, b)
    assert both.columns == POSTING.names
    assert {r.source: r["count"] for r in both.groupBy("source").count().collect()} == {
        "govt": 2, "job104": 3,
    }


def test_title_and_company_are_not_scrubbed(spark):
    df = spark.createDataFrame([("a@b.co", "c@d.ef")], "OCCU_DESC string, COMPNAME string")
    row = flat.parse_flat(df, pii_rules=pii.PARITY_RULES).first()
    assert (row.title, row.company) == ("a@b.co", "c@d.ef")


def test_conform(spark):
    df = spark.createDataFrame(
        [("1", "12.5", "x", 1)], "job_id string, salary_min string, headcount string, extra int"
    )
    out = conform(df)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in POSTING]
    row = out.first()
    assert (row.job_id, row.salary_min, row.headcount, row.title) == ("1", 12.5, None, None)


def test_row_wise_operators_accept_a_stream(spark, tmp_path):
    """Parse and clean are expressions of one row, so a stream of landed files gives the rows of
    the batch."""
    from tidemark.operators.clean import clean
    from tidemark.operators.pay import pay_norm

    (tmp_path / "in").mkdir()
    lines(tmp_path / "in" / "n.json", PAYLOADS)
    plan = lambda df: pay_norm(clean(nested.parse_nested(df, fetched_at=F.lit(AT))))
    stream = spark.readStream.schema(nested.PAYLOAD).json(str(tmp_path / "in"))
    query = (
        plan(stream).writeStream.format("memory").queryName("streamed")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    batch = plan(spark.read.schema(nested.PAYLOAD).json(str(tmp_path / "in")))
    assert spark.table("streamed").collect() == batch.collect() and batch.count() == 2


def test_nested_requirements_take_strings_only(spark, tmp_path):
    payloads = [
        {"jobId": "1", "condition": {"workExp": "1y", "major": ["CS", "EE"], "language": [{"language": "en"}], "edu": 5, "skill": [{"description": "py"}]}},
        {"jobId": "2", "data": {"condition": {"edu": "BA", "other": {"a": 1}, "major": "CS", "workExp": True}}},
        {"jobId": "3"},
    ]
    path = tmp_path / "p.json"
    path.write_text("\n".join(map(json.dumps, payloads)), encoding="utf-8")
    df = nested.read_payloads(spark, str(path))
    got = {r.jobId: r.x for r in df.select("jobId", nested.join_parts(df).alias("x")).collect()}
    assert got == {"1": "py | 1y", "2": "BA | CS", "3": ""}
    parsed = {r.job_id: (r.education, r.experience) for r in nested.parse_nested(df).collect()}
    assert parsed == {"1": ("5", "1y"), "2": ("BA", "true"), "3": (None, None)}
