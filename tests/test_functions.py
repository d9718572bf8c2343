"""Scalar expressions on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.functions import pay as P
from tidemark.functions import pii
from tidemark.functions import text as X


def test_parse_number_with_commas(values):
    got = values(
        X.parse_number,
        ["48,000", " 12 ", "　7\t", "0", "-3", "", None, "abc", "1e3", ".5", "5.", "+2", "1_000"],
    )
    assert got == [48000.0, 12.0, 7.0, None, None, None, None, None, 1000.0, 0.5, 5.0, 2.0, 1000.0]


def test_parse_number_odd_forms(values):
    # Forms a Java parser takes but that are not numbers here, and values that are not finite.
    got = values(X.parse_number, ["1d", "2f", "0x1p3", "NaN", "inf", "Infinity", "1e999", "１２３"])
    assert got == [None, None, None, None, None, None, None, 123.0]


def test_parse_number_without_commas(values):
    assert values(lambda v: X.parse_number(v, commas=False), ["48,000", "48000"]) == [None, 48000.0]


def test_parse_number_of_numbers(values):
    assert values(X.parse_number, [40000, 0, None], "long") == [40000.0, None, None]


def test_headcount(values):
    assert values(X.headcount, ["3", "0", "0.5", "2.9", "x", "99999999999"]) == [3, None, None, 2, None, None]


def test_city_prefix(values):
    got = values(
        X.city_prefix,
        ["台北市信義區", " 新竹縣竹北市 ", "遠端信義區", "", None, "  ", "於台北市", "台北市\nx", "市"],
    )
    assert got == ["台北市", "新竹縣", "遠端信義區", None, None, "", "於台北市", "台北市", "市"]


def test_region_extract(values):
    got = values(X.region_extract, ["於台北市", "遠端信義區", "Taipei", None, "", "台北市大安區", "xx遠端"])
    assert got == ["於台北市", "遠端", "其他", "其他", "其他", "台北市", "遠端"]


def test_iso_date(values):
    assert values(X.iso_date, ["20260115", "2026-1-1", "abcdefgh", "2026", "", None]) == [
        "2026-01-15", "2026--1--1", "abcd-ef-gh", None, None, None,
    ]
    assert values(lambda v: X.iso_date(v, digits_only=True), ["2026/01/15", "2026-1-1", None]) == [
        "2026-01-15", None, None,
    ]
    assert values(X.iso_date, [20260115], "int") == ["2026-01-15"]


def test_seniority_rules_and_their_traps(values):
    texts = ["5年以上", "資深", "senior", "10年", "7年", "2年", "mid", "1年", None,
             "12年", "15年", "6年", "8年", "20年", "Senior"]
    assert values(X.bucket_rules, texts) == [
        "senior", "senior", "senior", "senior", "senior", "mid", "mid", "junior", "junior",
        "mid", "senior", "junior", "junior", "junior", "junior",
    ]
    assert values(lambda v: X.bucket_rules(v, X.YEARS_RULES), texts) == [
        "senior", "senior", "senior", "senior", "senior", "mid", "mid", "junior", "junior",
        "senior", "senior", "senior", "senior", "senior", "senior",
    ]


def test_full_text_keeps_separators(spark):
    row = spark.createDataFrame([("A", None, "B")], "a string, b string, c string")
    assert row.select(X.full_text(*map(F.col, "abc"))).first()[0] == "a  b"


def test_year_month(spark):
    rows = spark.createDataFrame(
        [("2026-01-15", "2026-02-01T"), (None, "2026-02-01T"), (None, None)], "p string, f string"
    )
    got = rows.select(X.year_month(F.col("p"), F.col("f")).alias("m")).collect()
    assert [r.m for r in got] == ["2026-01", "2026-02", None]


def test_unit_from_label(values):
    labels = ["月薪", "年薪", "時薪", "日薪", "論件計酬", "面議(40,000以上)", "月薪4萬", "", None]
    assert values(P.unit_from_label, labels) == [
        "month", "year", "hour", "day", "piece", "negotiable", None, None, None,
    ]


def test_unit_from_text(values):
    texts = ["月薪4萬", "年薪 面議", "時薪200", "日薪", "年薪/月薪", "論件計酬", "", None]
    assert values(P.unit_from_text, texts) == [
        "month", "negotiable", "hour", "day", "month", None, None, None,
    ]


def test_monthly_pay_and_band(spark):
    rows = [
        ("month", 40000.0, 50000.0), ("year", 600000.0, None), ("hour", None, 200.0),
        ("day", 1000.0, 1000.0), ("piece", 50000.0, 60000.0), (None, 50000.0, None),
        ("month", 10000.0, None), ("month", 9999.0, None), ("month", 1000000.0, None),
        ("month", 1000001.0, None), ("month", None, None),
    ]
    df = spark.createDataFrame(rows, "u string, low double, high double")
    low, high = (P.to_monthly(F.col(c), F.col("u")) for c in ("low", "high"))
    got = [r.m for r in df.select(P.banded(P.mid_pay(low, high)).alias("m")).collect()]
    assert got == [45000.0, 50000.0, 35200.0, 22000.0, None, None, 10000.0, None, 1000000.0, None, None]


@pytest.mark.parametrize("rules", [pii.PARITY_RULES, pii.DEFAULT_RULES])
def test_scrub(values, rules):
    texts = ["a.b+c@x-y.com.tw!", "02-2345-6789", "0912345678", "+886 2 2345 6789", "10212345678",
             "no", "", None, "０２-2345-6789"]
    wide = "０２-2345-6789"  # a full-width zero is not the 0 of the pattern
    assert values(lambda v: pii.scrub(v, rules), texts) == [
        "[email-removed]!", "[phone-removed]", "[phone-removed]", "[phone-removed]", "10212345678",
        "no", "", None, wide,
    ]


def test_scrub_of_grouped_mobiles(values):
    texts = ["0912-345-678", "+886 912 345 678", "886912345678"]
    assert values(pii.scrub, texts) == ["[phone-removed]"] * 3
    assert values(lambda v: pii.scrub(v, pii.PARITY_RULES), texts[:2]) == texts[:2]


def test_scrub_neighbours_sharing_a_separator(values):
    assert values(pii.scrub, ["02-2345-6789 02-2345-6789"]) == ["[phone-removed] [phone-removed]"]


def test_scrub_is_idempotent(values):
    texts = ["mail a@b.co or 0912-345-678", "call 02-2345-6789 and 0912345678"]
    once = values(pii.scrub, texts)
    assert values(pii.scrub, once) == once


def test_scrub_hints_change_nothing(values):
    texts = ["x@y.zz 0912345678", "886-2-2345-6789", "none", "0", "@"]
    bare = [pii.Rule(r.pattern, r.replacement) for r in pii.DEFAULT_RULES]
    assert values(pii.scrub, texts) == values(lambda v: pii.scrub(v, bare), texts)


def test_url_param(values):
    urls = [
        "https://x.y/d?A=1&HIRE_ID=14", "https://x.y/d?HIRE_ID=1%2F2+3&B=1", "https://x.y/d?HIRE_ID=",
        "https://x.y/d?HIRE_ID=&HIRE_ID=5", "https://x.y/d#?HIRE_ID=9", "https://x.y/HIRE_ID=9",
        "https://x.y/d?XHIRE_ID=9", "https://x.y/d?q=a b&HIRE_ID=8|7", "https://x.y/d?HIRE_ID=100%", None,
    ]
    assert values(lambda v: K.url_param(v, "HIRE_ID"), urls) == [
        "14", "1/2 3", None, "5", None, None, None, "8|7", "100%", None,
    ]


def test_url_id_falls_back_to_a_stable_hash(spark):
    df = spark.createDataFrame(
        [("t", "https://x.y/"), ("t", None), (None, None), ("t", "https://x.y/?HIRE_ID=3")],
        "title string, url string",
    )
    wide = [r[0] for r in df.select(K.url_id(F.col("url"), F.col("title"), "HIRE_ID")).collect()]
    short = [
        r[0] for r in df.select(K.url_id(F.col("url"), F.col("title"), "HIRE_ID", 10**10)).collect()
    ]
    assert wide[3] == short[3] == "3"
    assert len(set(wide)) == 4 and all(len(i) == 32 for i in wide[:3])
    assert all(i.isdigit() and len(i) <= 10 for i in short)


def test_keys(spark):
    df = spark.createDataFrame([("a", "1"), (None, "1")], "s string, j string")
    got = df.select(K.bronze_key(F.col("s"), F.col("j")), K.posting_uid(F.col("s"), F.col("j"))).collect()
    assert [tuple(r) for r in got] == [("a/a-1", "a-1"), (None, "1")]


def test_utc_now_iso(spark):
    now = spark.range(1).select(X.utc_now_iso().alias("t")).first().t
    assert now.endswith("+00:00") and now[4] == "-" and now[10] == "T"
