"""Records of JSON arrays in byte ranges, against a JSON parser."""

import json
import random

import pytest
from pyspark.sql import functions as F

from checks import queries
from tidemark.sources import flat, json_array, lake, nested

TEXTS = ["", "plain", 'quote " and \\ back\\\\', "}{][,:", "\\", '"', "新竹縣é😀", 'a\\"}', "{\"data\": [{\"x\": 1}]}", "line\nbreak\t", "\\" * 70 + '"']


def value(rng, deep=0):
    kind = rng.randrange(7 if deep < 3 else 4)
    if kind < 3:
        return rng.choice(TEXTS)
    if kind == 3:
        return rng.choice([1, -2.5, True, None])
    if kind == 4:
        return [value(rng, deep + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(TEXTS): value(rng, deep + 1) for _ in range(rng.randrange(3))}


def record(rng, i):
    return {"i": i, **{f"k{rng.randrange(9)}": value(rng) for _ in range(rng.randrange(5))}}


def read(spark, path, size, wrappers=()):
    return sorted((json.loads(r.value) for r in json_array.read_records(spark, str(path), wrappers, size).collect()), key=lambda r: r["i"])


@pytest.mark.parametrize("size", [1, 7, 64, 1000, 1 << 20])
def test_ranges_of_any_size_give_every_record_once(spark, tmp_path, size):
    rng = random.Random(size)
    records = [record(rng, i) for i in range(4 if size == 1 else 12 if size < 50 else 60)]
    mixed = [x for r in records for x in (r, rng.choice([1, "text {", None, [{"i": -1}], []]))]
    # Pretty-printed, compact, with escapes of all characters, and with other values between the records.
    for name, text in (("a", json.dumps(records, indent=2, ensure_ascii=False)), ("b", json.dumps(records, ensure_ascii=True, separators=(",", ":"))), ("c", " \n" + json.dumps(mixed, ensure_ascii=False) + "\n")):
        path = tmp_path / f"{name}.json"
        path.write_text(text, encoding="utf-8")
        if size > 1 or name == "b":
            assert read(spark, path, size) == records


def test_wrappers(spark, tmp_path):
    rng = random.Random(3)
    records = [record(rng, i) for i in range(20)]
    noise = {"meta": [{"i": -1}], "info": {"data": [{"i": -2}], "x": {"y": {"i": -3}}}, "text": '"data": [{"i": -4}]'}
    cases = {
        "data": {**noise, "data": records}, "result": {"result": records, **noise}, "both": {"result": [{"i": -5}], "data": records, "z": noise},
        "empty": {"data": [], "result": records}, "no array": {"data": None, "result": records, "tail": [{"i": -6}, [{"i": -7}]]},
    }
    for name, top in cases.items():
        for i, text in enumerate((json.dumps(top), json.dumps(top, indent=3, ensure_ascii=False))):
            path = tmp_path / f"{name}-{i}.json"
            path.write_text(text, encoding="utf-8")
            assert read(spark, path, 200, ("data", "result")) == records
    for name, text in (("none", json.dumps(noise)), ("blank", ""), ("number", "5"), ("list", "[]"), ("object", "{}")):
        (tmp_path / f"{name}.json").write_text(text)
        assert read(spark, tmp_path / f"{name}.json", 50, ("data", "result")) == []


def test_one_file_is_many_tasks_and_several_files_are_read(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.json").write_text(json.dumps([{"i": 1000 * n + i, "t": "x" * 50} for i in range(500)]))
    df = json_array.read_records(spark, str(tmp_path / "*.json"), range_bytes=4000)
    assert len({r.i // 1 for r in df.selectExpr("cast(get_json_object(value, '$.i') as int) as i").collect()}) == 1500
    assert df.selectExpr("spark_partition_id() as p").distinct().count() > 2


def test_flat_and_nested_readers_equal_the_readers_of_whole_documents(spark, tmp_path):
    flats = [{"OCCU_DESC（a）": f"Dev {i}", "NT_L（b）": 40000 + i, "JOB_DETAIL（c）": {"x": [1, "}"]}, "COMPNAME（d）": None, "extra": [1, 2]} for i in range(30)]
    (tmp_path / "f.json").write_text(json.dumps({"data": flats}, ensure_ascii=False), encoding="utf-8")
    rows = lambda df: sorted(map(str, df.select(*flat.KEYS).collect()))
    got = flat.read_array(spark, str(tmp_path / "f.json"), 300)
    # An object is its JSON text here; the reader of whole documents writes it as Spark shows a struct.
    assert {r.JOB_DETAIL for r in got.collect()} == {'{"x":[1,"}"]}'}
    whole = flat.read_document(spark, str(tmp_path / "f.json"))
    assert got.columns == list(flat.KEYS) and rows(got.withColumn("JOB_DETAIL", F.lit(1))) == rows(whole.withColumn("JOB_DETAIL", F.lit(1)))
    payloads = [{"jobId": str(i), "data": {"header": {"jobName": f"J{i}"}, "condition": {"skill": rngs, "workExp": 5, "edu": "大學"}, "jobDetail": {"jobCategory": [{"description": "IT"}]}}}
                for i, rngs in enumerate([[{"description": "a"}, "b"], ["c"], None, "d", 4, {}])]
    (tmp_path / "n.json").write_text(json.dumps(payloads, ensure_ascii=False), encoding="utf-8")
    parsed = [nested.parse_nested(df).drop("fetched_at") for df in (nested.read_array(spark, str(tmp_path / "n.json"), 50), nested.read_payloads(spark, str(tmp_path / "n.json"), True))]
    assert sorted(map(str, parsed[0].collect())) == sorted(map(str, parsed[1].collect())) and parsed[0].count() == 6


def test_small_ranges_are_dealt_over_tasks_by_their_bytes(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps({"data": [{"i": i, "t": "x" * 50} for i in range(300)]}))
    df = json_array.read_records(spark, str(path), ("data",), 40)
    assert df.count() == 300
    assert 2 < df.selectExpr("spark_partition_id() as p").distinct().count() <= 4 * spark.sparkContext.defaultParallelism


def test_only_ranges_at_the_top_are_read_for_the_wrapper(spark, tmp_path, monkeypatch):
    path, read = tmp_path / "a.json", []
    path.write_text(json.dumps({"total": [1], "data": [{"i": i, "t": [{"x": "}]"}]} for i in range(300)], "more": {"data": []}}))
    dealt = json_array._dealt
    monkeypatch.setattr(json_array, "_dealt", lambda rows: read.append(rows.count()) or dealt(rows))
    assert json_array.read_records(spark, str(path), ("data",), 100).count() == 300
    assert read[0] == read[2] > 50 and read[1] < 5


def test_marks_are_those_of_the_definition():
    rng = random.Random(4)
    for _ in range(2000):
        raw, escaped = bytes(rng.choices(b'\\\\\\""{}[],a', k=rng.randint(0, 14))), rng.random() < 0.5
        expected, odd = [], escaped
        for place, c in enumerate(raw):
            if c in b"{}[]" or (c == ord('"') and not odd):
                expected.append((place, c))
            odd = c == ord("\\") and not odd
        at, marks = json_array._marks(raw, escaped)
        assert list(zip(at.tolist(), marks.tolist(), strict=True)) == expected


def test_long_records_and_bytes_that_are_no_text(spark, tmp_path):
    records = [{"i": i, "t": ('x"{\\' * 30_000 if i % 3 else "y") + "é"} for i in range(8)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(records, ensure_ascii=False), encoding="utf-8")
    assert read(spark, path, 5000) == records
    path.write_bytes(b'[{"i": 1, "t": "a\xff"}, {"i": 2, "t": "\xc3\xa9"}]')
    assert [r["t"] for r in read(spark, path, 1000)] == ["a�", "é"]


def test_records_are_put_in_one_array_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake, "new_folder", lambda _, name: str(tmp_path / name))
    records = spark.range(100, numPartitions=4).withColumn("t", F.lit('新 "x"'))
    path = queries._one_array(spark, records, '{"total": [1], "data": [', "null]}")
    files = [p for p in (tmp_path / "array").iterdir() if not p.name.startswith((".", "_"))]
    assert str(tmp_path / "array") == path and len(files) == 1 and not (tmp_path / "parts").exists()
    data = json.loads(files[0].read_text(encoding="utf-8"))
    assert sorted(r["id"] for r in data["data"][:-1]) == list(range(100)) and data["data"][-1] is None and data["data"][0]["t"] == '新 "x"'
