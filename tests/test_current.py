"""Current table and intake: only touched months are written, and nothing is brought in twice."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.sources import lake

SCHEMA = "source string, job_id string, title string, posted_date string, fetched_at string, extra int"
ROWS = [("a", "1", "one", "2024-01-05", "2024-02-01", 0), ("a", "2", "two", "2024-01-06", "2024-02-01", 0), ("b", "1", "three", "2024-02-07", "2024-02-01", 0),
        ("b", "2", "four", None, "2024-03-01", 0), ("b", "3", "five", None, None, 0), ("b", "4", "six", "2024-04-01", None, 0)]


def postings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def current(spark, path):
    return {(r.source, r.job_id): (r.title, r.month) for r in lake.read_current(spark, path).collect()}


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merge_writes_only_the_months_it_touches(spark, tmp_path):
    path = str(tmp_path / "current")
    assert lake.merge_current(postings(spark, ROWS), path) == ["2024-01", "2024-02", "2024-03", "2024-04", "none"]
    want = {("a", "1"): ("one", "2024-01"), ("a", "2"): ("two", "2024-01"), ("b", "1"): ("three", "2024-02"), ("b", "2"): ("four", "2024-03"), ("b", "3"): ("five", "none"), ("b", "4"): ("six", "2024-04")}
    assert current(spark, path) == want
    before = files(path)
    # A new version moves from January to February; an old one changes nothing; a row without a key is left out.
    updates = [("a", "1", "moved", "2024-02-09", "2024-02-02", 1), ("a", "2", "late", "2024-01-06", "2024-01-01", 1), (None, "9", "no key", "2024-04-01", "2024-05-01", 1)]
    assert lake.merge_current(postings(spark, updates), path) == ["2024-01", "2024-02"]
    want[("a", "1")] = ("moved", "2024-02")
    assert current(spark, path) == want
    after = files(path)
    kept = {f for f in before if not ("month=2024-01" in f or "month=2024-02" in f)}
    assert kept <= set(after) and all(after[f] == before[f] for f in kept)
    assert not (set(before) - kept) & set(after)


def test_merge_again_changes_nothing_and_an_emptied_month_goes(spark, tmp_path):
    path = str(tmp_path / "current")
    for _ in range(2):
        lake.merge_current(postings(spark, ROWS), path)
        assert len(current(spark, path)) == 6
    lake.merge_current(postings(spark, [("b", "4", "six", "2024-05-01", "x", 1), ("b", "4", "seven", "2024-05-01", "y", 1)]), path)
    assert current(spark, path)[("b", "4")] == ("seven", "2024-05") and not os.path.exists(f"{path}/month=2024-04")
    lake.merge_current(postings(spark, []), path)
    assert len(current(spark, path)) == 6


def test_months_are_pruned(spark, tmp_path):
    path = str(tmp_path / "current")
    lake.merge_current(postings(spark, ROWS), path)
    df = lake.read_current(spark, path).where("month IN ('2024-01', '2024-02')")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan and df.count() == 3
    assert {f.rsplit("/", 2)[1] for f in df.inputFiles()} >= {"month=2024-01"}


def test_failed_write_can_be_run_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "current")
    lake.merge_current(postings(spark, ROWS), path)
    updates = postings(spark, [("a", "1", "moved", "2024-02-09", "2024-02-02", 1)])
    # The months were written, the folder of an emptied one was not removed yet.
    shutil.copytree(f"{path}/month=2024-04", tmp_path / "kept")
    monkeypatch.setattr(lake, "remove", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        lake.merge_current(postings(spark, [("b", "4", "six", "2024-05-01", "x", 1)]), path)
    monkeypatch.undo()
    lake.merge_current(postings(spark, [("b", "4", "six", "2024-05-01", "x", 1)]), path)
    lake.merge_current(updates, path)
    got = lake.read_current(spark, path).where("job_id = '4'").collect()
    assert [(r.title, r.month) for r in got] == [("six", "2024-05")] and len(current(spark, path)) == 6


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps(dict(zip(names, r, strict=True))) + "\n" for r in rows)


def test_intake_brings_every_file_in_once(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "in"), str(tmp_path / "lake")
    put(source, "1.json", ROWS[:3])
    put(source, "2.json", ROWS[3:])
    assert lake.intake(spark, source, root, files_per_batch=1) == ["2024-01", "2024-02", "2024-03", "2024-04", "none"]
    assert len(current(spark, f"{root}/current")) == 6
    written = files(root)
    assert lake.intake(spark, source, root) == [] and files(root) == written
    # The merge fails after its file was landed: the next run merges it, and lands nothing again.
    put(source, "3.json", [("a", "1", "moved", "2024-02-09", "2024-02-02", 1)])
    with monkeypatch.context() as m:
        m.setattr(lake, "merge_current", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.intake(spark, source, root)
    landed = files(f"{root}/bronze")
    assert lake.intake(spark, source, root) == ["2024-01", "2024-02"] and files(f"{root}/bronze") == landed
    assert current(spark, f"{root}/current")[("a", "1")] == ("moved", "2024-02")
    assert lake.scan_bronze(spark, f"{root}/bronze", latest=False).count() == 7
    assert lake.scan_bronze(spark, f"{root}/bronze").count() == 6


def test_failed_batch_leaves_no_rows(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "lake")
    put(source, "1.json", ROWS)
    lake.intake(spark, source, root)
    # Files of a batch that never ended: readers see those of the log only.
    stray = next(f for f in files(f"{root}/bronze"))
    shutil.copy(stray, stray.replace("part-", "part-9"))
    assert lake.scan_bronze(spark, f"{root}/bronze", latest=False).count() == 6
    assert lake.intake(spark, source, root) == []
    assert lake.scan_bronze(spark, f"{root}/bronze").agg(F.count("*")).first()[0] == 6


def test_updates_older_than_what_is_there_write_nothing(spark, tmp_path):
    path = str(tmp_path / "current")
    lake.merge_current(postings(spark, ROWS), path)
    before = files(path)
    late = [("a", "1", "late", "2024-01-05", "2024-01-01", 1), ("b", "1", "late", "2024-06-07", "2024-01-01", 1), ("b", "3", "again", None, None, 1)]
    assert lake.merge_current(postings(spark, late[:2]), path) == [] and files(path) == before
    # Of the same time: the update stays, and only its month is written.
    assert lake.merge_current(postings(spark, late), path) == ["none"]
    assert current(spark, path)[("b", "3")] == ("again", "none") and len(current(spark, path)) == 6


def test_merges_leave_the_latest_row_of_every_key(spark, tmp_path, monkeypatch):
    path, every = str(tmp_path / "current"), {}
    monkeypatch.setattr(lake, "ROWS_PER_PART", 2)
    for turn in range(4):
        rows = [("ab"[i % 2], str(i % 13), f"{turn}-{i}", [None, "2024-01-05", "2024-02-06", "2024-03-07"][(i * 7 + turn * i) % 4], [None, "2024-02-01", "2024-03-01"][(i * 5 + turn) % 3], i)
                for i in range(turn, 13, turn + 1)]
        lake.merge_current(postings(spark, rows), path)
        for source, job, title, posted, fetched, _ in rows:
            if (source, job) not in every or (fetched or "") >= every[source, job][0]:
                every[source, job] = (fetched or "", title, (posted or fetched or "none")[:7])
        assert current(spark, path) == {k: v[1:] for k, v in every.items()}
        assert lake.read_current(spark, path).count() == len(every)


def test_merge_shuffles_whole_rows_once(spark, tmp_path, monkeypatch):
    path, plans, staged = str(tmp_path / "current"), {}, lake.staged

    def seen(df, name, *by):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name, *by)

    lake.merge_current(postings(spark, ROWS), path)
    monkeypatch.setattr(lake, "staged", seen)
    lake.merge_current(postings(spark, ROWS[:2]), path)
    assert plans["merged"].count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(month" in plans["merged"]
    assert "requirements" not in plans["met"]
