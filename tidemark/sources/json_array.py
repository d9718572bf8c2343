"""Records of large JSON arrays, read in byte ranges.

A file with one array of objects has no line to split at, and whether a brace is one or a part of a text
depends on all quotes before it. So a file is read twice by many tasks:

1. Each range counts its quotes and, for a start outside and inside a text, how much deeper it ends and how low it
   gets. A sum over the ranges before gives every range the state it begins in.
2. Each range cuts out the records that begin in it, reading on behind its end for the last one.

A file whose top is an object holds its array under one of the wrapper keys; an earlier key counts before a later one,
unless its array is empty. Where arrays open is found between the two passes, only for such files and by the ranges
that get as low as the top object. An escape before a range is told by the bytes just before it, so ranges may begin anywhere, also
inside a character.

Records come as JSON text, unparsed and in no order; what an array holds besides objects is left out, and
so is a file without such an array. Reading is Python with Arrow batches, as Spark's own reader gives such a
file to one task. Stores are those that pyarrow reaches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.lake import staged

RANGE_BYTES = 32 << 20
#: Text of records in one Arrow batch.
BATCH_BYTES = 8 << 20
#: Text of the ranges that one task reads.
TASK_BYTES = 32 << 20
#: First piece read behind a range for its last record; the next ones are twice as long each.
BEHIND_BYTES = 1 << 14
_QUOTE, _BACKSLASH, _OBJECT, _OBJECT_END, _ARRAY = b'"\\{}['
_MARKS = bytes(c in b'"\\{}[]' for c in range(256))
_STEPS = np.zeros(256, np.int8)
_STEPS[list(b"{[")], _STEPS[list(b"}]")] = 1, -1
_RANGE = "path string, number int, start long, stop long, size long"


def _ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """(path, number, start, stop, size) of all files."""
    listed = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"))
    count = F.greatest(F.ceil(F.col("size") / range_bytes), F.lit(1))
    rows = listed.select("path", "size", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("number"))
    start = F.col("number").cast("long") * range_bytes
    return rows.select("path", "number", start.alias("start"), F.least(start + range_bytes, F.col("size")).alias("stop"), "size")


def _dealt(rows: DataFrame) -> DataFrame:
    """Ranges dealt over tasks of about TASK_BYTES, but over every core, also where the ranges are small: rows are few
    and small, and would else be brought together in one."""
    n, size = rows.agg(F.count("*"), F.sum(F.col("stop") - F.col("start"))).first()
    tasks = max(-(-(size or 0) // TASK_BYTES), 4 * rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(max(min(n, tasks), 1))


def _open(path: str):
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem().open_input_file(path)
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _escaped(file, start: int) -> bool:
    """Whether the byte at `start` stands after an odd number of backslashes."""
    run, at = 0, start
    while at:
        before = file.read_at(min(64, at), at - min(64, at))
        own = len(before) - len(before.rstrip(b"\\"))
        run, at = run + own, at - len(before)
        if own < len(before):
            break
    return run % 2 == 1


def _marks(raw: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray]:
    """(place, byte) of the quotes that begin or end a text, and of all brackets. What follows is done on these alone."""
    at = np.flatnonzero(np.frombuffer(raw.translate(_MARKS), np.bool_))
    marks = np.frombuffer(raw, np.uint8)[at]
    slash, quote = marks == _BACKSLASH, marks == _QUOTE
    literal = np.zeros(len(at), bool)
    if slash.any():
        order = np.arange(len(at))
        beside = np.diff(at, prepend=-2) == 1
        goes_on = slash & beside & np.concatenate([[False], slash[:-1]])
        begin = np.maximum.accumulate(np.where(slash & ~goes_on, order, 0))
        odd = (order - begin + 1 + ((at[begin] == 0) & escaped)) % 2 == 1
        literal[1:] = quote[1:] & beside[1:] & (slash & odd)[:-1]
    if escaped and len(at) and at[0] == 0:
        literal[0] = quote[0]
    kept = ~(slash | literal)
    return at[kept], marks[kept]


def _steps(marks: np.ndarray, inside: bool) -> np.ndarray:
    """+1 where an object or array opens, -1 where one closes, else 0."""
    outside = (np.cumsum(marks == _QUOTE) + inside) % 2 == 0
    return _STEPS[marks] * outside


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., first: first byte of the file that is no space, odd: quotes, outside and inside: change of depth,
    low_outside and low_inside: the least depth on the way, 0 at the begin)."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            with _open(r["path"]) as f:
                raw = f.read_at(r["stop"] - r["start"], r["start"])
                _, marks = _marks(raw, _escaped(f, r["start"]))
            depths = [np.cumsum(_steps(marks, inside), dtype=np.int64) for inside in (False, True)]
            rows.append((raw[:4096].lstrip()[:1].decode("latin-1") if r["number"] == 0 else None, int((marks == _QUOTE).sum()) % 2,
                         *(int(d[-1]) if len(d) else 0 for d in depths), *(int(d.min(initial=0)) for d in depths)))
        found = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), *[pa.int64()] * 4), strict=True)] if rows else None
        if found:
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, "first", "odd", "outside", "inside", "low_outside", "low_inside"])


def _states(ranges: DataFrame) -> DataFrame:
    """Ranges with the state they begin in: inside a text or not, depth, least depth, and the first byte of the file."""
    # A row per range: what a window sorts is smaller than the file by RANGE_BYTES.
    before = Window.partitionBy("path").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    rows = _dealt(ranges).mapInArrow(_summaries, f"{_RANGE}, first string, odd int, outside long, inside long, low_outside long, low_inside long")
    rows = rows.withColumn("within", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside"))
    rows = rows.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    rows = rows.withColumn("low", F.col("depth") + F.when(F.col("within"), F.col("low_inside")).otherwise(F.col("low_outside")))
    top = F.first("first", ignorenulls=True).over(Window.partitionBy("path").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.withColumn("top", top).select(*[c.split()[0] for c in _RANGE.split(", ")], "within", "depth", "low", "top")


def _containers(wrappers: Sequence[str]):
    """(path, open, rank) of what opens in the top object; rank where that is a non-empty array under a
    wrapper key."""

    def run(batches):
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                with _open(r["path"]) as f:
                    places, marks = _marks(f.read_at(r["stop"] - r["start"], r["start"]), _escaped(f, r["start"]))
                    steps = _steps(marks, r["within"])
                    depth = r["depth"] + np.cumsum(steps, dtype=np.int64)
                    for i in np.flatnonzero((steps == 1) & (depth == 2)).tolist():
                        place = r["start"] + int(places[i])
                        rank = _key_rank(f, place, wrappers) if marks[i] == _ARRAY else None
                        found.append((r["path"], place, None if _next(f, place + 1, r["size"]) == b"]" else rank))
            yield pa.RecordBatch.from_pydict({"path": pa.array([x[0] for x in found], pa.string()), "open": pa.array([x[1] for x in found], pa.int64()),
                                              "rank": pa.array([x[2] for x in found], pa.int32())})

    return run


def _key_rank(file, place: int, wrappers: Sequence[str]) -> int | None:
    """Which wrapper key stands before the array that opens at the place."""
    longest = max(len(w.encode()) for w in wrappers)
    size = 4096 + longest
    text = file.read_at(min(size, place), max(place - size, 0)).rstrip()
    if not text.endswith(b":"):
        return None
    text = text[:-1].rstrip()
    return next((i for i, w in enumerate(wrappers) if text.endswith(b'"' + w.encode() + b'"')), None)


def _next(file, at: int, size: int) -> bytes:
    """The next byte that is no space."""
    while at < size:
        part = file.read_at(min(4096, size - at), at)
        if kept := part.lstrip():
            return kept[:1]
        at += len(part)
    return b""


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value) of the records that begin in the ranges, after `open` and before `until`. `level` is the
    depth of their array."""
    for batch in batches:
        rows, held = [], 0
        for r in batch.to_pylist():
            with _open(r["path"]) as f:
                for value in _records(f, r):
                    rows.append(value)
                    held += len(value)
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([_texts(rows)], ["value"])
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([_texts(rows)], ["value"])


def _texts(values: list[bytes]) -> pa.Array:
    try:
        return pa.array(values, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        return pa.array([v.decode("utf-8", "replace") for v in values], pa.string())


def _records(file, r: dict) -> Iterator[bytes]:
    level = r["level"]
    raw = file.read_at(r["stop"] - r["start"], r["start"])
    at, marks = _marks(raw, _escaped(file, r["start"]))
    steps = _steps(marks, r["within"])
    depth = r["depth"] + np.cumsum(steps, dtype=np.int64)
    place = at + r["start"]
    begins = at[(steps == 1) & (depth == level + 1) & (marks == _OBJECT) & (r["open"] < place) & (place < r["until"])]
    ends = at[(steps == -1) & (depth == level) & (marks == _OBJECT_END)]
    following = np.searchsorted(ends, begins)
    whole = int(np.searchsorted(following, len(ends)))
    for begin, end in zip(begins[:whole].tolist(), ends[following[:whole]].tolist(), strict=True):
        yield raw[begin : end + 1]
    if whole < len(begins):  # the last one, which goes on behind the range
        begin, behind, size = int(begins[whole]), r["stop"], BEHIND_BYTES
        parts, inside, deep = [raw[begin:]], bool((int((marks == _QUOTE).sum()) + r["within"]) % 2), int(depth[-1])
        while behind < r["size"]:
            more = file.read_at(min(size, r["size"] - behind), behind)
            at, marks = _marks(more, _escaped(file, behind))
            step = _steps(marks, inside)
            now = deep + np.cumsum(step, dtype=np.int64)
            end = at[(step == -1) & (now == level)]
            if len(end):
                yield b"".join([*parts, more[: int(end[0]) + 1]])
                break
            parts.append(more)
            inside, behind, size = bool((int((marks == _QUOTE).sum()) + inside) % 2), behind + len(more), min(2 * size, 1 << 24)
            deep = int(now[-1]) if len(now) else deep


def read_records(spark: SparkSession, path: str, wrappers: Sequence[str] = (), range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(value): the objects of the JSON array in each file, as text."""
    states = staged(_states(_ranges(spark, path, range_bytes)), "ranges")
    columns = [*states.columns, "level", "open", "until"]
    held = states.where("top = '['").withColumns({"level": F.lit(1), "open": F.lit(-1).cast("long"), "until": F.col("size")}).select(columns)
    if wrappers:
        top = states.where("top = '{'")
        # An array opens in the top object only where the depth is 1, which is not so within a large array.
        opened = staged(_dealt(top.where("low <= 1")).mapInArrow(_containers(wrappers), "path string, open long, rank int"), "arrays")
        # A key that is there twice counts with its last array.
        chosen = opened.where("rank IS NOT NULL").groupBy("path").agg(F.min(F.struct("rank", (-F.col("open")).alias("back"))).alias("first"))
        chosen = chosen.select("path", (-F.col("first.back")).alias("open"))
        later = opened.select("path", F.col("open").alias("other")).join(chosen, "path").where("other > open").groupBy("path").agg(F.min("other").alias("until"))
        bounds = chosen.join(later, "path", "left")
        wrapped = top.join(bounds, "path").withColumns({"level": F.lit(2), "until": F.coalesce("until", "size")})
        held = held.unionByName(wrapped.select(columns))
    return _dealt(held).mapInArrow(_cut, "value string")
