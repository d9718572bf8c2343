"""Pairs of documents decided by their full sets, in one shuffle of sets.

The pairs (a, b) are stars around their b. A document's set is made once, from its text, and sent to each b it
is paired with; b's own set goes to the same place, before the others, so one set is held while the rest
stream by. A star of many pairs is dealt over several places, to each of which its b is sent, so neither
a popular b nor its pairs fill a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import small_side
from tidemark.sources.lake import scratch, staged

#: Pairs of a star that go to one place.
STAR = 256
#: Documents in pairs that are sent to all executors to be picked out there; more are joined.
BROADCAST_DOCS = 500_000
#: Bytes of sets in one Arrow batch.
BATCH_BYTES = 8 << 20

Sets = Callable[[pa.Array], Iterator[tuple[int, np.ndarray]]]
Judge = Callable[[np.ndarray, np.ndarray], tuple | None]
_SENT = "b long, place int, self boolean, a long, members binary"


def _send(sets: Sets):
    def run(batches):
        for batch in batches:
            ids, sends = batch.column("doc_id"), batch.column("sends")
            out, held = [], 0
            for row, s in sets(batch.column("text")):
                if not len(s):
                    continue
                members, own = s.tobytes(), ids[row].as_py()
                for x in sends[row].as_py():
                    out.append((x["b"], x["place"], x["self"], own, members))
                    held += len(members)
                    if held > BATCH_BYTES:
                        yield _rows(out)
                        out, held = [], 0
            if out:
                yield _rows(out)

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], ["b", "place", "self", "a", "members"])


def _compare(judge: Judge, names: list[str], kinds: list[pa.DataType]):
    def run(batches):
        at, held = None, []
        for batch in batches:
            found = []
            members = batch.column("members")
            for i, (b, place, own, a) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("b", "place", "self", "a")), strict=True)):
                if (b, place) != at:
                    at, held = (b, place), []
                s = np.frombuffer(members[i].as_buffer(), np.uint64)
                if own:  # an id may have several texts
                    held.append(s.copy())
                else:
                    found += [(a, b, *said) for x in held if (said := judge(s, x)) is not None]
            columns = list(zip(*found, strict=True)) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)

    return run


def proved(docs: DataFrame, pairs: DataFrame, sets: Sets, test: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """The pairs (a, b) of which some texts' sets pass the test, given a's set and b's, as a staged table."""
    return compared(docs, pairs, sets, lambda x, y: () if test(x, y) else None, [])


def compared(docs: DataFrame, pairs: DataFrame, sets: Sets, judge: Judge, columns: list[str]) -> DataFrame:
    """(a, b, columns: numbers, given as names) of the pairs of which `judge` says something, given a's set and
    b's, as a staged table. `docs` has doc_id and text, `sets` gives (row, set) of a batch of texts."""
    spark = docs.sparkSession
    with scratch(spark) as scope:
        pairs = staged(pairs.select("a", "b").distinct(), "pairs")
        places = F.ceil(F.col("n") / STAR).cast("int")
        stars = staged(pairs.groupBy("b").agg(F.count("*").alias("n")).select("b", places.alias("places")), "stars")
        send = F.struct("b", "place", "self").alias("send")
        to = pairs.join(stars, "b").withColumns({"place": F.pmod(F.xxhash64("a"), "places").cast("int"), "self": F.lit(False)}).select(F.col("a").alias("doc_id"), send)
        own = stars.withColumns({"place": F.explode(F.expr("sequence(0, places - 1)")), "self": F.lit(True)}).select(F.col("b").alias("doc_id"), send)
        sends = staged(to.unionByName(own).groupBy("doc_id").agg(F.collect_list("send").alias("sends")), "sends")
        sent = docs.select("doc_id", "text").join(small_side(sends, sends.count(), BROADCAST_DOCS), "doc_id").select("doc_id", "text", "sends")
        sent = sent.mapInArrow(_send(sets), _SENT)
        shards = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        sent = sent.repartition(shards, "b", "place").sortWithinPartitions("b", "place", F.desc("self"))
        names = ["a", "b", *columns]
        compare = _compare(judge, names, [pa.int64()] * len(names))
        return scope.keep(sent.mapInArrow(compare, ", ".join(f"{c} long" for c in names)), "links")
