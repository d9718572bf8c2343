"""Ranked lexical search, hybrid term- and document-at-a-time.

Documents are indexed in shards, a row of a table each: ids, lengths, and for each term of the items an
inverted list of ordinals and occurrences. A shard answers an item in two ways:

* Term at a time: the lists are taken by length, and the short ones, as many as together have no more
  postings than the shard has documents, are summed into accumulators.
* Document at a time: the accumulators are one more iterator beside the long lists, all bounded by their
  greatest contribution. By windows of ordinals, iterators whose bounds together stay below the score
  wanted bring no document by themselves; windows whose own bounds stay below it are skipped; and a
  document is looked up in the lists it was not found in only while it can still reach that score.

The score wanted is the item's TOP-th best so far, over all shards of the task, or of the accumulators.
Equal scores are not skipped, as the smaller id wins. Each task gives TOP rows an item, which are ranked
once more. Document frequencies and lengths are summed over all documents. Scores are 64-bit integers.

Items are asked in blocks of about BLOCK_TERMS terms, dealt by hash, so what is sent to executors has a
bound however many items there are; each block is one pass over the documents. Terms are told by 64-bit
hashes.

Nulls and texts without a term: such a document is not counted and never found, such an item finds
nothing. A null doc_id is a document and comes after the others of its score. Rows that repeat a doc_id
are documents of their own. Rows that repeat item_id and text are one item; other texts of an item_id,
or of none, are items of their own under that id. Long texts are taken whole, other columns ignored. Empty tables
give no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import PLAIN, chunks
from tidemark.sources.lake import Scratch, scratch, staged

TOP = 10
BLOCK_TERMS = 1 << 20
SHARD_DOCS, SHARD_BYTES = 8192, 16 << 20
WINDOW = 2048


# Items

def _terms_of_items(batches):
    """(item_id, text) to (item_id, terms: sorted distinct hashes, counts, n_terms)."""
    for batch in batches:
        for chunk in chunks(batch.column("text"), PLAIN, lower=True):
            hashes, terms, counts, n = chunk.hashes(), [], [], []
            for i in range(chunk.rows):
                x, c = np.unique(hashes[chunk.bounds[i] : chunk.bounds[i + 1]], return_counts=True)
                terms.append(x.tobytes()), counts.append(c.astype(np.int64).tobytes()), n.append(len(x))
            own = batch.column("item_id").slice(chunk.first_row, chunk.rows)
            yield pa.RecordBatch.from_arrays([own, pa.array(terms, pa.binary()), pa.array(counts, pa.binary()), pa.array(n, pa.int64())],
                                             ["item_id", "terms", "counts", "n_terms"])


# Index

def _index(shared):
    """Shards of the partition's documents: (ids, nulls, lengths; terms, sizes, docs, occurrences; n_docs, n_words)."""

    def run(batches):
        vocabulary, held = shared.value, _Held()
        for batch in batches:
            ids = batch.column("doc_id")
            for chunk in chunks(batch.column("text"), PLAIN, lower=True):
                held.add(chunk, ids, vocabulary)
                if held.rows >= SHARD_DOCS or held.size >= SHARD_BYTES:
                    yield held.shard(len(vocabulary))
                    held = _Held()
        if held.rows:
            yield held.shard(len(vocabulary))

    return run


_SHARD = "ids binary, nulls binary, lengths binary, terms binary, sizes binary, docs binary, occurrences binary, n_docs long, n_words long"


class _Held:
    """Documents with a term, and the places of the wanted terms in them."""

    def __init__(self):
        self.ids, self.nulls, self.lengths, self.docs, self.terms, self.rows, self.size = [], [], [], [], [], 0, 0

    def add(self, chunk, ids, vocabulary: np.ndarray) -> None:
        lengths = np.diff(chunk.bounds)
        there = lengths > 0
        hashes = chunk.hashes()
        at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
        wanted = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.empty(0, np.int64)
        ordinals = self.rows + np.cumsum(there) - 1
        self.docs.append(np.repeat(ordinals, lengths)[wanted])
        self.terms.append(at[wanted])
        own = ids.slice(chunk.first_row, chunk.rows).to_numpy(zero_copy_only=False) if not ids.null_count else None
        if own is None:
            part = ids.slice(chunk.first_row, chunk.rows)
            self.nulls.append(np.array(part.is_null().to_numpy(zero_copy_only=False))[there])
            own = part.fill_null(0).to_numpy(zero_copy_only=False)
        else:
            self.nulls.append(np.zeros(int(there.sum()), bool))
        self.ids.append(own[there])
        self.lengths.append(lengths[there])
        self.rows += int(there.sum())
        self.size += len(chunk.data)

    def shard(self, n_terms: int) -> pa.RecordBatch:
        n, lengths = self.rows, np.concatenate(self.lengths)
        pairs, counts = np.unique(np.concatenate(self.terms).astype(np.int64) * n + np.concatenate(self.docs), return_counts=True)
        terms, sizes = np.unique(pairs // max(n, 1), return_counts=True)
        row = (np.concatenate(self.ids).astype("<i8"), np.concatenate(self.nulls).astype(np.uint8), lengths.astype("<i8"), terms.astype("<u4"),
               sizes.astype("<u4"), (pairs % max(n, 1)).astype("<u4"), counts.astype("<u4"))
        names = [c.split()[0] for c in _SHARD.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row] + [pa.array([n], pa.int64()), pa.array([int(lengths.sum())], pa.int64())], names)


def _frequencies(batches):
    """(term, df) of the partition's shards."""
    total: dict[int, int] = {}
    for batch in batches:
        for terms, sizes in zip(batch.column("terms").to_pylist(), batch.column("sizes").to_pylist(), strict=True):
            for t, s in zip(np.frombuffer(terms, "<u4").tolist(), np.frombuffer(sizes, "<u4").tolist(), strict=True):
                total[t] = total.get(t, 0) + s
    if total:
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(total), pa.int64()), "df": pa.array(list(total.values()), pa.int64())})


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# Search

@dataclass
class Shard:
    ids: np.ndarray
    nulls: np.ndarray
    terms: np.ndarray
    starts: np.ndarray  # of list i: starts[i] : starts[i + 1]
    docs: np.ndarray
    impacts: np.ndarray
    most: np.ndarray = field(init=False)  # greatest impact of each list

    def __post_init__(self):
        self.most = np.maximum.reduceat(self.impacts, self.starts[:-1]) if len(self.terms) else np.empty(0, np.int64)

    @classmethod
    def of(cls, row: dict, n_docs: int, n_words: int) -> Shard:
        lengths = np.frombuffer(row["lengths"], "<i8").astype(np.int64)
        if len(lengths) and 75 * int(lengths.max()) * n_docs >= 1 << 63:
            lengths = lengths.astype(object)
        m = (100 - 75 + 75 * lengths * n_docs // n_words).astype(np.int64)
        docs = np.frombuffer(row["docs"], "<u4").astype(np.int64)
        tf = np.frombuffer(row["occurrences"], "<u4").astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], "<u4").astype(np.int64))])
        return cls(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["nulls"], np.uint8), np.frombuffer(row["terms"], "<u4").astype(np.int64),
                   starts, docs, 1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))


class Best:
    """The best documents of an item so far: score down, ids up, nulls last."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.nulls, self.ids = np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        """Score below which nothing is wanted."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        scores, nulls, ids = (np.concatenate(x) for x in ((self.scores, scores), (self.nulls, nulls), (self.ids, ids)))
        first = np.lexsort((ids, nulls, -scores))[: self.top]
        self.scores, self.nulls, self.ids = scores[first], nulls[first], ids[first]


def _summed(docs: list[np.ndarray], scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    every = np.concatenate(docs)
    order = np.argsort(every, kind="stable")
    every, own = every[order], np.concatenate(scores)[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    return every[first], np.add.reduceat(own, first) if len(first) else np.empty(0, np.int64)


def search(shard: Shard, terms: np.ndarray, weights: np.ndarray, best: Best, window: int = WINDOW) -> None:
    """Add the shard's documents to the best ones of an item (sorted terms, and weight times repeats of each)."""
    at = np.minimum(np.searchsorted(shard.terms, terms), max(len(shard.terms) - 1, 0))
    if not len(shard.terms):
        return
    here = (shard.terms[at] == terms) & (weights > 0)
    at, weights = at[here], weights[here]
    if not len(at):
        return
    sizes = shard.starts[at + 1] - shard.starts[at]
    order = np.argsort(sizes, kind="stable")
    n_short = int(np.searchsorted(np.cumsum(sizes[order]), len(shard.ids), "right"))
    slices = [slice(shard.starts[i], shard.starts[i + 1]) for i in at]

    # Term at a time over the short lists.
    short = order[:n_short]
    sums = _summed([shard.docs[slices[i]] for i in short], [shard.impacts[slices[i]] * weights[i] for i in short])
    floor = best.floor
    if len(sums[1]) >= best.top:
        floor = max(floor, int(np.partition(sums[1], -best.top)[-best.top]))

    # Document at a time over the accumulators and the long lists, least bounds first.
    lists = [(int(shard.most[at[i]] * weights[i]), shard.docs[slices[i]], shard.impacts[slices[i]], int(weights[i])) for i in order[n_short:]]
    if len(sums[0]):
        lists.append((int(sums[1].max()), *sums, 1))
    lists.sort(key=lambda x: x[0])
    bounds = np.cumsum([x[0] for x in lists])
    if bounds[-1] < floor:
        return
    places = np.arange(0, len(shard.ids) + window, window)
    edges = [np.searchsorted(docs, places) for _, docs, _, _ in lists]
    for w in range(len(places) - 1):
        tops = np.array([int(x[e[w] : e[w + 1]].max()) * q if e[w] < e[w + 1] else 0 for (_, _, x, q), e in zip(lists, edges, strict=True)], np.int64)
        reach = np.cumsum(tops)
        if reach[-1] < floor:
            continue
        essential = int(np.searchsorted(reach, floor, "left"))  # the lists before it can't reach the floor together
        parts = [(docs[e[w] : e[w + 1]], x[e[w] : e[w + 1]] * q) for (_, docs, x, q), e in zip(lists[essential:], edges[essential:], strict=True)]
        docs, scores = _summed([p[0] for p in parts], [p[1] for p in parts])
        for i in reversed(range(essential)):
            alive = scores + reach[i] >= floor
            docs, scores = docs[alive], scores[alive]
            if not len(docs):
                break
            _, own, x, q = lists[i]
            own, x = own[edges[i][w] : edges[i][w + 1]], x[edges[i][w] : edges[i][w + 1]]
            if len(own):
                p = np.minimum(np.searchsorted(own, docs), len(own) - 1)
                scores = scores + np.where(own[p] == docs, x[p] * q, 0)
        alive = scores >= floor
        if alive.any():
            docs, scores = docs[alive], scores[alive]
            best.add(scores, shard.nulls[docs], shard.ids[docs])
            floor = max(floor, best.floor)


def _search(shared, top: int):
    def run(batches):
        items, weights, n_docs, n_words = shared.value
        found = [Best(top) for _ in items]
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard.of(row, n_docs, n_words)
                for (terms, counts), best in zip(items, found, strict=True):
                    search(shard, terms, weights[terms] * counts, best)
        numbers = np.repeat(np.arange(len(items)), [len(b.ids) for b in found])
        if len(numbers):
            nulls = np.concatenate([b.nulls for b in found]).astype(bool)
            yield pa.RecordBatch.from_pydict({"item": pa.array(numbers, pa.int64()), "doc_id": pa.array(np.concatenate([b.ids for b in found]), pa.int64(), mask=nulls),
                                              "score": pa.array(np.concatenate([b.scores for b in found]), pa.int64())})

    return run


def _block(docs: DataFrame, items: DataFrame, top: int, scope: Scratch) -> DataFrame | None:
    """Ranked documents of one block of items."""
    spark = docs.sparkSession
    rows = [r for r in items.collect() if r.n_terms]
    if not rows:
        return None
    vocabulary = np.unique(np.concatenate([np.frombuffer(r.terms, np.uint64) for r in rows]))
    index = staged(docs.mapInArrow(_index(spark.sparkContext.broadcast(vocabulary)), _SHARD), "index")
    n_docs, n_words = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for r in index.select("terms", "sizes").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        weights[r.term] = weight(n_docs, r.df)
    asked = [(np.searchsorted(vocabulary, np.frombuffer(r.terms, np.uint64)), np.frombuffer(r.counts, np.int64)) for r in rows]
    shared = spark.sparkContext.broadcast((asked, weights, n_docs, n_words))
    found = index.drop("n_docs", "n_words").mapInArrow(_search(shared, top), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
    ranked = staged(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
    scope.drop(index)
    return ranked


def search_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents (doc_id, text) of every item (item_id, text)."""
    with scratch(docs.sparkSession) as scope:
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        texts = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
        kind = items.schema["item_id"].dataType.simpleString()
        asked = staged(texts.mapInArrow(_terms_of_items, f"item_id {kind}, terms binary, counts binary, n_terms long"), "items")
        total = asked.agg(F.coalesce(F.sum("n_terms"), F.lit(0))).first()[0]
        blocks = -(-total // block_terms)
        own = F.pmod(F.xxhash64("item_id", "terms", "counts"), F.lit(max(blocks, 1)))
        found = [x for i in range(blocks) if (x := _block(docs, asked.where(own == i), top, scope)) is not None]
        result = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
        for x in found:
            result = result.unionByName(x)
        return scope.keep(result, "found")
