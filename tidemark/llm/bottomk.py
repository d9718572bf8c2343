"""Near duplicates by bottom-k sketches from one hash function.

A text's set is its word shingles, each a 64-bit hash; its sketch is the K smallest hashes. The smallest
hashes of a union of sets are a random sample of the union, and each of them that both sets hold is in
both sketches.

* Inverted lists: their keys are runs of adjacent retained values, not single values, which common
  shingles would bring into lists of unrelated texts. Where a share t of the union is common and the rest
  cuts the common part, in order of hashes, into pieces, one piece is a run of RUN values or more: of
  whole sets this is a count (`_needed`), and of larger sets the sketches miss a linked pair with a
  probability below 1e-9 for K = 64 and t = 0.8 (`missed`). Lists are found by a sort that streams.
* The first member of a list is its pivot, and each other one is paired with it: no more pairs than
  members, however long the list. Pairs that link make components. Only members of one list in
  *different* components can join anything after that.
* Comparing a member's set with its pivot's leaves a difference: bits of the pivot's values that it lacks and of
  the values that it has besides. Two members of a star have at most the pivot's values that neither lacks
  in common, and what both have besides, which the bits bound without their sets. So a group of copies that
  are near but do not link costs no pairs of sets. Members too far from their pivot for that, as of texts that share
  a passage, are told apart by 256 parity bits of each set: every bit that differs is a value that only one has.
* The sketch of the union estimates the similarity of a pair. What is below the threshold by more than
  chance allows (1e-9) is dropped before sets are fetched.
* What is left is decided by the full sets.

Documents with equal sets are one class, told by a 128-bit sum over the set, and only its smallest id is
looked at. Nulls and texts without a word: an empty set, linked with nothing. A null id can't be linked
to: its component is null, and it is kept. Rows that repeat an id are one document with several texts.
Text of any length is taken whole. Other columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import stars
from tidemark.llm.components import components, with_rivals
from tidemark.llm.words import SPACED, chunks, mixed, shingle_hashes
from tidemark.sources.lake import Scratch, scratch, staged

K = 64
#: Chance of losing a linked pair that each of the two steps on sketches may take.
MISS = 1e-9
_MIX = np.random.default_rng(7).integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of the batch."""
    for chunk in chunks(texts, SPACED, lower=True):
        hashes = chunk.hashes()
        for i in range(chunk.rows):
            yield chunk.first_row + i, np.unique(shingle_hashes(hashes[chunk.bounds[i] : chunk.bounds[i + 1]], size))


# Keys of the inverted lists

def run_length(percent: int) -> int:
    """Values of a run: at most three, and few enough that long unions always have one."""
    return max(1, min(3, -(-percent // (100 - percent)) - 1)) if percent < 100 else 3


def _needed(union: int, percent: int) -> int:
    """Length of the longest run that any linked pair with a union of this size has."""
    common = -(-percent * union // 100)
    return -(-common // (union - common + 1))


@functools.lru_cache(maxsize=None)
def run_lengths(n: int, percent: int) -> tuple[int, ...]:
    """Lengths of runs by which a set of n is found: for each size of a union it may be part of, the one
    that both sets use."""
    most = run_length(percent)
    return tuple(sorted({min(most, _needed(u, percent)) for u in range(n, n * 100 // percent + 1)}))


def missed(k: int, percent: int) -> float:
    """Bound of the chance that the k smallest values of a union have no run of common ones."""
    run, t = run_length(percent), percent / 100
    ends = [1.0] + [0.0] * (run - 1)  # chance of no run so far and i common ones at the end
    for _ in range(k):
        ends = [sum(ends) * (1 - t)] + [x * t for x in ends[:-1]]
    return sum(ends)


def _keys(sketch: np.ndarray, length: int) -> np.ndarray:
    m = len(sketch) - length + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(m, np.uint64)
    for i in range(length):
        total += sketch[i : m + i] * _MIX[i]
    return mixed(total, length)


#: Columns of a set's parity.
PARITY = ["p1", "p2", "p3", "p4"]


def _parity(s: np.ndarray) -> np.ndarray:
    """256 bits of a set: in each, whether an odd number of its values falls there."""
    odd = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _parity_allows(a: str, b: str, n: str, m: str, percent: int):
    """Whether sets of n and m values may link: then only one of them has at most (1 - t) / (1 + t) of both."""
    apart = " + ".join(f"bit_count({a}{c} ^ {b}{c})" for c in PARITY)
    return F.expr(f"{100 + percent}L * ({apart}) <= {100 - percent}L * ({n} + {m})")


def _describe(size: int, k: int):
    def run(batches):
        for batch in batches:
            n, f1, f2, sketches, parity = [], [], [], [], []
            for _, s in _sets(batch.column("text"), size):
                n.append(len(s))
                f1.append(mixed(s, 1).sum(dtype=np.uint64))
                f2.append(mixed(s, 2).sum(dtype=np.uint64))
                sketches.append(s[:k].tobytes())
                parity.append(_parity(mixed(s, 6)))
            parity = np.array(parity, np.int64).reshape(len(n), len(PARITY))
            f1, f2 = (pa.array(np.array(f, np.uint64).view(np.int64)) for f in (f1, f2))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), f1, f2, pa.array(sketches, pa.binary()), *(pa.array(x) for x in parity.T)],
                                             ["doc_id", "n", "f1", "f2", "sketch", *PARITY])

    return run


def _postings(percent: int):
    """(key, doc, n) for each run of retained values of a class."""

    def run(batches):
        for batch in batches:
            keys, docs, sizes = [], [], []
            for doc, n, sketch in zip(*(batch.column(c).to_pylist() for c in ("doc", "n", "sketch")), strict=True):
                s = np.frombuffer(sketch, np.uint64)
                lengths = run_lengths(n, percent) if n <= 1000 else (run_length(percent),)
                own = np.concatenate([_keys(s, x) for x in lengths])
                keys.append(own.view(np.int64)), docs.append(np.full(len(own), doc)), sizes.append(np.full(len(own), n, np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, docs, sizes)], ["key", "doc", "n"])

    return run


def _lists(batches):
    """Sorted postings to (key, doc, n, pivot, pivot_n) of lists of two or more. Only the pivot of the list
    under way is kept from batch to batch."""
    first, alone = None, False
    for batch in batches:
        k, d, n = (batch.column(c).to_numpy() for c in ("key", "doc", "n"))
        if not len(k):
            continue
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        new[0] = first is None or k[0] != first[0]
        at = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
        pivot, pivot_n = (np.where(at < 0, own, x[np.maximum(at, 0)]) for own, x in zip(first[1:] if first else (0, 0), (d, n), strict=True))
        second = np.zeros(len(k), bool)  # members after whose coming the pivot is a member too
        second[1:] = ~new[1:] & new[:-1]
        second[0] = not new[0] and alone
        member = ~new
        out = [np.concatenate([x[member], y[second]]) for x, y in ((k, k), (d, pivot), (n, pivot_n), (pivot, pivot), (pivot_n, pivot_n))]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(out, (np.int64, np.int64, np.int32, np.int64, np.int32), strict=True)],
                                         ["key", "doc", "n", "pivot", "pivot_n"])
        first, alone = (k[-1], pivot[-1], pivot_n[-1]), bool(new[-1])


# Estimates and proofs

@functools.lru_cache(maxsize=None)
def least_common(k: int, percent: int) -> int:
    """Of k values sampled from the union of a linked pair fewer are common with a chance of at most MISS
    (Chernoff's bound, which holds for samples without replacement)."""
    t = percent / 100
    if t >= 1:
        return k
    for x in range(int(t * k), 0, -1):
        p = x / k
        apart = p * math.log(p / t) + (1 - p) * math.log((1 - p) / (1 - t)) if p < t else 0.0
        if math.exp(-k * apart) <= MISS:
            return x
    return 0


def may_link(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int, k: int, percent: int) -> bool:
    """Whether two sets with these sketches can link, from the sketch of their union."""
    union, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    if max(n_a, n_b) <= k:  # the sketches are the sets
        return 100 * int((counts == 2).sum()) >= percent * len(union)
    return int((counts[:k] == 2).sum()) >= least_common(min(k, len(union)), percent)


def _estimate(k: int, percent: int):
    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("a_sketch", "a_n", "b_sketch", "b_n"))
            fits = [may_link(np.frombuffer(x, np.uint64), n, np.frombuffer(y, np.uint64), m, k, percent) for x, n, y, m in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have the similarity."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


#: Numbers of a difference: sizes, whether the pair links, values besides, bits of values lacked and besides.
LACKS, BESIDES = ["l1", "l2", "l3", "l4"], ["e1", "e2", "e3", "e4"]
DIFFERENCE = ["n_a", "n_b", "links", "besides", *LACKS, *BESIDES]


def _bits(values: np.ndarray) -> list[int]:
    """256 bits, of each value that of its highest byte once it is mixed."""
    at = np.zeros(256, np.uint8)
    at[(mixed(values, 5) >> np.uint64(56)).astype(np.int64)] = 1
    return [int(x) for x in np.packbits(at).view("<i8")]


def difference(percent: int):
    """What a member's set says about its pivot's."""

    def judge(s: np.ndarray, pivot: np.ndarray) -> tuple:
        lacks, besides = np.setdiff1d(pivot, s, assume_unique=True), np.setdiff1d(s, pivot, assume_unique=True)
        common = len(s) - len(besides)
        links = 100 * common >= percent * (len(s) + len(pivot) - common)
        return (len(s), len(pivot), int(links), len(besides), *_bits(lacks), *_bits(besides))

    return judge


def _bits_allow(a: str, b: str, percent: int):
    """Whether two members of a star may link. In common they have at most the pivot's values without those
    whose bits one of them lacks, and besides a value for each common bit and those that share a bit."""
    lacked = " + ".join(f"bit_count({a}{c} | {b}{c})" for c in LACKS)
    both = " + ".join(f"bit_count({a}{c} & {b}{c})" for c in BESIDES)
    shared = [f"{x}besides - ({' + '.join(f'bit_count({x}{c})' for c in BESIDES)})" for x in (a, b)]
    common = f"({a}n_b - ({lacked}) + ({both}) + least({shared[0]}, {shared[1]}))"
    return F.expr(f"{100 + percent}L * {common} >= {percent}L * ({a}n_a + {b}n_a)")


def near_duplicates(docs: DataFrame, size: int = 2, percent: int = 80, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id, text)."""
    if missed(k, percent) > MISS:
        raise ValueError(f"sketches of {k} values miss more than {MISS} of the pairs that link at {percent} %")
    with scratch(docs.sparkSession) as scope:
        return scope.keep(_near_duplicates(docs, size, percent, k, scope), "near")


def _near_duplicates(docs: DataFrame, size: int, percent: int, k: int, scope: Scratch) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = staged(docs.mapInArrow(_describe(size, k), f"doc_id long, n long, f1 long, f2 long, sketch binary, {', '.join(f'{c} long' for c in PARITY)}"), "described")
    named = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = staged(named.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("doc"), F.first("sketch").alias("sketch"), *(F.min(c).alias(c) for c in PARITY)), "classes")

    postings = classes.mapInArrow(_postings(percent), "key long, doc long, n int")
    shards = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    postings = postings.repartition(shards, "key").sortWithinPartitions("key", "doc")
    lists = staged(postings.mapInArrow(_lists, "key long, doc long, n int, pivot long, pivot_n int"), "lists")

    def side(name: str) -> DataFrame:
        return classes.select(F.col("doc").alias(name), F.col("n").alias(name + "_n"), F.col("sketch").alias(name + "_sketch"))

    def estimated(pairs: DataFrame) -> DataFrame:
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        return both.mapInArrow(_estimate(k, percent), "a long, b long").distinct()

    def sizes(n: str, m: str):
        return F.expr(f"100L * least({n}, {m}) >= {percent}L * greatest({n}, {m})")

    first = lists.where("doc <> pivot").where(sizes("n", "pivot_n")).select(F.col("doc").alias("a"), F.col("pivot").alias("b")).distinct()
    tested = staged(first, "tested")
    spokes = stars.compared(docs, estimated(tested), lambda texts: _sets(texts, size), difference(percent), DIFFERENCE)
    # Texts that share an id belong together, whatever their sets.
    several = named.select("doc_id", "f1", "f2", "n").distinct().groupBy("doc_id").agg(F.collect_set(F.struct("f1", "f2", "n")).alias("own")).where("size(own) > 1")
    owned = several.select("doc_id", F.explode("own").alias("o")).select("doc_id", "o.*").join(classes, ["f1", "f2", "n"])
    same_id = owned.select(F.col("doc").alias("a"), F.col("doc_id").alias("b")).where("a <> b")
    edges = staged(spokes.where("links = 1").select("a", "b").unionByName(same_id), "edges")
    label = components(edges)

    def labelled(rows: DataFrame, doc: str) -> DataFrame:
        return rows.join(label, rows[doc] == label.node, "left").withColumn("label", F.coalesce("component", doc)).drop("node", "component")

    # Members that were compared with their list's pivot, and the pivot itself: their differences decide.
    hubs = spokes.select(F.col("b").alias("a"), "b", F.col("n_b").alias("n_a"), "n_b").distinct()
    nothing = {"links": F.lit(1), "besides": F.lit(0), **{c: F.lit(0) for c in LACKS + BESIDES}}
    hubs = hubs.withColumns({c: x.cast("long") for c, x in nothing.items()})
    star = labelled(spokes.unionByName(hubs), "a").withColumn("n", F.col("n_a"))
    star_rows = staged(with_rivals(star, "b", percent), "stars")
    star = star_rows.drop("n", "links")
    other = star.select(F.col("b").alias("hub"), *(F.col(c).alias("o_" + c) for c in star.columns if c != "b"))
    near = star.join(other, (F.col("b") == F.col("hub")) & (F.col("n_b") == F.col("o_n_b"))).where("label > o_label").where(sizes("n_a", "o_n_a")).where(_bits_allow("", "o_", percent))
    near = near.select("a", F.col("o_a").alias("other"))

    # Members of another size than their pivot, or too far from it, with any member of the list.
    known = spokes.select(F.col("a").alias("doc"), F.col("b").alias("pivot"), F.col("n_a").alias("n"), F.col("n_b").alias("pivot_n")).distinct()
    apart = lists.where("doc <> pivot").join(known, ["doc", "pivot", "n", "pivot_n"], "left_anti").select("key", "doc", "n")
    asked = staged(apart.select("key").distinct(), "asked")
    marked = labelled(lists.select("key", "doc", "n").join(asked, "key", "left_semi"), "doc")
    marked = marked.join(classes.select("doc", "n", *PARITY), ["doc", "n"])
    left = staged(with_rivals(marked, "key", percent), "left")
    lone = left.join(apart, ["key", "doc", "n"], "left_semi")
    lone = lone.select("key", F.col("doc").alias("a"), F.col("n").alias("m"), F.col("label").alias("own"), *(F.col(c).alias("o_" + c) for c in PARITY))
    pairs = lone.join(left, "key").where("label <> own").where(sizes("n", "m")).where(_parity_allows("", "o_", "n", "m", percent)).select("a", F.col("doc").alias("other"))

    def turned(rows: DataFrame) -> DataFrame:
        return rows.select(F.greatest("a", "other").alias("a"), F.least("a", "other").alias("b")).distinct()

    second = turned(near).unionByName(estimated(staged(turned(pairs).join(tested, ["a", "b"], "left_anti"), "pairs")))
    second = staged(second.join(tested, ["a", "b"], "left_anti"), "second")
    scope.drop(lists, left, star_rows)
    more = stars.proved(docs, second, lambda texts: _sets(texts, size), lambda x, y: linked(x, y, percent))
    if more.take(1):
        label = components(edges.unionByName(more))

    reached = classes.join(label, classes.doc == label.node, "left").select("f1", "f2", "n", F.coalesce("component", "doc").alias("component_id"))
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    found = rows.select("doc_id", "f1", "f2", "n").join(reached, ["f1", "f2", "n"], "left").withColumn("component_id", alone)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
