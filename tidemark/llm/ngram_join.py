"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Two texts link when the Jaccard similarity of their sets of word shingles reaches a threshold. For a
set of n shingles a partner must hold at least T = ceil(threshold * n) of them. DivideSkip sets the
T - 1 longest inverted lists of the query aside: a partner must then occur in at least one of the
other, short lists. The short lists are merged, and what is found there is probed in the long ones by
binary search until T is reached or out of reach.

* One order of shingles for all documents tells long lists from short: by the counter a shingle falls
  in, then by hash. The counters are a fixed number, summed over all documents, so their broadcast
  does not grow; what they confuse costs time and never a result.
* Postings of short lists are dealt out by shingle and sorted, which merges the lists of all queries
  at once. The merge streams. Most lists have a few members: all their pairs are written and the list is
  done with. The first member of a longer list is its pivot, and each other member is paired with it, so a
  list of any length takes no memory and gives a few times as many pairs as members at most.
* Every set has a 256-bit signature, which bounds from below how many members two sets differ in, and a
  wide one of a bit or two per member, as 256 bits say nothing of large sets. A pair that a bound rules out
  is not probed; none that links is ruled out.
* Members are compared with the pivots of their lists first; pairs that reach T make components. Only
  pairs of one longer list in *different* components can still join anything, so only members that have such a
  partner of a fitting size are looked at next: near copies by the thousand are never paired with each
  other, and no link between components is lost.
* Tables written on the way are removed when nothing reads them any more.
* Documents with equal sets are one class. Copies are dropped where they meet, before any shuffle of
  postings, and come back with their class.

Nulls and texts without a word: an empty set, linked with nothing. A null id can't be linked to:
its component is null. Rows that repeat an id are one document with several texts. Text of any length
is taken whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, with_rivals
from tidemark.llm.stars import proved
from tidemark.llm.words import SPACED, chunks, mixed, shingle_hashes
from tidemark.sources.lake import Scratch, scratch, staged

COUNTERS = 1 << 18
#: Columns of a set's signature.
SIGN = ["s1", "s2", "s3", "s4"]
SLICES = 64
#: Members of a list whose pairs are all looked at when it is merged. Longer lists go by their pivots.
SMALL = 8
#: Turns of other pivots at most. What they leave is compared pair by pair.
MAX_TURNS = 1
#: Orders of documents by which lists choose their pivots, a power of two: with one order for all lists a
#: document is compared with few pivots, and with several a pivot that does not link leaves others.
PIVOTS = 4


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of the batch."""
    for chunk in chunks(texts, SPACED, lower=True):
        hashes = chunk.hashes()
        for i in range(chunk.rows):
            words = hashes[chunk.bounds[i] : chunk.bounds[i + 1]]
            yield chunk.first_row + i, np.unique(shingle_hashes(words, size))


def _finger(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, from sums over its mixed members."""
    both = (mixed(s, 1).sum(dtype=np.uint64), mixed(s, 2).sum(dtype=np.uint64))
    return tuple(int(x) for x in np.array(both, np.uint64).view(np.int64))


def _sign(s: np.ndarray) -> np.ndarray:
    """256 bits of a set: in each, whether an odd number of its members falls there."""
    odd = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _wide(s: np.ndarray) -> np.ndarray:
    """The same by the lowest bits of the members, in as many bits as there are members or up to twice that."""
    width = max(1 << (len(s) - 1).bit_length(), 64) if len(s) else 64
    odd = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _wide_allow(percent: int):
    """The bound of `_signs_allow` by wide signatures (a_wide, b_wide): the longer one is folded onto the other."""
    fold = "zip_with(slice({0}, 1, size({1})), slice({0}, size({1}) + 1, size({1})), (p, q) -> p ^ q)"
    meet = "aggregate(zip_with({0}, {1}, (p, q) -> bit_count(p ^ q)), 0, (s, x) -> s + x)"
    a, b = "a_wide", "b_wide"
    apart = (f"CASE WHEN size({a}) = size({b}) THEN {meet.format(a, b)} WHEN size({a}) = 2 * size({b}) THEN {meet.format(fold.format(a, b), b)}"
             f" WHEN size({b}) = 2 * size({a}) THEN {meet.format(a, fold.format(b, a))} ELSE 0 END")
    return F.expr(f"{100 + percent}L * ({apart}) <= {100 - percent}L * (a_n + b_n)")


def _signs_allow(a: str, b: str, percent: int):
    """Whether sets with these signatures may reach the threshold. Every bit that differs is a member
    that only one of them has, and a pair that links has at most (1 - t) / (1 + t) of both sizes of those."""
    apart = " + ".join(f"bit_count({a}{c} ^ {b}{c})" for c in SIGN)
    return F.expr(f"coalesce({100 + percent}L * ({apart}) <= {100 - percent}L * ({a}n + {b}n), true)")


def _describe(size: int):
    """One row for each document (its set's size and fingerprint), and one for each slice of the
    partition's counters."""

    names = ["doc_id", "n", "f1", "f2", *SIGN, "wide", "slice", "counts"]

    def run(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            n, f1, f2, signs, wide = [], [], [], [], []
            for _, s in _sets(batch.column("text"), size):
                counts += np.bincount(s & np.uint64(COUNTERS - 1), minlength=COUNTERS) if len(s) > COUNTERS // 8 else 0
                if len(s) <= COUNTERS // 8:
                    np.add.at(counts, (s & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
                a, b = _finger(s)
                n.append(len(s)), f1.append(a), f2.append(b), signs.append(_sign(s)), wide.append(_wide(s))
            m = len(n)
            signs = np.array(signs, np.int64).reshape(m, len(SIGN))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                 pa.array(f2, pa.int64()), *(pa.array(x) for x in signs.T), pa.array(wide, pa.list_(pa.int64())), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        width = COUNTERS // SLICES
        parts = [counts[i * width : (i + 1) * width].astype("<u4").tobytes() for i in range(SLICES)]
        null = pa.nulls(SLICES, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [null, null, null, null, *(null for _ in SIGN), pa.nulls(SLICES, pa.list_(pa.int64())), pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names)

    return run


_DESCRIBED = f"doc_id long, n long, f1 long, f2 long, {', '.join(f'{c} long' for c in SIGN)}, wide array<long>, slice int, counts binary"


def _add_slices(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTERS // SLICES, np.int64)
    for batch in batches:
        for part in batch.column("counts"):
            total += np.frombuffer(part.as_py(), "<u4")
    yield pa.RecordBatch.from_pydict({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": [total.astype("<i8").tobytes()]})


def _counters(described: DataFrame) -> np.ndarray:
    """Sum of all partitions' counters: COUNTERS numbers, whatever the input."""
    parts = described.where("slice IS NOT NULL").select("slice", "counts")
    summed = parts.groupBy("slice").applyInArrow(_add_slices, "slice int, counts binary")
    total = np.zeros(COUNTERS, np.int64)
    width = COUNTERS // SLICES
    for row in summed.collect():
        total[row.slice * width : (row.slice + 1) * width] = np.frombuffer(row.counts, "<i8")
    return total


def _ordered(s: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set with its shortest lists first, by the one order of all documents."""
    return s[np.lexsort((s, counts[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]))]


def _required(n: int, percent: int) -> int:
    """Members of a set of n that any partner must hold."""
    return -(-percent * n // 100)


def _postings(size: int, percent: int, shared):
    """(shingle, doc_id, n, pos) of the short lists. Of equal sets of the partition one is enough."""

    def run(batches):
        counts, seen = shared.value, set()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out: list[list[np.ndarray]] = [[], [], [], []]
            held = 0
            for row, s in _sets(batch.column("text"), size):
                if not len(s) or ids[row] is None or (f := _finger(s)) in seen:
                    continue
                seen.add(f)
                short = len(s) - _required(len(s), percent) + 1
                head = _ordered(s, counts)[:short]
                for column, x in zip(out, (head.view(np.int64), np.full(short, ids[row], np.int64),
                                           np.full(short, len(s), np.int32), np.arange(short, dtype=np.int32)), strict=True):
                    column.append(x)
                held += short
                if held > 200_000:
                    yield _record(out, ["shingle", "doc_id", "n", "pos"])
                    out, held = [[], [], [], []], 0
            if held:
                yield _record(out, ["shingle", "doc_id", "n", "pos"])

    return run


def _record(columns, names):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names)


def _merged(percent: int):
    """Sorted postings to (shingle, doc_id, n, pos, pivot, pivot_n, pivot_pos). Of a list of up to SMALL
    members come all pairs that may link, without the shingle: the list is done with. Of a longer one come
    all members, each with the list's pivot. Kept from batch to batch: the first members of the list under
    way while they are few, then its pivot."""
    names = ["shingle", "doc_id", "n", "pos", "pivot", "pivot_n", "pivot_pos"]

    def run(batches):
        held, pivot = None, None
        for batch in batches:
            own = tuple(batch.column(c).to_numpy() for c in names[:4])
            if not len(own[0]):
                continue
            rows = own if held is None else tuple(np.concatenate(x) for x in zip(held, own, strict=True))
            k = rows[0]
            begins = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            lengths = np.diff(np.append(begins, len(k)))
            carried = pivot is not None and k[0] == pivot[0]
            long = lengths > SMALL
            long[0] |= carried
            held = None
            if not long[-1]:  # its other members may be in the next batch
                held = tuple(x[begins[-1] :] for x in rows)
                begins, lengths, long = begins[:-1], lengths[:-1], long[:-1]
            yield from _small_pairs(rows, begins[~long], lengths[~long], percent, names)
            at, many = begins[long], lengths[long]
            if len(at):
                first = [x[at] for x in rows]
                if carried:
                    for x, value in zip(first, pivot, strict=True):
                        x[0] = value
                take = np.repeat(at - np.cumsum(many) + many, many) + np.arange(many.sum())
                yield _columns([*(x[take] for x in rows), *(np.repeat(x, many) for x in first[1:])], names)
                pivot = tuple(x[-1] for x in first) if held is None else None
            else:
                pivot = None
        if held is not None:
            one = np.array([0])
            yield from _small_pairs(held, one, np.array([len(held[0])]), percent, names)

    return run


def _small_pairs(rows, begins: np.ndarray, lengths: np.ndarray, percent: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """All pairs of each list that may link, for lists of few members."""
    _, d, n, p = rows
    x, y = [], []
    for apart in range(1, SMALL):
        for place in range(SMALL - apart):
            at = begins[lengths > place + apart] + place
            x.append(at + apart), y.append(at)
    x, y = np.concatenate(x), np.concatenate(y)
    n1, n2 = n[x].astype(np.int64), n[y].astype(np.int64)
    need = -(-percent * (n1 + n2) // (100 + percent))
    may = (d[x] != d[y]) & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & (np.minimum(n1 - p[x], n2 - p[y]) >= need)
    x, y = x[may], y[may]
    if len(x):
        yield _columns([None, d[x], n[x], p[x], d[y], n[y], p[y]], names)


def _columns(columns, names):
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
    m = len(columns[1])
    return pa.RecordBatch.from_arrays([pa.nulls(m, t) if x is None else pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)


def _can_link(n1: str, p1: str, n2: str, p2: str, percent: int):
    """Sizes near enough, and enough members left from the first common shingle on. Where an earlier
    one is common too, the pair is found there with a bound that holds."""
    need = f"ceil({percent} * ({n1} + {n2}) / {100 + percent}D - 1e-9)"
    return F.expr(f"100L * least({n1}, {n2}) >= {percent}L * greatest({n1}, {n2})"
                  f" AND 1 + least({n1} - {p1}, {n2} - {p2}) - 1 >= {need}")


def _ordered_sets(size: int, shared):
    """(row, set with its shortest lists first) of each text."""

    def run(texts: pa.Array):
        for row, s in _sets(texts, size):
            yield row, _ordered(s, shared.value)

    return run


def reaches(query: np.ndarray, lists: np.ndarray, need: int) -> bool:
    """Whether at least `need` members of the query (shortest lists first) are among the sorted
    members: the short lists are counted first, the long ones probed by binary search in blocks, until
    the count is reached or out of reach."""
    hits, done, n = 0, 0, len(query)
    step = max(n - need + 1, 32)
    while done < n and hits < need <= hits + n - done:
        part = query[done : done + step]
        at = np.searchsorted(lists, part)
        hits += int((lists[np.minimum(at, len(lists) - 1)] == part).sum())
        done += len(part)
    return hits >= need


def _links(percent: int):
    def test(query: np.ndarray, other: np.ndarray) -> bool:
        need = -(-percent * (len(query) + len(other)) // (100 + percent))
        return reaches(query, np.sort(other), need)

    return test


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text)."""
    with scratch(docs.sparkSession) as scope:
        return scope.keep(_components(docs, size, percent, scope), "near")


def _components(docs: DataFrame, size: int, percent: int, scope: Scratch) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = staged(docs.mapInArrow(_describe(size), _DESCRIBED), "described")
    rows = described.where("slice IS NULL").select("doc_id", "n", "f1", "f2", *SIGN)
    shared = spark.sparkContext.broadcast(_counters(described))

    named = rows.where("n > 0 AND doc_id IS NOT NULL")
    heads = named.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"))
    reps = staged(named.join(heads, ["f1", "f2"]).select("doc_id", "n", "rep", *SIGN).distinct(), "classes")

    posted = docs.mapInArrow(_postings(size, percent, shared), "shingle long, doc_id long, n int, pos int")
    shards = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lists = posted.repartition(shards, "shingle").sortWithinPartitions("shingle", F.xxhash64(F.col("shingle").bitwiseAND(PIVOTS - 1), "doc_id"), "doc_id")
    kept = "shingle long, doc_id long, n int, pos int, pivot long, pivot_n int, pivot_pos int"
    merged = staged(lists.mapInArrow(_merged(percent), kept), "lists")

    def by_class(pairs: DataFrame) -> DataFrame:
        """Pairs of documents (x, y) to pairs of class representatives (a, b), each once."""
        a = reps.select(F.col("doc_id").alias("x"), F.col("rep").alias("a"), *(F.col(c).alias("a_" + c) for c in ("n", *SIGN)))
        b = reps.select(F.col("doc_id").alias("y"), F.col("rep").alias("b"), *(F.col(c).alias("b_" + c) for c in ("n", *SIGN)))
        both = pairs.distinct().join(a, "x").join(b, "y").where("a <> b").where(_signs_allow("a_", "b_", percent))
        return both.select("a", "b").distinct()

    def turned(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def bounded(pairs: DataFrame) -> DataFrame:
        """Without the pairs that wide signatures rule out. Of an id with several sets any may allow a pair."""
        wide = described.where("n > 0")
        a, b = (wide.select(F.col("doc_id").alias(x), F.col("n").alias(x + "_n"), F.col("wide").alias(x + "_wide")) for x in "ab")
        return pairs.join(a, "a").join(b, "b").where(_wide_allow(percent)).select("a", "b")

    first = merged.where("doc_id <> pivot").where(_can_link("n", "pos", "pivot_n", "pivot_pos", percent))
    first = by_class(first.select(F.col("doc_id").alias("x"), F.col("pivot").alias("y")))
    first = staged(turned(first), "pairs")

    def verified(pairs: DataFrame) -> DataFrame:
        return proved(docs, bounded(pairs), _ordered_sets(size, shared), _links(percent))

    # Texts that share an id belong together, whatever their sets.
    several = reps.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("m")).where("b <> m").select("doc_id", "b")
    same_id = reps.join(several, "doc_id").select(F.col("rep").alias("a"), "b")
    edges, tested = staged(verified(first).unionByName(same_id), "links"), first
    label = staged(components(edges), "labels")

    # What is left: members of one long list in different components. Other pivots first, while all pairs of
    # them would be many more than the members.
    lists = merged.where("shingle IS NOT NULL")
    for turn in range(MAX_TURNS + 1):
        of = reps.join(label, reps.rep == label.node, "left").groupBy("doc_id").agg(
            F.min(F.coalesce("component", "rep")).alias("label"), *(F.expr(f"if(min(rep) = max(rep), min({c}), NULL)").alias(c) for c in SIGN))
        marked = lists.select("shingle", "doc_id", "n", "pos").join(of, "doc_id")
        last, lists = merged, staged(with_rivals(marked, "shingle", percent), "lists")
        scope.drop(last)
        merged = lists
        held = lists.groupBy("shingle", "label").agg(F.count("*").alias("c")).groupBy("shingle").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("s"))
        members, all_pairs = held.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.sum(F.expr("(m * m - s) / 2")), F.lit(0))).first()
        if all_pairs <= 2 * members or turn == MAX_TURNS:
            break
        pivots = lists.groupBy("shingle").agg(F.min_by(F.struct("doc_id", "n", "pos", "label"), F.xxhash64(F.lit(turn), "shingle", "doc_id")).alias("p"))
        near = lists.join(pivots, "shingle").where("label <> p.label").where(_can_link("n", "pos", "p.n", "p.pos", percent))
        near = turned(by_class(near.select(F.col("doc_id").alias("x"), F.col("p.doc_id").alias("y"))))
        near = staged(near.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(near)
        edges = edges.unionByName(verified(near))
        label = staged(components(edges), "labels")

    aside = lists.select("shingle", F.col("doc_id").alias("x"), F.col("n").alias("xn"), F.col("pos").alias("xp"), F.col("label").alias("xl"), *(F.col(c).alias("x" + c) for c in SIGN))
    pairs = aside.join(lists, "shingle").where("label < xl").where(_can_link("n", "pos", "xn", "xp", percent)).where(_signs_allow("", "x", percent))
    second = turned(by_class(pairs.select("x", F.col("doc_id").alias("y"))))
    second = staged(second.join(tested, ["a", "b"], "left_anti"), "pairs")
    scope.drop(lists)
    more = verified(second)
    final = components(edges.unionByName(more)) if more.take(1) else label

    found = reps.join(final, reps.rep == final.node, "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    return rows.join(found, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
