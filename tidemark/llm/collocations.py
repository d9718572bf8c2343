"""Phrase collocations from weighted acyclic automata of n-gram counts.

A path of an automaton is a language and up to three words; the weight at its end is how often that
phrase occurs (of the path without words: the number of words of the language).

* Shards: a task counts the n-grams of a bounded piece of its texts and builds their automata from the
  sorted n-grams. States after two words that have the same arcs and weights are one state, which in
  a shard most are.
* Union: n-grams go by prefix (language and first two words) into ranges of the prefix's hash, so no
  word and no language fills a range, an automaton holds a shard's n-grams of one range, and a phrase of
  three words is beside its first part. A task takes the automata of a range one after the other and sums the weights of
  equal paths; what it holds is bounded by the distinct n-grams of the range. Ranges grow in number with the
  texts; beyond FAN of them, automata of FAN wide ranges are put together first and then cut into the narrow ones,
  so that automata do not become many and small.
* Lookups: of a phrase found `least` times every part is found as often, so only such paths are kept.
  First parts of two words are looked up in the range itself, other parts are composed with the paths of
  other ranges in a join.

Scores are exact: products are decimals of 38 digits, enough for counts up to 10^15.

Nulls: a null text is empty, a null language is `und`. Texts without a word, empty and repeated rows count
as what they hold. Texts of any length are taken whole, other columns ignored, ids not used. An empty table
gives no row. Words of a shard are told apart by 64-bit hashes, those of different shards by themselves.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import small_side
from tidemark.llm.words import Chunk, chunks, mixed
from tidemark.sources.lake import Scratch, scratch, staged

LEAST = 10
TOP = 2000
#: Text that a task counts at a time, and text for each range.
SHARD_BYTES, RANGE_BYTES = 8 << 20, 4 << 20
#: n-grams held besides those already summed.
PENDING = 1 << 20
#: Ranges that a shard is cut into. More than that are reached in two steps.
FAN = 2048
BROADCAST_WORDS = 100_000
SALTS = 32

BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
#: Bytes of words `[^\x20\x09]+` of pieces.
WORD_BYTES = ~BREAKS
WORD_BYTES[[0x20, 0x09]] = False

_MIX = np.random.default_rng(11).integers(1, 1 << 63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KINDS = [np.uint8, np.uint16, np.uint32, np.uint64]


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where values of a sorted array change."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)


@dataclass
class Grams:
    """n-grams in the order of their paths: language, words (0: none, else 1 + place in `words`), weight."""

    langs: list[str]
    words: pa.Array
    lang: np.ndarray
    w: tuple[np.ndarray, np.ndarray, np.ndarray]
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.weight)

    def prefix(self) -> np.ndarray:
        """A number for language and two words, in their order."""
        v = len(self.words) + 1
        return (self.lang * v + self.w[0]) * v + self.w[1]

    def take(self, rows) -> Grams:
        return Grams(self.langs, self.words, self.lang[rows], tuple(x[rows] for x in self.w), self.weight[rows])

    def summed(self) -> Grams:
        """Sorted, with the weights of equal paths added."""
        _, group = np.unique(self.prefix(), return_inverse=True)
        code = group * (len(self.words) + 1) + self.w[2]
        order = np.argsort(code, kind="stable")
        at = _firsts(code[order])
        found = self.take(order[at])
        found.weight = np.add.reduceat(self.weight[order], at) if len(at) else self.weight[:0]
        return found


def merged(parts: list[Grams]) -> Grams:
    """One set of n-grams over the languages and words of all."""
    langs = sorted({x for p in parts for x in p.langs})
    number = {x: i for i, x in enumerate(langs)}
    words = pa.concat_arrays([p.words for p in parts]).dictionary_encode()
    codes = np.concatenate([[0], words.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1])
    lang, w, at = [], ([], [], []), 0
    for p in parts:
        own = np.concatenate([[0], codes[at + 1 : at + 1 + len(p.words)]])
        lang.append(np.array([number[x] for x in p.langs], np.int64)[p.lang] if len(p) else p.lang)
        for out, x in zip(w, p.w, strict=True):
            out.append(own[x])
        at += len(p.words)
    return Grams(langs, words.dictionary, np.concatenate(lang), tuple(np.concatenate(x) for x in w), np.concatenate([p.weight for p in parts]))


# Automata

def _packed(x: np.ndarray) -> bytes:
    kind = next(k for k in range(4) if not len(x) or int(x.max()) <= np.iinfo(_KINDS[k]).max)
    return struct.pack("<BQ", kind, len(x)) + x.astype(_KINDS[kind]).tobytes()


def _unpacked(data: bytes, at: int) -> tuple[np.ndarray, int]:
    kind, n = struct.unpack_from("<BQ", data, at)
    size = np.dtype(_KINDS[kind]).itemsize * n
    return np.frombuffer(data, _KINDS[kind], n, at + 9).astype(np.int64), at + 9 + size


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(length of each word, all their bytes)."""
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    return np.diff(offsets), np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)


def build(grams: Grams) -> bytes:
    """The automaton of sorted, summed n-grams. Its arcs over language and two words are rows with a weight
    and the state they lead to; the arcs of a state are a third word and a weight. Each distinct state is
    registered once; state 0 has no arcs."""
    there = np.zeros(len(grams.words) + 1, bool)
    for w in grams.w:
        there[w] = True
    used = np.flatnonzero(there[1:])
    number = np.zeros(len(grams.words) + 1, np.int64)
    number[used + 1] = np.arange(1, len(used) + 1)
    sizes, text = _bytes(grams.words.take(pa.array(used)))
    prefix = grams.prefix()
    rows = _firsts(prefix)
    third = grams.w[2] > 0
    arcs = np.flatnonzero(third)
    owner = np.searchsorted(prefix[rows], prefix[arcs])  # row of each arc
    n_arcs = np.bincount(owner, minlength=len(rows))
    starts = np.concatenate([[0], np.cumsum(n_arcs)])
    word, weight = number[grams.w[2][arcs]], grams.weight[arcs]
    # Arcs of a row as one number; rows that agree in it are compared arc by arc.
    own = mixed(word.astype(np.uint64) * _MIX[0] + weight.astype(np.uint64) * _MIX[1], 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own, dtype=np.uint64)])
    print_ = mixed(sums[starts[1:]] - sums[starts[:-1]] + n_arcs.astype(np.uint64) * _MIX[2], 2)
    _, first, same = np.unique(print_, return_index=True, return_inverse=True)
    twin = first[same]
    fits = n_arcs[twin] == n_arcs
    inner = np.arange(len(arcs)) - np.repeat(starts[:-1], n_arcs)
    other = np.minimum(np.repeat(starts[twin], n_arcs) + inner, max(len(arcs) - 1, 0))
    differ = np.bincount(owner, weights=(word[other] != word) | (weight[other] != weight), minlength=len(rows)) > 0
    twin = np.where(fits & ~differ, twin, np.arange(len(rows)))
    registered = np.flatnonzero((twin == np.arange(len(rows))) & (n_arcs > 0))
    state = np.zeros(len(rows), np.int64)
    state[registered] = np.arange(1, len(registered) + 1)
    state = np.where(n_arcs > 0, state[twin], 0)
    kept = np.isin(owner, registered) if len(arcs) else np.empty(0, bool)
    # A row's own weight; a row that is only passed through has none.
    ends = np.where(third[rows], 0, grams.weight[rows])
    arrays = [grams.lang[rows], number[grams.w[0][rows]], number[grams.w[1][rows]], ends, state, n_arcs[registered], word[kept], weight[kept],
              sizes, np.array([len(x.encode()) for x in grams.langs], np.int64)]
    return b"".join(_packed(x) for x in arrays) + text.tobytes() + "".join(grams.langs).encode()


def paths(automaton: bytes) -> Grams:
    """All paths of an automaton, sorted."""
    arrays, at = [], 0
    for _ in range(10):
        x, at = _unpacked(automaton, at)
        arrays.append(x)
    lang, w1, w2, ends, state, n_arcs, word, weight, word_sizes, lang_sizes = arrays

    def strings(sizes, at):
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(automaton[at : at + int(offsets[-1])])), at + int(offsets[-1])

    words, at = strings(word_sizes, at)
    langs, _ = strings(lang_sizes, at)
    starts = np.concatenate([[0, 0], np.cumsum(n_arcs)])  # of state i: starts[i] : starts[i + 1]
    count = starts[state + 1] - starts[state]
    row = np.repeat(np.arange(len(lang)), count)
    arc = np.repeat(starts[state], count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    own = np.flatnonzero(ends)
    every = np.concatenate([own, row])
    third = np.concatenate([np.zeros(len(own), np.int64), word[arc]])
    grams = Grams(langs.to_pylist(), words, lang[every], (w1[every], w2[every], third), np.concatenate([ends[own], weight[arc]]))
    return grams.take(np.lexsort((third, every)))


def lookup(automaton: bytes, lang: str, *phrase: str) -> int:
    """Weight of one path, 0 where there is none."""
    grams = paths(automaton)
    words = {x: i + 1 for i, x in enumerate(grams.words.to_pylist())}
    if lang not in grams.langs or any(x not in words for x in phrase):
        return 0
    want = [words[x] for x in phrase] + [0] * (3 - len(phrase))
    at = (grams.lang == grams.langs.index(lang)) & np.logical_and.reduce([x == y for x, y in zip(grams.w, want, strict=True)])
    return int(grams.weight[at].sum())


# Shards

class _Shard:
    """Texts held until they are counted."""

    def __init__(self):
        self.chunks, self.langs, self.size = [], [], 0

    def add(self, chunk, langs: list[str]) -> None:
        self.chunks.append(chunk), self.langs.append(langs)
        self.size += len(chunk.data)

    def count(self) -> Grams:
        hashes = np.concatenate([c.hashes() for c in self.chunks])
        hashes, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
        ids = ids + 1
        data = np.concatenate([c.data for c in self.chunks])
        shift = np.cumsum([0] + [len(c.data) for c in self.chunks])
        starts = np.concatenate([c.starts + x for c, x in zip(self.chunks, shift, strict=False)])[first]
        sizes = np.concatenate([c.ends - c.starts for c in self.chunks])[first]
        ends = np.cumsum(sizes)
        letters = data[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64).tobytes())
        words = pa.LargeStringArray.from_buffers(len(sizes), offsets, pa.py_buffer(letters.tobytes()))
        langs = sorted({x for own in self.langs for x in own})
        number = {x: i for i, x in enumerate(langs)}
        lang, piece, held = [], [], 0
        for chunk, own in zip(self.chunks, self.langs, strict=True):
            row = np.repeat(np.arange(chunk.rows), np.diff(chunk.bounds))
            lang.append(np.array([number[x] for x in own], np.int64)[row])
            breaks = np.concatenate([[0], np.cumsum(BREAKS[chunk.data])])[chunk.starts]
            piece.append(breaks + row + held)  # grows at every break and at every text
            held += int(BREAKS[chunk.data].sum()) + chunk.rows
        lang, piece = np.concatenate(lang), np.concatenate(piece)
        # Distinct n-grams of each length, each from a code of the ones a word shorter.
        v = len(hashes) + 1
        n = np.bincount(lang, minlength=len(langs))
        one, n_one = np.unique(lang * v + ids, return_counts=True)
        two = np.flatnonzero(piece[1:] == piece[:-1])
        pairs, of, n_pairs = np.unique((lang[two] * v + ids[two]) * v + ids[two + 1], return_inverse=True, return_counts=True)
        last = np.flatnonzero(two[1:] == two[:-1] + 1)
        triples, n_triples = np.unique(of[last] * v + ids[two[last] + 2], return_counts=True)
        del piece, lang, ids, of
        # Their places in the order of paths: of each phrase the ones before it, length by length.
        spoken, of = np.flatnonzero(n), triples // v
        before = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(pairs)))])  # triples before each pair
        first, langs_of = pairs // v, pairs // v // v
        at_pair = np.arange(len(pairs)) + before[:-1] + np.searchsorted(one, first, "right") + np.searchsorted(spoken, langs_of, "right")
        at_triple = at_pair[of] + 1 + np.arange(len(triples)) - before[of]
        earlier = np.searchsorted(first, one)
        at_one = np.arange(len(one)) + earlier + before[earlier] + np.searchsorted(spoken, one // v, "right")
        earlier = np.searchsorted(langs_of, spoken)
        at_lang = np.arange(len(spoken)) + np.searchsorted(one // v, spoken) + earlier + before[earlier]
        columns = np.zeros((5, len(spoken) + len(one) + len(pairs) + len(triples)), np.int64)
        for at, *own in ((at_lang, spoken, 0, 0, 0, n[spoken]), (at_one, one // v, one % v, 0, 0, n_one),
                         (at_pair, langs_of, first % v, pairs % v, 0, n_pairs), (at_triple, langs_of[of], first[of] % v, pairs[of] % v, triples % v, n_triples)):
            for column, x in zip(columns, own, strict=True):
                column[at] = x
        return Grams(langs, words, columns[0], tuple(columns[1:4]), columns[4])


def _ranges(grams: Grams, n_ranges: int) -> np.ndarray:
    """Range of each n-gram, by the hash of its prefix."""
    told = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in grams.langs], np.uint64)
    sizes, data = _bytes(grams.words)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    own = np.concatenate([np.zeros(1, np.uint64), Chunk(0, data, offsets, offsets[:-1], offsets[1:], offsets).hashes()])
    prefix = mixed(told[grams.lang] + own[grams.w[0]] * _MIX[0] + own[grams.w[1]] * _MIX[1], 3)
    return ((prefix >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.uint16 if n_ranges <= 1 << 16 else np.int64)


def _automata(grams: Grams, n_ranges: int):
    """An automaton for each range that the n-grams fall into."""
    where = _ranges(grams, n_ranges)
    order = np.argsort(where, kind="stable")
    edges = np.searchsorted(where[order], np.arange(n_ranges + 1))
    for i in np.flatnonzero(np.diff(edges)).tolist():
        yield pa.RecordBatch.from_pydict({"range": pa.array([i], pa.int32()), "automaton": pa.array([build(grams.take(order[edges[i] : edges[i + 1]]))], pa.binary())})


def _shards(n_ranges: int, shard_bytes: int):
    def run(batches):
        shard = _Shard()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for chunk in chunks(batch.column("text"), WORD_BYTES, lower=True):
                shard.add(chunk, langs[chunk.first_row : chunk.first_row + chunk.rows])
                if shard.size >= shard_bytes:
                    yield from _automata(shard.count(), n_ranges)
                    shard = _Shard()
        if shard.chunks:
            yield from _automata(shard.count(), n_ranges)

    return run


def _regroup(n_ranges: int):
    """Automata sorted by wide range to automata of narrow ranges, of many shards together."""

    def run(batches):
        pending, held = [], 0
        for batch in batches:
            for data in batch.column("automaton"):
                pending.append(paths(data.as_py()))
                held += len(pending[-1])
                if held > PENDING:
                    yield from _automata(merged(pending).summed(), n_ranges)
                    pending, held = [], 0
        if pending:
            yield from _automata(merged(pending).summed(), n_ranges)

    return run


def _union(least: int):
    """Automata sorted by range to one automaton for each range, without paths below `least`."""

    def run(batches):
        at, total, pending, held = None, None, [], 0

        def fold():
            nonlocal total, pending, held
            if pending:
                total = merged(([total] if total is not None else []) + pending).summed()
            pending, held = [], 0

        def close():
            nonlocal total
            fold()
            grams = total.take(np.flatnonzero((total.weight >= least) | (total.w[0] == 0)))
            total = None
            return pa.RecordBatch.from_pydict({"range": pa.array([at], pa.int32()), "automaton": pa.array([build(grams)], pa.binary())})

        for batch in batches:
            for own, data in zip(batch.column("range").to_pylist(), batch.column("automaton"), strict=True):
                if own != at:
                    if at is not None:
                        yield close()
                    at = own
                pending.append(paths(data.as_py()))
                held += len(pending[-1])
                if held > PENDING:
                    fold()
        if at is not None:
            yield close()

    return run


_ROW = "lang string, k int, w1 string, w2 string, w3 string, f long, first long, above long"


def _rows(batches):
    """Paths as rows (lang, k, w1, w2, w3, f), with f of the first two of three words, and for two words
    the greatest f of three that begin with them."""
    for batch in batches:
        for data in batch.column("automaton"):
            grams = paths(data.as_py())
            w1, w2, w3 = grams.w
            k = (w1 > 0).astype(np.int32) + (w2 > 0) + (w3 > 0)
            prefix = grams.prefix()
            at = _firsts(prefix)
            group = np.cumsum(np.bincount(at, minlength=len(prefix))[: len(prefix)]) - 1
            above = np.maximum.reduceat(np.where(w3 > 0, grams.weight, 0), at) if len(at) else at
            words = pa.concat_arrays([pa.array([None], pa.large_string()), grams.words]).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.langs, pa.string()).take(pa.array(grams.lang)), pa.array(k, pa.int32()), *(words.take(pa.array(x)) for x in grams.w),
                 pa.array(grams.weight), pa.array(np.where(w3[at] == 0, grams.weight[at], 0)[group] if len(at) else at, pa.int64()), pa.array(above[group] if len(at) else at, pa.int64())],
                [c.split()[0] for c in _ROW.split(", ")])


def count_automata(docs: DataFrame, least: int = LEAST, shard_bytes: int = SHARD_BYTES, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """(range, automaton): the paths of all texts that occur `least` times or more, and the number of
    words of each language."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_ranges = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_bytes))
    kinds = "range int, automaton binary"
    made = docs.mapInArrow(_shards(min(n_ranges, fan), shard_bytes), kinds)
    if n_ranges > fan:
        made = made.repartition(fan, "range").sortWithinPartitions("range").mapInArrow(_regroup(n_ranges), kinds)
    return made.repartition(n_ranges, "range").sortWithinPartitions("range").mapInArrow(_union(least), kinds)


def _score(a: str, left: str, right: str):
    big = "CAST({} AS DECIMAL(38,0))".format
    return F.expr(f"CAST({big(1000000)} * {big(a)} * {big(a)} DIV ({big(left)} * {big(right)}) AS LONG)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of two or three words of each language.
    Phrases inside a longer one that has `share` percent of their occurrences are left out."""
    with scratch(docs.sparkSession) as scope:
        return scope.keep(_collocations(docs, least, top, share, scope), "collocations")


def _collocations(docs: DataFrame, least: int, top: int, share: int, scope: Scratch) -> DataFrame:
    automata = staged(count_automata(docs, least), "automata")
    grams = staged(automata.select("automaton").mapInArrow(_rows, _ROW), "paths")
    scope.drop(automata)
    words = grams.where("k = 1")
    words = small_side(words.select("lang", F.col("w1").alias("word"), "f"), words.count(), BROADCAST_WORDS)

    def with_count(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.join(words.select("lang", F.col("word").alias(column), F.col("f").alias(name)), ["lang", column])

    three = grams.where("k = 3").select("lang", "w1", "w2", "w3", F.col("f").alias("a"), F.col("first").alias("l2"))
    two = grams.where("k = 2").select("lang", "w1", "w2", F.col("f").alias("a"), "above")
    ending = three.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("ends"))
    two = two.join(ending, ["lang", "w1", "w2"], "left")
    rest = two.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"))
    three = with_count(with_count(three.join(rest, ["lang", "w2", "w3"]), "w1", "l1"), "w3", "r2")
    three = three.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2")).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.expr("if(s2 < s1, l2, l1)").alias("l"), F.expr("if(s2 < s1, r2, r1)").alias("r"), F.least("s1", "s2").alias("score"))
    two = two.where(100 * F.greatest("above", F.coalesce("ends", F.lit(0))) < share * F.col("a"))
    two = with_count(with_count(two, "w1", "l"), "w2", "r")
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))

    def first(df: DataFrame, *by) -> DataFrame:
        order = Window.partitionBy("lang", *by).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    some = first(three.unionByName(two).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))), "salt")
    sizes = grams.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return first(some.drop("rank", "salt")).join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
