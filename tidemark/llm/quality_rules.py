"""Quality rules: statistics of every text, two fixed rules, and an isolation forest.

Trees split labelled rows at random values of random statistics; a text that few splits set apart from the
rest has short paths and is anomalous. As the method has it, each tree is grown on ROWS_PER_TREE rows, which it
draws from all labelled rows. The threshold on the score is the one that, over all labelled rows, rejects most
rows labelled bad less COST times the rows labelled good. Where no row is labelled bad or good, no threshold
holds and the fixed rules alone decide.

The forest has a size that does not grow. Its scores of the labelled rows are added up in order, range by range.
Statistics are taken by array operations over whole Arrow batches, each text by itself, without a shuffle.

Null or empty text: no words, so it fails the first rule. Null ids and repeated ids are kept as rows of
their own; of the texts of a labelled id one is learnt from. Labels that are null are left out.
Texts of any length are taken whole. Other columns pass through `filter_quality`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark.llm.words import SPACED, chunks, window_hashes
from tidemark.llm.tables import small_side
from tidemark.sources.lake import scratch, staged

#: Labelled rows from which the trees draw theirs in the driver; of more, only what they draw is sent to it.
LOCAL_ROWS = 20_000
#: Labelled ids that are sent to all executors; more are joined.
BROADCAST_IDS = 500_000
TREES = 100
ROWS_PER_TREE = 256
#: How much worse it is to reject a good row than to keep a bad one.
COST = 10

MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 10, 20, 5

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """STATS of each text of the batch."""
    out = {name: np.zeros(len(texts), np.int64) for name in STATS}
    for c in chunks(texts, SPACED, lower=False):
        rows = slice(c.first_row, c.first_row + c.rows)

        def per_row(flags, c=c):
            sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            return sums[c.offsets[1:]] - sums[c.offsets[:-1]]

        out["n_words"][rows] = np.diff(c.bounds)
        begins = (c.data & 0xC0) != 0x80  # a character's first byte
        out["word_chars"][rows] = per_row(begins & SPACED[c.data])
        out["n_symbols"][rows] = per_row(_SYMBOL[c.data])
        hashes = c.hashes()
        windows = window_hashes(hashes, WINDOW)
        lines = _lines(c)
        for i in range(c.rows):
            first, last = c.bounds[i], c.bounds[i + 1]
            if last - first >= WINDOW + 1:
                out["n_repeat_words"][c.first_row + i] = _repeated(windows[first : last - WINDOW + 1])
            own = lines[i]
            out["n_dup_lines"][c.first_row + i] = len(own) - len(set(own))
    return out


def _repeated(windows: np.ndarray) -> int:
    """Words in windows that occur twice or more."""
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(windows) + WINDOW, np.int64)
    edges[:-WINDOW] += twice
    edges[WINDOW:] -= twice
    return int((np.cumsum(edges) > 0).sum())


def _lines(c) -> list[list[bytes]]:
    """Lines with a word, of each text."""
    raw = c.data.tobytes()
    white = b" \t\n\x0b\x0c\r"
    return [[x for x in raw[a:b].split(b"\n") if x.strip(white)] for a, b in zip(c.offsets[:-1], c.offsets[1:], strict=True)]


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics, none of which grows with a text's length: symbols per character and per word,
    share of repeated words, mean word length."""
    words, chars = np.maximum(stats["n_words"], 1), np.maximum(stats["word_chars"], 1)
    return np.column_stack([stats["n_symbols"] / chars, stats["n_symbols"] / words, stats["n_repeat_words"] / words, stats["word_chars"] / words])


def _usual_depth(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees as arrays: per node the statistic, the value, the children, and the depth at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    usual: float
    threshold: float = np.inf

    @classmethod
    def fit(cls, rows: np.ndarray, trees: int = TREES, per_tree: int = ROWS_PER_TREE, seed: int = 7, draws: list[np.ndarray] | None = None) -> Forest:
        """Each tree draws its rows, or has them given by their places in `draws`."""
        rng = np.random.default_rng(seed)
        size = min(per_tree, len(rows))
        limit = int(np.ceil(np.log2(max(size, 2))))
        width = 2 ** (limit + 1)
        feature = np.full((trees, width), -1)
        value, depth, child = np.zeros((trees, width)), np.zeros((trees, width)), np.zeros((trees, width), int)
        for t in range(trees):
            todo, used = [(0, rng.choice(len(rows), size, replace=False) if draws is None else draws[t], 0)], 1
            while todo:
                node, own, level = todo.pop()
                x = rows[own]
                spread = np.flatnonzero(x.max(0) > x.min(0)) if len(own) > 1 else []
                if level >= limit or not len(spread):
                    depth[t, node] = level + _usual_depth(len(own))
                    continue
                f = rng.choice(spread)
                v = rng.uniform(x[:, f].min(), x[:, f].max())
                feature[t, node], value[t, node], child[t, node] = f, v, used
                left = x[:, f] <= v
                todo += [(used, own[left], level + 1), (used + 1, own[~left], level + 1)]
                used += 2
        return cls(feature, value, child, depth, max(_usual_depth(size), 1e-9))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / usual length): near 1 is anomalous, 0.5 and less is usual."""
        total = np.zeros(len(rows))
        at = np.arange(len(rows))
        for feature, value, child, depth in zip(self.feature, self.value, self.child, self.depth, strict=True):
            node = np.zeros(len(rows), int)
            inner = feature[node] >= 0
            while inner.any():
                live = at[inner]
                own = node[live]
                node[live] = child[own] + (rows[live, feature[own]] > value[own])
                inner[live] = feature[node[live]] >= 0
            total += depth[node]
        return 2.0 ** (-total / len(self.feature) / self.usual)

    def calibrated(self, scores: np.ndarray, bad: np.ndarray, cost: float = COST) -> Forest:
        """With the threshold that rejects most bad rows less cost times the good ones; halfway between
        the last score that it rejects and the next."""
        if not bad.any() or bad.all():
            return self
        order = np.argsort(-scores, kind="stable")
        ranked = scores[order]
        gain = np.cumsum(np.where(bad[order], 1.0, -cost))
        ends = np.flatnonzero(np.append(ranked[1:] != ranked[:-1], True))
        best = ends[np.argmax(gain[ends])]
        if gain[best] <= 0:
            return self
        below = ranked[best + 1] if best + 1 < len(ranked) else ranked[best] - 1e-6
        self.threshold = float((ranked[best] + below) / 2)
        return self


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    n, repeated = stats["n_words"], stats["n_repeat_words"]
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)


def _measure(batches):
    for batch in batches:
        stats = statistics(batch.column("text"))
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **stats})


def _fit(labelled: DataFrame, local: int = LOCAL_ROWS) -> Forest:
    """On labelled statistics (doc_id, quality, STATS): trees that draw from all of them, and the threshold of all."""
    names = list(STATS)
    one = labelled.groupBy("doc_id", "quality").agg(F.min(F.struct(*names)).alias("s"))  # an id may have any number of rows
    labelled = staged(one.select("doc_id", "quality", "s.*"), "labelled")
    n = labelled.count()
    if not n:
        return Forest(*(np.full((1, 1), -1), np.zeros((1, 1)), np.zeros((1, 1), int), np.zeros((1, 1))), usual=1.0)
    if n <= local:
        rows = labelled.orderBy(F.xxhash64("doc_id"), "doc_id", *names).toPandas()
        forest = Forest.fit(features({c: rows[c].to_numpy() for c in names}))
    else:
        rows = _drawn(labelled, n)
        tree = rows["tree"].to_numpy()
        forest = Forest.fit(features({c: rows[c].to_numpy() for c in names}), draws=[np.flatnonzero(tree == t) for t in range(TREES)])
    forest.threshold = _threshold(labelled, forest)
    return forest


def _drawn(labelled: DataFrame, n: int):
    """(tree, STATS): ROWS_PER_TREE of the n rows for each tree, those with the smallest hashes of id and tree. A
    bound on the hash lets about twice as many through, whatever n is."""
    h = F.pmod(F.xxhash64("doc_id", "tree"), F.lit(1 << 31))
    every = labelled.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))).withColumn("h", h)
    under = every.where(F.col("h") < F.lit((1 << 31) * 2 * ROWS_PER_TREE // n))
    return under.orderBy("tree", "h", "doc_id", *STATS).select("tree", *STATS).toPandas().groupby("tree").head(ROWS_PER_TREE)


def _threshold(labelled: DataFrame, forest: Forest, cost: float = COST) -> float:
    """`Forest.calibrated` over all rows, wherever they are: scores are dealt in descending ranges, each task sums
    the gains of its own, and the driver puts one row of each range together."""
    shared = labelled.sparkSession.sparkContext.broadcast(forest)

    def score(batches):
        for batch in batches:
            stats = {c: batch.column(c).to_numpy() for c in STATS}
            left = ~base_failed(stats)  # what the fixed rules leave is what the threshold decides on
            if left.any():
                scores = shared.value.scores(features({c: x[left] for c, x in stats.items()}))
                yield pa.RecordBatch.from_pydict({"score": scores, "bad": (batch.column("quality").to_numpy()[left] == 0).astype(np.int64)})

    def summed(batches):
        first, last, total, bad, rows, best = None, None, 0.0, 0, 0, None
        for batch in batches:
            own, b, n = (batch.column(c).to_numpy() for c in ("score", "bad", "n"))
            if not len(own):
                continue
            if best is not None and best[2] is None:
                best = (best[0], best[1], own[0])
            gain = total + np.cumsum(b - cost * (n - b))
            i = int(np.argmax(gain))
            if best is None or gain[i] > best[0]:
                best = (gain[i], own[i], own[i + 1] if i + 1 < len(own) else None)
            first, last, total, bad, rows = own[0] if first is None else first, own[-1], gain[-1], bad + b.sum(), rows + n.sum()
        if best is not None:
            values = (first, last, total, bad, rows, *best)
            yield pa.RecordBatch.from_pydict({k: [None if v is None else t(v)] for (k, t), v in zip(_RANGE.items(), values, strict=True)}, schema=_RANGE_ROW)

    scored = labelled.mapInArrow(score, "score double, bad long")
    each = scored.groupBy("score").agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
    ordered = each.repartitionByRange(F.desc("score")).sortWithinPartitions(F.desc("score"))
    ranges = sorted(ordered.mapInArrow(summed, "first double, last double, total double, bad long, n long, gain double, at double, next double").collect(), key=lambda r: -r.first)
    bad, rows = sum(r.bad for r in ranges), sum(r.n for r in ranges)
    if not bad or bad == rows:
        return np.inf
    before, best, threshold = 0.0, 0.0, np.inf
    for r, after in zip(ranges, [*ranges[1:], None], strict=True):
        if before + r.gain > best:
            best = before + r.gain
            below = r.next if r.next is not None else after.first if after is not None else r.at - 1e-6
            threshold = float((r.at + below) / 2)
        before += r.total
    return threshold


_RANGE = {"first": float, "last": float, "total": float, "bad": int, "n": int, "gain": float, "at": float, "next": float}
_RANGE_ROW = pa.schema([(k, pa.int64() if t is int else pa.float64()) for k, t in _RANGE.items()])


def _judge(stats: dict[str, np.ndarray], forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    failed = base_failed(stats)
    scores = forest.scores(features(stats)) if len(failed) else np.zeros(0)
    return failed, scores, ~failed & (scores <= forest.threshold)


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, STATS) of every row of docs."""
    kinds = ", ".join(f"{n} long" for n in STATS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_measure, f"doc_id long, {kinds}")


def known_quality(labels: DataFrame) -> DataFrame:
    """(doc_id, quality), one row per id; of differing labels the worse one."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("quality"))


def train(measured: DataFrame, labels: DataFrame) -> Forest:
    """Forest and threshold from the measured rows that `labels` (doc_id, quality) covers."""
    return _fit(measured.join(known_quality(labels), "doc_id"))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, STATS, base_failed, kept, score of every row of docs (doc_id, text)."""
    measured = staged(measure(docs), "measured")
    forest = docs.sparkSession.sparkContext.broadcast(train(measured, labels))

    def judge(batches):
        for batch in batches:
            stats = {n: batch.column(n).to_numpy() for n in STATS}
            failed, scores, kept = _judge(stats, forest.value)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **{n: stats[n] for n in STATS},
                                              "base_failed": failed, "kept": kept, "score": scores})

    kinds = ", ".join(f"{n} long" for n in STATS)
    return measured.mapInArrow(judge, f"doc_id long, {kinds}, base_failed boolean, kept boolean, score double")


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with all their columns. Texts are measured as they are judged; before
    that only those with a label are."""
    with scratch(docs.sparkSession):
        covered = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().join(known_quality(labels), "doc_id"), "covered")
        some = docs.withColumn("doc_id", F.col("doc_id").cast("long")).join(small_side(covered.select("doc_id"), covered.count(), BROADCAST_IDS), "doc_id", "left_semi")
        forest = docs.sparkSession.sparkContext.broadcast(_fit(measure(some).join(covered, "doc_id")))

    def keep(batches):
        for batch in batches:
            _, _, kept = _judge(statistics(batch.column("text")), forest.value)
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(keep, docs.schema)
