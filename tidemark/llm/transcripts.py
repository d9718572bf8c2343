"""Transcript parsing: who says each line, by a hidden Markov model, and turns in one form.

A state is a role and whether the line begins a turn. A line shows two features: its speaker marker (a
word of a known role, a numbered or lettered speaker, or none) and its shape (length, question mark,
blank before). Transitions and features are counted over all labelled lines, with partial aggregates;
what comes to the driver is a table of states by features, whose size is fixed.

Viterbi over lines is a product of max-plus matrices, so a conversation is cut into segments of about
SEGMENT lines: each segment's matrix is computed by itself, the matrices of a conversation are chained
to find the state every segment is entered and left in, and each segment is decoded between those two.
A conversation that holds a third of all lines is as many segments as any other lines are.

Nulls: a null text is one empty line; a null conversation is one conversation; a null line number comes
last. Lines that repeat a number are in the order of their texts' hashes, equal ones side by side. Very
long lines are one line. An empty table gives no turn. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.lake import staged

ROLES = ("system", "user", "assistant")
SEGMENT = 2_000
LINE_STEP = 1 << 20

#: Speaker words and their roles; fixed values.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "student", "q", "question", "me"),
    "assistant": ("assistant", "ai", "bot", "chatbot", "agent", "model", "a", "answer"),
}
_ROLE_OF = {word: i for i, words in enumerate(MARKERS.values()) for word in words}
_MARKER = re.compile(r"^\s{0,8}[\[<*#]{0,4}\s?(?:(?P<word>[A-Za-z]{1,14})|(?P<name>(?:speaker|person|participant)\s?[0-9A-Za-z]))\s?[\]>*]{0,4}\s?:[ \t*]{0,4}", re.IGNORECASE)

STATES = 2 * len(ROLES)  # role and 0 for a line inside a turn, 1 for its first
N_MARKERS = len(ROLES) + 3  # a role's word, an odd or even speaker, none
N_SHAPES = 4 * 2 * 2


def marker_of(line: str) -> tuple[int, int]:
    """(feature of the line's speaker marker, where the words begin)."""
    m = _MARKER.match(line)
    if m and m["name"]:
        return len(ROLES) + (ord(m["name"][-1].lower()) % 2), m.end()
    if m and m["word"].lower() in _ROLE_OF:
        return _ROLE_OF[m["word"].lower()], m.end()
    return N_MARKERS - 1, 0


def observe(line: str) -> int:
    marker, at = marker_of(line)
    words = line[at:].strip()
    length = 0 if not words else 1 + min(int(np.log2(len(words) + 1) // 3.5), 2)
    return (marker * 4 + length) * 4 + 2 * words.endswith("?") + (line[:1] in " \t>")


OBSERVATIONS = N_MARKERS * N_SHAPES


@dataclass
class Model:
    """Log probabilities: first state, next state, and what a state shows."""

    first: np.ndarray
    step: np.ndarray
    shows: np.ndarray

    def viterbi(self, seen: np.ndarray, entry: int | None, leave: int | None) -> np.ndarray:
        """Likeliest states; `entry` is the state before (None: the conversation begins), `leave` that of
        the last line (None: any)."""
        score = (self.first if entry is None else self.step[entry]) + self.shows[:, seen[0]]
        back = np.zeros((len(seen), STATES), np.int8)
        for i, o in enumerate(seen[1:], 1):
            ways = score[:, None] + self.step
            back[i] = ways.argmax(0)
            score = ways.max(0) + self.shows[:, o]
        states = np.zeros(len(seen), int)
        states[-1] = score.argmax() if leave is None else leave
        for i in range(len(seen) - 1, 0, -1):
            states[i - 1] = back[i, states[i]]
        return states

    def matrix(self, seen: np.ndarray) -> np.ndarray:
        """Best score of the segment's lines from each state before it to each state of its last line."""
        m = self.step + self.shows[:, seen[0]]
        for o in seen[1:]:
            m = (m[:, :, None] + self.step[None]).max(1) + self.shows[:, o]
        return m


def as_transcript(turns: DataFrame) -> DataFrame:
    """(conv_id, line_no, line, role, begins) of (conv_id, turn, role, text): the lines of a transcript
    as people write them, with the truth beside. By a hash of the conversation speakers are words of
    their role, other words for it, numbers, or named in the first line only."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    role = F.lower(F.coalesce("role", F.lit("user")))
    plain = F.concat(F.initcap(role), F.lit(": "))
    other = F.when(role == "system", "[Context]: ").when(role == "assistant", "AI: ").otherwise("Human: ")
    number = F.when(role == "system", "System: ").when(role == "assistant", "Speaker 2: ").otherwise("Speaker 1: ")
    marker = F.when(style == 0, plain).when(style == 1, other).when(style == 2, number).otherwise(F.when(F.col("turn") == 0, plain).otherwise(F.lit("")))
    rows = turns.select("conv_id", "turn", role.alias("role"), marker.alias("marker"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("k", "line"))
    return rows.select("conv_id", (F.col("turn") * LINE_STEP + F.col("k")).alias("line_no"), F.when(F.col("k") == 0, F.concat("marker", "line")).otherwise(F.col("line")).alias("line"),
                       "role", (F.col("k") == 0).alias("begins"))


def _observed(lines: DataFrame) -> DataFrame:
    @F.pandas_udf("int")
    def seen(line: pd.Series) -> pd.Series:
        return line.map(observe).astype("int32")

    return lines.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("line_no").cast("long").alias("line_no"), F.coalesce("line", F.lit("")).alias("line"),
                        *[c for c in ("role", "begins") if c in lines.columns]).withColumn("seen", seen("line"))


def train(lines: DataFrame) -> Model:
    """From labelled lines (conv_id, line_no, line, role, begins). A role that is not known counts as a
    user's. Every count has one more than seen."""
    role = F.coalesce(F.array_position(F.lit(list(ROLES)), F.col("role")).cast("int") - 1, F.lit(-1))
    role = F.when(role < 0, ROLES.index("user")).otherwise(role)
    # The next line is looked up within a stretch of line numbers, so a hot conversation is spread; the
    # few steps from one stretch to the next are not counted.
    coded = _observed(lines).select("conv_id", "line_no", "seen", (role * 2 + F.col("begins").cast("int")).cast("int").alias("state"), F.xxhash64("line").alias("h"))
    coded = staged(coded.withColumn("stretch", F.expr(f"line_no div {64 * LINE_STEP}")), "coded")
    order = Window.partitionBy("conv_id", "stretch").orderBy(F.asc_nulls_last("line_no"), "h")
    pairs = coded.withColumn("next", F.lead("state").over(order)).groupBy("state", "next").agg(F.count("*").alias("n")).collect()
    firsts = coded.groupBy("conv_id").agg(F.min_by("state", F.struct("line_no", "h")).alias("state")).groupBy("state").agg(F.count("*").alias("n")).collect()
    shown = coded.groupBy("state", "seen").agg(F.count("*").alias("n")).collect()
    first, step, shows = np.ones(STATES), np.ones((STATES, STATES)), np.full((STATES, OBSERVATIONS), 0.1)
    for r in firsts:
        if r.state is not None:
            first[r.state] += r.n
    for r in pairs:
        if r.next is not None:
            step[r.state, r.next] += r.n
    for r in shown:
        shows[r.state, r.seen] += r.n
    # Only the first line of a turn changes the role.
    for i in range(STATES):
        for j in range(STATES):
            if j % 2 == 0 and i // 2 != j // 2:
                step[i, j] = 1e-12
        first[i] = first[i] if i % 2 else 1e-12
    logs = lambda x: np.log(x / x.sum(-1, keepdims=True))
    return Model(logs(first), logs(step), logs(shows))


def _segmented(lines: DataFrame) -> DataFrame:
    """With `segment`, an ordered key of about SEGMENT lines: a stretch of line numbers, and where a
    stretch holds more, the number and the stretch of the hash."""
    rows = lines.withColumn("h", F.xxhash64("line")).withColumn("stretch", F.coalesce(F.expr(f"line_no div {64 * LINE_STEP}"), F.lit((1 << 62))))
    counts = rows.groupBy(F.col("conv_id").alias("c"), F.col("stretch").alias("s")).agg(F.count("*").alias("n")).where(f"n > {SEGMENT}")
    rows = rows.join(counts, [F.col("conv_id").eqNullSafe(F.col("c")), F.col("stretch") == F.col("s")], "left")
    bits = F.ceil(F.log2(F.col("n") / SEGMENT)).cast("int")
    # Whole blocks of hashes of one line number, so that order by segment is order by (line_no, h).
    fine = F.when(F.col("n").isNull(), F.lit(0).cast("long")).otherwise(F.coalesce("line_no", F.lit((1 << 62))))
    part = F.when(F.col("n").isNull(), F.lit(0).cast("long")).otherwise(F.floor(F.col("h") / F.pow(F.lit(2.0), F.lit(64) - bits)))
    return rows.withColumn("segment", F.struct("stretch", fine.alias("fine"), part.alias("part"))).drop("c", "s", "n")


def parse_transcripts(lines: DataFrame, model: Model) -> DataFrame:
    """(conv_id, line_no, line, h, role, begins, turn) of lines (conv_id, line_no, line): the recovered
    role, whether a turn begins, and the number of the turn in its conversation."""
    shared = lines.sparkSession.sparkContext.broadcast(model)
    rows = staged(_segmented(_observed(lines.select("conv_id", "line_no", "line"))), "observed")

    def product(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["line_no", "h"], na_position="last")
        seen = own["seen"].to_numpy()
        m = shared.value
        start = m.first + m.shows[:, seen[0]]
        for o in seen[1:]:
            start = (start[:, None] + m.step).max(0) + m.shows[:, o]
        conv, stretch, fine, part = key
        return pd.DataFrame({"conv_id": [conv], "stretch": [stretch], "fine": [fine], "part": [part], "m": [m.matrix(seen).ravel()], "start": [start]})

    keyed = rows.select("conv_id", "segment.*", "line_no", "h", "seen", "line")
    by = ["conv_id", "stretch", "fine", "part"]
    # Few bytes, but work for all tasks: so many partitions are kept.
    spark = lines.sparkSession
    shards = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    narrow = keyed.drop("line").repartition(shards, *by)
    kinds = "conv_id long, stretch long, fine long, part long, m array<double>, start array<double>"
    products = narrow.groupBy("conv_id", "stretch", "fine", "part").applyInPandas(product, kinds)

    def chain(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["stretch", "fine", "part"])
        score, back = None, []
        for m, start in zip(own["m"], own["start"], strict=True):
            if score is None:
                score = np.array(start)
                back.append(None)
            else:
                ways = score[:, None] + np.array(m).reshape(STATES, STATES)
                back.append(ways.argmax(0))
                score = ways.max(0)
        leave, state = [0] * len(back), int(score.argmax())
        entry: list[int] = [-1] * len(back)
        for i in range(len(back) - 1, -1, -1):
            leave[i] = state
            if i:
                state = entry[i] = int(back[i][state])
        return own[["conv_id", "stretch", "fine", "part"]].assign(entry=entry, leave=leave)

    ends = staged(products.repartition(shards, "conv_id").groupBy("conv_id").applyInPandas(chain, "conv_id long, stretch long, fine long, part long, entry int, leave int"), "ends")

    def decode(key: tuple, own: pd.DataFrame, bounds: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame(columns=["conv_id", "stretch", "fine", "part", "line_no", "line", "h", "role", "begins", "turn"])
        own = own.sort_values(["line_no", "h"], na_position="last")
        entry, leave = int(bounds["entry"].iloc[0]), int(bounds["leave"].iloc[0])
        states = shared.value.viterbi(own["seen"].to_numpy(), None if entry < 0 else entry, leave)
        begins = states % 2 == 1
        return own[["conv_id", "stretch", "fine", "part", "line_no", "line", "h"]].assign(role=[ROLES[s // 2] for s in states], begins=begins, turn=np.cumsum(begins))

    decoded = keyed.groupBy(*by).cogroup(ends.groupBy(*by)).applyInPandas(
        decode, "conv_id long, stretch long, fine long, part long, line_no long, line string, h long, role string, begins boolean, turn long")
    decoded = staged(decoded, "decoded")
    # Turns are numbered through the segments of a conversation.
    held = decoded.groupBy(*by).agg(F.max("turn").alias("turns"))
    before = F.coalesce(F.sum("turns").over(Window.partitionBy("conv_id").orderBy("stretch", "fine", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = held.select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"), F.col("fine").alias("f"), F.col("part").alias("p"), before.alias("before"))
    numbered = decoded.join(held, [F.col("conv_id").eqNullSafe(F.col("c")), F.col("stretch") == F.col("s"), F.col("fine") == F.col("f"), F.col("part") == F.col("p")])
    return numbered.select("conv_id", "line_no", "line", "h", "role", "begins", (F.col("turn") + F.col("before") - 1).alias("turn"))


def render_turns(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, role, n_lines, rendered): one canonical form, without the speaker markers."""
    @F.pandas_udf("string")
    def words(line: pd.Series) -> pd.Series:
        return line.map(lambda x: x[marker_of(x)[1]:])

    clean = F.when(F.col("begins"), words("line")).otherwise(F.col("line"))
    rows = parsed.select("conv_id", "turn", "role", "begins", F.struct(F.coalesce("line_no", F.lit((1 << 62))).alias("line_no"), "h", clean.alias("words")).alias("x"))
    turns = rows.groupBy("conv_id", "turn").agg(F.first("role").alias("role"), F.count("*").alias("n_lines"), F.array_sort(F.collect_list("x")).alias("xs"))
    text = F.array_join(F.transform("xs", lambda x: x["words"]), "\n")
    return turns.select("conv_id", "turn", "role", "n_lines", F.concat(F.lit("<|"), "role", F.lit("|>\n"), text, F.lit("<|end|>")).alias("rendered"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """The turns recovered from the transcripts of (conv_id, turn, role, text), by a model trained on them."""
    lines = staged(as_transcript(turns), "transcript")
    return render_turns(parse_transcripts(lines, train(lines)))
