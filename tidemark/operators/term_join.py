"""Term matching with the gazetteer as a table.

`Gazetteer.matches` holds the aliases in the plan, which suits thousands of them. Here they are rows, and
a text meets an alias by a join on the alias's anchor: of a bounded alias its ``[a-z0-9]+`` word, or the
longest two of its words that follow each other, with what stands between them; of any other alias its first
RUN characters, or all of them. No alias is in the plan, on the driver or broadcast by force.

* Texts are cut into distinct anchors of the kinds that the aliases have, by one pattern a kind. Runs are looked for
  only where characters of the aliases' runs stand, unless these are very many. What is shuffled of an anchor and of
  its text are hashes, of four and eight bytes, so candidates are a superset and each is looked at again.
* A candidate that is its own anchor, as words, two words and short runs are, is looked up among the anchors of the
  text, all of them at once by hash. Only others are looked for in the text, one by one.
* The aliases of a run, and those of three and more words, may share their anchor with any number of others.
  Their rows are written out SALTS times and texts are dealt over the copies, so the texts of one anchor are
  joined by SALTS tasks. Other aliases are written once; adaptive execution splits what is in very many texts.
* The compiled aliases are staged, so the gazetteer is computed once and its shuffle files are gone by the join.

Null texts have no terms. An alias is lowered and trimmed, and left out where that leaves nothing; a
repeated one counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.terms import BOUNDED, SUBSTRING, char_class
from tidemark.functions.text import once
from tidemark.sources.lake import scratch

SALTS = 8
#: Characters of the anchor of an alias without words.
RUN = 4
#: Shared anchors, of four bytes each, up to which they are broadcast, so that no others of a text are shuffled.
BROADCAST_ANCHORS = 1_000_000
#: Characters at one place of the anchors up to which the pattern for runs names them.
NAMED_CHARACTERS = 2000
#: Aliases from which the join with texts is by merge.
MERGED_ALIASES = 100_000

# Characters of Unicode's white space.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Two words that follow each other, from the first one's begin. Every word is gone through once.
_PAIR = "(?<![a-z0-9])(?=([a-z0-9]++[^a-z0-9]++[a-z0-9]++))[a-z0-9]++"


def compile_aliases(gazetteer: DataFrame, run: int = 2) -> DataFrame:
    """(anchor, is_word, alias, bounded, sure, n_words, skill, position) from rows (skill, alias) with an optional
    mode and position. Without a mode an alias of letters, digits, space and ``. + # /`` is bounded; without
    a position terms are in the order of their names. `run`: characters of the anchor of an alias without words."""
    alias = F.lower(F.btrim(F.col("alias").cast("string"), F.lit(_SPACES)))
    own = F.col("mode") if "mode" in gazetteer.columns else F.lit(None).cast("string")
    position = F.col("position").cast("long") if "position" in gazetteer.columns else F.lit(0).cast("long")
    rows = gazetteer.select(F.col("skill").cast("string").alias("skill"), alias.alias("alias"), own.alias("mode"), position.alias("position"))
    rows = rows.where("skill IS NOT NULL AND alias <> ''")
    by_form = F.when(F.rlike("alias", F.lit("^[a-z0-9 .+#/]++$")), BOUNDED).otherwise(SUBSTRING)
    # A term named as its alias is shuffled once.
    rows = rows.select(F.nullif("skill", F.col("alias")).alias("skill"), "alias", "position", (F.coalesce("mode", by_form) == BOUNDED).alias("bounded")).distinct()
    rows = rows.withColumn("n_words", F.when(F.col("bounded"), F.regexp_count("alias", F.lit("[a-z0-9]++"))).otherwise(0))
    # The longest two words side by side, of equally long ones the first.
    longest = F.aggregate(_pairs(F.col("alias")), F.lit(""), lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best))
    two = F.regexp_extract("alias", "[a-z0-9]++[^a-z0-9]++[a-z0-9]++", 0)
    n, is_word = F.col("n_words"), F.col("n_words") > 0
    anchor = F.when(n == 0, F.substring("alias", 1, run)).when(n == 1, F.regexp_extract("alias", "[a-z0-9]++", 0)).when(n == 2, two).otherwise(longest)
    rows = rows.withColumn("is_word", is_word).withColumn("anchor", anchor)
    # A bounded alias without a word has no letter or digit to touch except around it, so it is looked at again.
    sure = (n < 2) & (F.col("anchor") == F.col("alias")) & (is_word | ~F.col("bounded"))
    return rows.select("anchor", "is_word", "alias", "bounded", sure.alias("sure"), "n_words", F.coalesce("skill", "alias").alias("skill"), "position")


def _pairs(text: Column) -> Column:
    """Every two words that follow each other, as they stand in the text."""
    return F.regexp_extract_all(text, F.lit(_PAIR), 1)


#: Kinds of anchors, each with the aliases that have it: a word, two words, two words of more, runs by their length.
KINDS = {
    "word": "is_word AND n_words = 1", "pair": "is_word AND n_words = 2", "part": "is_word AND n_words > 2",
    **{f"run{n}": f"NOT is_word AND length(anchor) = {n}" for n in range(1, RUN + 1)},
}
RUNS = {f"run{n}": n for n in range(1, RUN + 1)}
SHARED = ("part", *RUNS)
# How a candidate is looked at again: among the words and pairs of the text, among its runs, in the text, there with
# what stands around it.
_AMONG_WORDS, _AMONG_RUNS, _IN_TEXT, _BOUNDED_IN_TEXT = range(4)


def _key(anchor: Column, is_word: Column | bool) -> Column:
    """Four bytes that stand for an anchor in the join."""
    return F.hash(F.lit(is_word) if isinstance(is_word, bool) else is_word, anchor)


def _salted(key: Column, salt: Column) -> Column:
    """The key of a shared anchor in one of its copies; the key itself where the salt is 0."""
    return F.when(salt == 0, key).otherwise(F.hash(key, salt))


def _patterns(aliases: DataFrame, kinds: set[str]) -> dict[str, str]:
    """Pattern of the runs of each kind there is: characters that the anchors have at each place, or any where
    these are very many."""
    places = [(k, i) for k, n in RUNS.items() if k in kinds for i in range(n)]
    if not places:
        return {}
    runs = aliases.where(F.col("kind").isin(*RUNS))
    each = F.explode(F.transform(F.sequence(F.lit(1), F.length("run")), lambda i: F.struct(i.alias("place"), F.substring(F.col("run"), i, F.lit(1)).alias("c"))))
    found = runs.select("kind", each.alias("at")).select("kind", "at.place", "at.c").distinct().groupBy("kind", "place")
    few = found.agg(F.count("*").alias("n"), F.slice(F.collect_list("c"), 1, NAMED_CHARACTERS).alias("c")).where(F.col("n") <= NAMED_CHARACTERS)
    named = {(r.kind, r.place - 1): char_class(r.c) for r in few.collect()}
    # After the run one character is consumed, so every place is looked at once.
    return {k: "(?s)(?=(" + "".join(named.get((k, i), ".") for i in range(RUNS[k])) + "))." for k in {k for k, _ in places}}


def _words_of(text: Column, kinds: set[str]) -> list[Column]:
    return [F.regexp_extract_all(text, F.lit("([a-z0-9]++)"), 1)] * ("word" in kinds) + [_pairs(text)] * bool(kinds & {"pair", "part"})


def _runs_of(text: Column, patterns: dict[str, str]) -> list[Column]:
    return [F.regexp_extract_all(text, F.lit(p), 1) for p in patterns.values()]


def _anchors(text: Column, kinds: set[str], patterns: dict[str, str]) -> tuple[Column, Column]:
    """Distinct keys of the anchors of a text, of the given kinds: those of own anchors and of shared ones."""
    def keys(parts: list[Column], is_word: bool) -> Column:
        return F.array_distinct(_joined([F.transform(p, lambda x: _key(x, is_word)) for p in parts], "int"))

    own = keys(_words_of(text, kinds - {"part"}), True)
    shared = F.concat(keys(_words_of(text, kinds & {"part"}), True), keys(_runs_of(text, patterns), False))
    return own, shared


def _holds(text: Column, alias: Column, bounded: Column) -> Column:
    """Whether the alias is in the text and, if bounded, somewhere touches no letter or digit."""
    quoted = F.concat(F.lit(r"(?<![a-z0-9])\Q"), F.replace(alias, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![a-z0-9])"))
    return F.when(F.contains(text, alias), ~bounded | F.rlike(text, quoted)).otherwise(False)


def _joined(parts: list[Column], kind: str) -> Column:
    return F.concat(F.array().cast(f"array<{kind}>"), *parts)


def _hits(text: Column, found: Column, words: Column, runs: Column) -> Column:
    """The candidates that are in the text."""
    def among(look: int, parts: Column) -> Column:
        # Hashes of four bytes are seldom the same, so what is not there is little.
        own = F.transform(F.filter(found, lambda e: e["look"] == look), lambda e: e["alias"])
        return once(F.array_except(own, parts), lambda absent: F.filter(found, lambda e: (e["look"] == look) & ~F.array_contains(absent, e["alias"])))

    sought = F.filter(found, lambda e: F.when(e["look"] >= _IN_TEXT, _holds(text, e["alias"], e["look"] == _BOUNDED_IN_TEXT)).otherwise(False))
    return F.concat(among(_AMONG_WORDS, words), among(_AMONG_RUNS, runs), sought)


def _names(plain: Column, hits: Column, ordered: bool) -> Column:
    """Terms that are their alias, at position 0, and those of other hits, in order."""
    name = lambda e: F.coalesce(e["skill"], e["alias"])
    if not ordered:
        return F.sort_array(F.array_distinct(F.concat(plain, F.transform(hits, name))))
    first = F.transform(plain, lambda a: F.struct(F.lit(0).cast("long").alias("p"), a.alias("s")))
    terms = F.sort_array(F.concat(first, F.transform(hits, lambda e: F.struct(e["position"].alias("p"), name(e).alias("s")))))
    # A term has one position, so what is there twice stands side by side.
    return F.array_distinct(F.transform(terms, lambda e: e["s"]))


def term_match_join(df: DataFrame, gazetteer: DataFrame, text: str = "full_text", into: str = "skills", salts: int = SALTS) -> DataFrame:
    """Adds the array of terms found in the text, each once, in order of position and name; empty where
    there is none. Lower-case the text first. `gazetteer` is a table, see `compile_aliases`."""
    with scratch(df.sparkSession) as scope:
        aliases = compile_aliases(gazetteer, RUN)
        kind = F.coalesce(*[F.when(F.expr(holds), F.lit(k)) for k, holds in KINDS.items()])
        look = F.when(F.col("anchor") != F.col("alias"), F.when(F.col("bounded"), _BOUNDED_IN_TEXT).otherwise(_IN_TEXT))
        look = F.coalesce(look, F.when(F.col("is_word"), _AMONG_WORDS).when(F.col("bounded"), _BOUNDED_IN_TEXT).otherwise(_AMONG_RUNS))
        if "position" in gazetteer.columns:
            # A term listed at several positions is at its first.
            aliases = aliases.withColumn("position", F.min("position").over(Window.partitionBy("skill")))
        run = F.when(~F.col("is_word"), F.col("anchor"))
        aliases = aliases.select(_key(F.col("anchor"), F.col("is_word")).alias("anchor"), kind.alias("kind"), run.alias("run"), "alias", look.cast("byte").alias("look"), "skill", "position")
        aliases = scope.keep(aliases, "aliases")
        kinds = {r.kind for r in aliases.select("kind").distinct().collect()}
        patterns = _patterns(aliases, kinds)
        shared = aliases.where(F.col("kind").isin(*SHARED)).select("anchor").distinct()
        few = shared.count() <= BROADCAST_ANCHORS
        large = aliases.count() > MERGED_ALIASES
    texts = df.select(F.xxhash64(F.col(text)).alias("_digest"), F.col(text).alias("_text"))
    own, common = _anchors(F.col("_text"), kinds, patterns)
    cut = texts.select("_digest", own.alias("own"), common.alias("common"))
    found = cut.select("_digest", F.size("own").alias("n_own"), F.posexplode(F.concat("own", "common")).alias("at", "anchor"))
    found = found.select("_digest", "anchor", (F.col("at") >= F.col("n_own")).alias("shared"))
    if few:
        found = found.join(F.broadcast(shared.withColumn("_held", F.lit(True))), "anchor", "left").where("_held OR NOT shared")
    share = F.when(F.col("shared"), F.pmod(F.col("_digest"), F.lit(salts)).cast("int") + 1).otherwise(0)
    dealt = found.select("_digest", _salted(F.col("anchor"), share).alias("anchor"))
    if large:
        # Else the anchors of the texts, seen as no larger than the texts, may be what is broadcast.
        dealt = dealt.hint("merge")
    places = F.when(F.col("kind").isin(*SHARED), F.sequence(F.lit(1), F.lit(salts))).otherwise(F.array(F.lit(0)))
    written = aliases.withColumn("salt", F.explode(places)).withColumn("anchor", _salted(F.col("anchor"), F.col("salt")))
    candidates = dealt.join(written.select("anchor", F.nullif("skill", F.col("alias")).alias("skill"), "alias", "look", "position"), "anchor")
    # A term that is named as its alias, and found by its anchor alone, is its name.
    plain = F.expr(f"skill IS NULL AND look = {_AMONG_WORDS} AND position = 0")
    gathered = candidates.groupBy("_digest").agg(
        F.collect_set(F.when(plain, F.col("alias"))).alias("_plain"),
        F.collect_set(F.when(~F.coalesce(plain, F.lit(False)), F.struct("position", "skill", "alias", "look"))).alias("_found"))
    both = df.withColumn("_digest", F.xxhash64(F.col(text))).join(gathered, "_digest", "left")
    body = F.col(text)
    words, runs = _joined(_words_of(body, kinds), "string"), _joined(_runs_of(body, patterns), "string")
    ordered = "position" in gazetteer.columns
    names = F.when(F.size("_found") == 0, F.sort_array(F.array_intersect("_plain", words))).otherwise(
        once(words, lambda own: _names(F.array_intersect("_plain", own), _hits(body, F.col("_found"), own, runs), ordered)))
    return both.select(*[F.col(f"`{c}`") for c in df.columns if c != into], F.coalesce(names, F.array().cast("array<string>")).alias(into))
