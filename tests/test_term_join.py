"""The join form of term matching, against the definition by regular expressions."""

import random

from pyspark.sql import functions as F

from test_terms import TECH, definition
from tidemark.functions.terms import BOUNDED, SUBSTRING, Alias, Gazetteer, char_class
from tidemark.operators import term_join
from tidemark.operators.term_join import compile_aliases, term_match_join

SCHEMA = "i long, full_text string, alias string, salt int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)


def matched(spark, gazetteer, texts, **more):
    df = term_match_join(frame(spark, texts), gazetteer.table(spark), **more)
    assert df.columns == ["i", "full_text", "alias", "salt", "skills"]
    return {r.i: r.skills for r in df.collect()}


def test_compile(spark):
    got = {r.alias: (r.bounded, r.anchor, r.is_word, r.sure) for r in compile_aliases(TECH.table(spark).drop("mode")).collect()}
    assert got["python"] == (True, "python", True, True)
    assert got["react native"] == (True, "react native", True, False)
    assert got["c++"] == (True, "c", True, False)
    assert got["+"] == (True, "+", False, False)
    assert got["機器學習"] == (False, "機器", False, False)
    assert got["蟒蛇"] == (False, "蟒蛇", False, True)
    assert "" not in got


def test_random_texts_match_the_definition(spark):
    rng = random.Random(7)
    pieces = [a.alias for a in TECH.aliases] + list(" .+#/-_éç中x9A😀") + ["cp", "p", "rea", "\\E", "\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(1500)] + [None, ""]
    texts += texts[:20]
    assert matched(spark, TECH, texts) == {i: definition(TECH, t) for i, t in enumerate(texts)}


def test_substrings_quoting_and_modes(spark):
    rng = random.Random(8)
    letters = "資料庫工程師系統網路é中x😀"
    terms = {"".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(1500)}
    g = Gazetteer([Alias(t, "c", t, SUBSTRING) for t in sorted(terms)] + [Alias("q", "c", "a\\e b", BOUNDED), Alias("s", "c", "'\"", SUBSTRING)])
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 6))) for _ in range(60)] + ["x a\\e b", "xa\\e b", "'\""]
    assert matched(spark, g, texts, salts=3) == {i: definition(g, t) for i, t in enumerate(texts)}


def test_without_position_in_order_of_names_and_empty_tables(spark):
    rows = spark.createDataFrame([("b", "B "), ("a", "b"), ("b", "b"), (None, "b"), ("n", None), ("e", " \t")], "skill string, alias string")
    assert [r.skills for r in term_match_join(frame(spark, ["x b", "b", "c"]), rows).orderBy("i").collect()] == [["a", "b"], ["a", "b"], []]
    assert [r.skills for r in term_match_join(frame(spark, ["b", None]), rows.limit(0)).collect()] == [[], []]
    assert term_match_join(frame(spark, []), rows).count() == 0


def test_no_alias_in_the_plan_and_salted(spark):
    rows = spark.range(3000).select(F.concat(F.lit("zq"), "id").alias("skill"), F.concat(F.lit("hot zq"), "id").alias("alias"))
    df = term_match_join(frame(spark, ["hot zq5"]), rows.withColumn("position", F.lit(1)))
    plan = df._jdf.queryExecution().toString()
    assert "zq5" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan and "salt" in plan
    assert df.first().skills == ["zq5"]


def test_anchors_and_texts_are_joined_by_short_hashes(spark):
    def matched_and_wide(alias):
        rows = spark.createDataFrame([("s", alias)], "skill string, alias string")
        df = term_match_join(frame(spark, ["a b c", "xa b cx", "é"]), rows)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        join = plan[plan.index("Join Inner"):]
        return [r.skills for r in df.orderBy("i").collect()], "md5" in join

    assert matched_and_wide("a b") == ([["s"], [], []], False)
    assert matched_and_wide("a b c") == ([["s"], [], []], False)
    assert matched_and_wide("é") == ([[], [], ["s"]], False)


def test_aliases_that_are_their_anchor_are_not_looked_for_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(term_join, "_holds", lambda *_: F.lit(False))
    rows = spark.createDataFrame([(a, a) for a in ("b", "b, c", "資料庫", "é", "x")] + [("named", "b")], "skill string, alias string")
    df = term_match_join(frame(spark, ["a b, c", "a 資料庫é", "ab b"]), rows.withColumn("mode", F.when(F.col("alias") == "b, c", BOUNDED)))
    assert [r.skills for r in df.orderBy("i").collect()] == [["b", "b, c", "named"], ["é", "資料庫"], ["b", "named"]]


def test_anchors_of_the_same_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(term_join, "_key", lambda *_: F.lit(7) + F.length(F.lit("")))
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["react", "native", "c++", "-", "機器學習", "蟒蛇", "go"], k=6)) for _ in range(30)]
    assert matched(spark, TECH, texts, salts=2) == {i: definition(TECH, t) for i, t in enumerate(texts)}


def test_class_of_characters(values):
    assert char_class("aé") == r"[\x{61}\x{e9}]"
    far = [chr(x) for x in (300, 302, 303, 400, 500, 0x1F600)]
    assert char_class(far) == r"[\x{12c}-\x{12f}\x{190}-\x{190}\x{1f4}-\x{1f4}\x{1f600}-\x{1f600}]"
    assert values(lambda c: F.rlike(c, F.lit(char_class([*far, "]", "^", "-"]))), [*far, "]", "^", "-", "a"]) == [True] * 9 + [False]
