"""Gazetteer and term matching, against the definition by regular expressions."""

import random
import re

from pyspark.sql import functions as F

from tidemark.functions.terms import BOUNDED, SUBSTRING, Alias, Gazetteer
from tidemark.operators import terms as T

TECH = Gazetteer.from_mapping(
    {
        "language": {
            "Python": ["python", "蟒蛇"],
            "C++": ["c++", "cpp"],
            "C": [" c ", "c語言"],
            "JavaScript": ["javascript", "js"],
            "Plus": ["+"],
        },
        "framework": {
            "Next.js": ["next.js"],
            "React": ["react"],
            "React Native": ["react native"],
            "sci-kit": ["sci-kit"],
            "CI/CD": ["ci/cd", "ci / cd"],
        },
        "ml": {"ML": ["machine learning", "機器學習", "ml"]},
        "empty": {"Nothing": ["  "]},
    }
)


def definition(gazetteer: Gazetteer, text: str | None) -> list[str]:
    found = []
    for term in gazetteer.terms:
        for a in gazetteer.aliases:
            esc = re.escape(a.alias)
            if a.mode == BOUNDED:
                esc = f"(?<![a-z0-9]){esc}(?![a-z0-9])"
            if a.canonical == term and text and re.search(esc, text):
                found.append(term)
                break
    return found


def test_compile():
    modes = {a.alias: (a.mode, a.anchor) for a in TECH.aliases}
    assert modes["python"] == (BOUNDED, "python")
    assert modes["c"] == (BOUNDED, "c")
    assert modes["react native"] == (BOUNDED, "native")
    assert modes["next.js"] == (BOUNDED, "next")
    assert modes["sci-kit"] == (SUBSTRING, None)
    assert modes["機器學習"] == (SUBSTRING, None)
    assert modes["+"] == (BOUNDED, None)
    assert "Nothing" not in TECH.terms
    assert TECH.categories["ML"] == "ml"


def test_term_listed_twice_keeps_first_place_and_last_category():
    g = Gazetteer.from_mapping({"a": {"x": ["x1"], "y": ["y"]}, "b": {"x": ["x2"]}})
    assert g.terms == ("x", "y") and g.categories == {"x": "b", "y": "a"}


def test_from_yaml(tmp_path):
    path = tmp_path / "g.yaml"
    path.write_text("cat:\n  'C#': ['c#', CSharp]\n  R: [r語言]\n", encoding="utf-8")
    g = Gazetteer.from_yaml(str(path))
    assert [(a.canonical, a.alias, a.mode) for a in g.aliases] == [
        ("C#", "c#", BOUNDED), ("C#", "csharp", BOUNDED), ("R", "r語言", SUBSTRING),
    ]


def test_traps(values):
    texts = [
        "c++ and c#", "c_x éc", "mysci-kitx", "next.js", "react native app", "python3 xpython",
        "pythonç", "use  machine  learning", "ci / cd", "", None, "ci/cd,js", "機器學習蟒蛇",
    ]
    got = values(TECH.matches, texts)
    assert got == [definition(TECH, t) for t in texts]
    assert got[0] == ["C++", "C", "Plus"] and got[1] == ["C"] and got[2] == ["sci-kit"]
    assert got[3] == ["JavaScript", "Next.js"] and got[4] == ["React", "React Native"]
    assert got[5] == [] and got[9] == [] and got[10] == []


def test_random_texts_match_the_definition(values):
    rng = random.Random(7)
    pieces = [a.alias for a in TECH.aliases] + list(" .+#/-_éç中x9A") + ["cp", "p", "rea", "\\E", "\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(3000)]
    assert values(TECH.matches, texts) == [definition(TECH, t) for t in texts]


def test_thousands_of_substring_aliases(values):
    rng = random.Random(8)
    letters = "資料庫工程師系統網路é中x😀"
    terms = {"".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(2500)}
    g = Gazetteer(Alias(t, "c", t, SUBSTRING) for t in sorted(terms))
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 6))) for _ in range(40)]
    assert values(g.matches, texts) == [[t for t in g.terms if t in text] for text in texts]


def test_alias_with_quoting_marks(values):
    g = Gazetteer([Alias("q", "c", "a\\e b", BOUNDED), Alias("s", "c", "'\"", SUBSTRING)])
    assert values(g.matches, ["x a\\e b", "xa\\e b", "'\""]) == [["q"], [], ["s"]]


def test_empty_gazetteer(values):
    assert values(Gazetteer([]).matches, ["a"]) == [[]]


def test_term_extract(spark):
    rows = [("s", "1", "c++ and python"), ("s", "2", "nothing"), ("s", "3", None)]
    df = spark.createDataFrame(rows, "source string, job_id string, full_text string")
    for c in ("year_month", "region", "seniority", "company", "title"):
        df = df.withColumn(c, F.lit("x"))
    df = df.withColumn("salary_monthly_mid", F.lit(1.0))
    out = T.term_extract(df, TECH)
    assert out.columns == [*T.LONG_COLUMNS, "category"]
    got = {(r.job_id, r.skill, r.category) for r in out.collect()}
    assert got == {
        ("1", "Python", "language"), ("1", "C++", "language"), ("1", "C", "language"),
        ("1", "Plus", "language"),
    }
    matched = {r.job_id: r.skills for r in T.term_match(df, TECH).collect()}
    assert matched == {"1": ["Python", "C++", "C", "Plus"], "2": [], "3": []}
