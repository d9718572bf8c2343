"""Each operator against a brute-force version, on the smallest table and on nulls, empty and very long
texts, repeated rows and ids, clashing column names, and empty tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, licenses, line_dedup, mixing, ngram_join, pii_spans, quality_rules, token_shards, transcripts, warc, wavelet
from tidemark.llm.components import components
from tidemark.llm.queries import TOKENIZER

LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return PLAIN.findall((text or "").translate(LOW))


def multiset(df, *columns):
    return Counter(tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.select(*columns).collect())


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (7, 8), (8, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if n in got} and set(got) == {x for a, b in links if a != b for x in (a, b)}


def test_decontaminate(spark, documents, sample):
    items = [(1, "A b c d e f g h i j k l"), (2, "one two"), (3, None), (4, ""), (None, "a b c d e f"), (5, "never-seen words"), (6, "one TWO"), (6, "a b c d e f")]
    items += [(100 + i, " ".join(plain(t)[3:30])) for i, (_, t, *_) in enumerate(sample[:20]) if t]
    got = multiset(decontaminate.decontaminate(documents(sample), spark.createDataFrame(items, "item_id long, text string")), "doc_id", "n_words", "n_hit", "items", "contaminated")
    windows = defaultdict(set)
    for item, text in items:
        w = plain(text)
        n = min(10, len(w))
        if n and item is not None:
            for i in range(len(w) - n + 1):
                windows[tuple(w[i : i + n])].add(str(item))
    want = Counter()
    for doc_id, text, *_ in sample:
        w, hit, found = plain(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        want[(doc_id, len(w), len(hit), tuple(sorted(found)), bool(hit))] += 1
    assert got == want
    assert sum(k[4] for k in want) > 15


def test_pii_base_spans_equal_the_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rng = random.Random(3)
    for _ in range(8000):
        t = "".join(rng.choice("ab.@-+ 0125()é%4") for _ in range(rng.randint(0, 60)))
        want = [(m.start(), 0, m.end()) for m in email.finditer(t)] + [(m.start(), 1, m.end()) for m in ip.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
        want += [(m.start(), 2, m.end()) for m in card.finditer(t) if 14 <= len(digits(m)) <= 19 and pii_spans.luhn(digits(m))]
        want += [(m.start(), 3, m.end()) for m in phone.finditer(t) if 10 <= len(digits(m)) <= 15]
        assert pii_spans.base_spans(t) == sorted(want)


@pytest.mark.parametrize(("text", "found"), [
    ("write to john [at] mail (dot) example dot com now", "email:john [at] mail (dot) example dot com"),
    ("bob at mail dot example dot org, ok", "email:bob at mail dot example dot org"),
    ("ü jоhn@exаmple.com", "email:jоhn@exаmple.com"),
    ("call plus one four one five five five five two six seven one please", "phone:plus one four one five five five five two six seven one"),
    ("at １０.0.0.1 now", "ip:１０.0.0.1"),
    ("four" + " one" * 15, "card:four" + " one" * 15),
    ("look at the dot on it", ""), ("one or two, three or four", ""), ("Он пришёл домой", ""), ("", ""),
])
def test_disguised_spans(text, found):
    spans = pii_spans.all_spans(text, pii_spans.base_spans(text))
    assert ",".join(f"{pii_spans.KINDS[k]}:{text[s:e]}" for s, k, e in spans) == found


@pytest.mark.parametrize(("text", "found"), [
    ("host one nine two dot one six eight dot zero dot one is up", "ip:one nine two dot one six eight dot zero dot one"),
    ("host 192 dot one six eight [dot] zero dot 1 is up", "ip:192 dot one six eight [dot] zero dot 1"),
    ("at one.two.three.four now", "ip:one.two.three.four"),
    ("three zero zero dot one dot one dot one", ""),
    ("call plus one four one five 555 0123 now", "phone:plus one four one five 555 0123"),
    ("call plus one 415 555 0123 now", "phone:plus one 415 555 0123"),
    ("call plus 1 415 555 0123 now", "phone:plus 1 415 555 0123"),
    ("card four one one one 1111 1111 1111 ok", "card:four one one one 1111 1111 1111"),
    ("card 4111 one one one one 1111 1111 ok", "card:4111 one one one one 1111 1111"),
    ("card 4111 1111 1111 111 one ok", "card:4111 1111 1111 111 one"),
    ("card four one one one 1111 1111 1112 ok", ""),
    ("ask alice at gmail.com or so", "email:alice at gmail.com"),
    ("ask Alice at mail dot example.co.uk, ok", "email:Alice at mail dot example.co.uk"),
    ("ask bob at example [dot] com ok", "email:bob at example [dot] com"),
    ("call +1 415 555 0123 two times", "phone:+1 415 555 0123"), ("one 4111 1111 1111 1111 card", "card:4111 1111 1111 1111"),
    ("call +1 415 555 0123 two, three times", "phone:+1 415 555 0123"),
    ("we met at noon. Later two of 12 left at 5.30", ""), ("plus one more dot com firm, at one o'clock", ""), ("one of 2 at home.", ""),
])
def test_spelled_and_mixed_spans(text, found):
    spans = pii_spans.all_spans(text, pii_spans.base_spans(text))
    assert ",".join(f"{pii_spans.KINDS[k]}:{text[s:e]}" for s, k, e in spans) == found


def test_pii_rows(documents, sample):
    rows = sample + [(9100, "a@b.co and jоhn@exаmple.com " + "1" * 50_000)]
    got = {(r.doc_id, r.n_email, r.spans) for r in pii_spans.find_pii(documents(rows)).collect() if r.doc_id in (None, 9001, 9100)}
    assert got == {(None, 0, ""), (9001, 0, ""), (9100, 1, "email:0:6,email:11:27")}
    assert pii_spans.find_pii(documents(rows)).count() == len(rows)


def test_quality_statistics(spark, documents, sample):
    rows = sample + [(9200, "a b c d e a b c d e\nx\nx\n \nx # $ é")]
    labels = spark.createDataFrame([(r[0], int(len(r[1] or "") > 20)) for r in sample] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = quality_rules.quality_rules(documents(rows), labels)
    want = Counter()
    for doc_id, text, *_ in rows:
        text = text or ""
        w = SPACED.findall(text)
        seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        want[(doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed)] += 1
    assert multiset(out, "doc_id", *quality_rules.STATS, "base_failed") == want
    assert out.where("base_failed AND kept").count() == 0
    kept = quality_rules.filter_quality(documents(rows), labels)
    assert kept.columns == documents(rows).columns and kept.count() == out.where("kept").count()
    none = labels.where("false")
    assert quality_rules.quality_rules(documents(rows), none).where("kept = base_failed").count() == 0


def test_forest_finds_held_out_anomalies():
    import duckdb
    import pyarrow as pa

    at = "/root/testdata/sf0.1"
    rows = duckdb.connect().execute(f"SELECT text, quality, doc_id % 2 FROM '{at}/documents.parquet' JOIN '{at}/labels.parquet' USING (doc_id)").fetchall()
    stats = quality_rules.statistics(pa.array([r[0] for r in rows]))
    bad, held_out = np.array([r[1] == 0 for r in rows]), np.array([r[2] == 1 for r in rows])
    x, left = quality_rules.features(stats), ~quality_rules.base_failed(stats)
    forest = quality_rules.Forest.fit(x[~held_out])
    own = ~held_out & left
    forest.calibrated(forest.scores(x[own]), bad[own])
    rejected = forest.scores(x) > forest.threshold
    assert rejected[held_out & left & bad].mean() > 0.9 and rejected[held_out & left & ~bad].mean() < 0.005


def test_points_are_counted_by_residues(spark):
    n, bits = 600, mixing._BITS
    points = [int(format(i, f"0{bits}b")[::-1], 2) for i in range(n)]
    bounds = [0, 1, 1 << 39, (1 << 40) - 1, 1 << 40, 0b1011 << 36, 12345678901]
    df = spark.range(n + 1).crossJoin(spark.createDataFrame([(b,) for b in bounds], "b long"))
    df = df.withColumn("p", mixing._pieces(F.col("b"))).select("id", "b", mixing._points_below(F.col("id"), F.col("p")).alias("c"))
    assert {(r.id, r.b): r.c for r in df.collect()} == {(i, b): sum(p < b for p in points[:i]) for i in range(n + 1) for b in bounds}


def test_mixture(documents, sample):
    rows = [(d, t, s) for d, t, s in sample if d != 9006 and d != 9007]
    out = mixing.mixture(documents(rows)).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((d, len(SPACED.findall(t or ""))) for d, t, _ in rows)
    assert all(r.taken <= 3 * r.size for r in out)
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = dict(zip(names, [5, 2, 1] * len(names), strict=False))
    want, left, total = {}, set(names), sum(sizes.values())
    while True:
        rest = total - sum(want.values())
        level = rest / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level > 3 * sizes[s]}
        want |= {s: 3 * sizes[s] for s in full}
        left -= full
        if not full:
            break
    want |= {s: weight[s] * level for s in left}
    for s in names:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 25 + 0.01 * target[s]
    again = mixing.mixture(documents(rows))
    assert multiset(again, "doc_id", "source", "taken") == Counter((r.doc_id, r.source, r.taken) for r in out)
    mixed = Counter()
    for r in mixing.mixed_documents(documents(rows)).collect():
        mixed[r.doc_id] += len(SPACED.findall(r.text))
    per_doc = Counter()
    for r in out:
        per_doc[r.doc_id] += r.taken
    assert mixed == +per_doc


def test_mixture_of_small_sources_in_large_blocks(documents):
    sizes = {"a": 90_000, "b": 77, "c": 5, "d": 64, "e": 1, "f": 640, "g": 130}
    rows = [(i, " ".join(["w"] * min(97, n - at)), s) for s, n in sizes.items() for i, at in enumerate(range(0, n, 97))]
    empty = [(7, None, "a"), (7, None, "a"), (7, "", "c"), (7, "", "c"), (7, "", "c"), (None, " ", "h")]
    out = mixing.mixture(documents(rows + empty), slots=100).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in out) == Counter((d, s, len((t or "").split())) for d, t, s in rows + empty)
    taken, target = Counter(), {}
    for r in out:
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s in [*sizes, "h"]:
        assert abs(taken[s] - target[s]) <= 0.5, s
    assert all(target[s] == 3 * n for s, n in sizes.items() if s != "a")


def test_schedule_has_every_rank_once(spark):
    sized = spark.createDataFrame([(f"s{i:03}", n) for i, n in enumerate([100_000, 3, 70, 64, 0, 5000, 1] + [9] * 40)], "source string, size long")
    weighted = mixing.sources(sized, 64)
    want = {r.sid: r for r in weighted.collect()}
    got = mixing.schedule(spark, weighted, sum(r.ranks for r in want.values()), len(want)).collect()
    assert Counter((r.sid, r.rank) for r in got) == Counter((s, k) for s, r in want.items() for k in range(r.ranks))
    assert len({r.slot for r in got}) == len(got)
    words = Counter()
    for r in got:
        words[r.sid] += r.last if r.last is not None else min(64, want[r.sid].source_size - r.block * 64)
        assert r["pass"] < 3
    assert all(abs(words[s] - r.target) <= 0.5 for s, r in want.items())


def test_licenses(documents, sample):
    notice = "x " * 40 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software" + " and associated documentation files. y" * 1
    rows = sample + [(9300, notice), (9301, "the MIT  License; Apache-License general public license mit license"), (9302, "licensed under cc by nc"), (9303, "Licensed under CC BY-NC 4.0. z")]
    out = licenses.scan_licenses(documents(rows))
    want = Counter()
    for doc_id, text, *_ in rows:
        w = plain(text)
        at = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        want[(doc_id, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at})))] += 1
    assert multiset(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    got = {r.doc_id: (r.labels, r.score) for r in out.collect() if (r.doc_id or 0) > 9299}
    assert got == {9300: ("mit", 1.0), 9301: ("apache,gpl,mit", 1.0), 9302: ("", 0.0), 9303: ("cc-by-nc", 1.0)}


def test_license_join_equals_all_blocks(documents, sample):
    rng = random.Random(4)
    words = [w for t in ("licensed under the apache license version 2 0", "source code form") for w in t.split()] + list("abcdef")
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 150)))) for i in range(60)]
    templates = {"one": ("licensed under the apache license version",), "two": ("this source code form is",)}
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(documents(rows), templates, 70).collect()}
    for doc_id, text in rows:
        w, found = plain(text), set()
        for label, (t,) in templates.items():
            own = set(t.split())
            if any(len(own & set(w[i : i + 64])) >= -(-70 * len(own) // 100) for i in range(0, max(len(w), 1), 32)):
                found.add(label)
        base = {label for p, label in licenses.PHRASES.items() if f" {p} " in f" {' '.join(w)} "}
        assert got[doc_id] == ",".join(sorted(found | base))


def test_license_positions_leave_out_blocks(spark):
    # (document, words in it, places of the prefix word): five words are needed, four of them besides the prefix.
    hits = [("a", 64, [(i, 0) for i in range(61)]), ("b", 64, [(i, 0) for i in range(60)]), ("c", 64, [(i, i % 2) for i in range(61)]), ("d", 6, [(0, 0), (1, 0)]),
            ("e", 6, [(0, 0), (1, 0), (2, 0)]), ("f", 4, [(0, 0)])]
    rows = [(d, 1, n, p, 7, 32, r, 5) for d, n, own in hits for p, r in own]
    df = spark.createDataFrame(rows, "doc_id string, h long, n int, pos int, template int, stride int, rank int, need int")
    assert {r.doc_id for r in licenses._candidates(df).where("block = 0").collect()} == {"b", "c", "d"}


def test_warc(spark):
    same = "<p>" + "x" * 200
    rows = [(1, "http://a", same), (2, None, same), (3, "u\r\nv", "short"), (4, "u", "short"), (5, "u", None), (None, "u", same), (0, "u", "é" * 60), (6, "u", "é" * 60), (7, "u", "z" * 700_000), (1, "b", same)]
    index = warc.write_bundles(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = multiset(warc.read_bundles(index), "page_id", "payload_bytes", "record_type", "refers_to")
    n = lambda t: len((t or "").encode())
    assert got == Counter([(1, n(same), "response", None), (1, n(same), "response", None), (2, n(same), "revisit", 1), (3, 5, "response", None), (4, 5, "response", None),
                           (5, 0, "response", None), (None, n(same), "response", None), (0, 120, "response", None), (6, 120, "revisit", 0), (7, 700_000, "response", None)])
    for r in index.where("page_id IN (2, 7)").collect():
        headers, block = warc.read_record(r.path, r.frame, r.offset, r.length)
        assert headers["X-Page-ID"] == str(r.page_id) and (b"zzz" in block) == (r.page_id == 7)


def test_ngram_components(documents, sample):
    rng = random.Random(6)
    base = [f"t{i}" for i in range(60)]
    near = [(5000 + i, " ".join(base[: 58 - i % 3] + rng.choices("xyz", k=rng.randint(0, 9)))) for i in range(40)]
    rows = sample + near + near[:5] + [(6000 + i, near[0][1].upper()) for i in range(5)]
    got = multiset(ngram_join.jaccard_components(documents(rows)), "doc_id", "n_shingles", "component_id")
    sets = []
    for doc_id, text, *_ in rows:
        w = SPACED.findall((text or "").translate(LOW))
        sets.append((doc_id, {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()))
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if a is not None and b is not None and x and y
             and 100 * len(x & y) >= 75 * len(x | y)]
    of = roots({a for a, _ in sets if a is not None}, links)
    assert got == Counter((a, len(x), of.get(a)) for a, x in sets)


def test_transcripts(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    lines = transcripts.staged(transcripts.as_transcript(turns), "t")
    held_out = F.pmod(F.xxhash64(F.lit(1), "conv_id"), F.lit(2)) == 1
    model = transcripts.train(lines.where(~held_out))
    truth = lines.where(held_out).select(F.col("conv_id").alias("c"), F.col("line_no").alias("l"), F.col("role").alias("r"), F.col("begins").alias("b"))
    parsed = transcripts.parse_transcripts(lines.where(held_out), model)
    both = parsed.join(truth, (F.col("conv_id") == F.col("c")) & (F.col("line_no") == F.col("l"))).where(F.pmod(F.xxhash64("conv_id"), F.lit(4)) != 3)
    n, roles, begins = both.agg(F.count("*"), F.avg((F.col("role") == F.col("r")).cast("int")), F.avg((F.col("begins") == F.col("b")).cast("int"))).first()
    assert n > 300 and roles > 0.95 and begins > 0.95


def test_transcript_segments_are_one_viterbi(spark, monkeypatch):
    rng = random.Random(2)
    lines = [(c, i * transcripts.LINE_STEP, rng.choice(["User: hi", "AI: well?", "so", "", "Speaker 1: x", "q: what?"])) for c in (1, None) for i in range(300)]
    lines += [(2, None, "User: a"), (2, None, "User: a"), (3, 5, "x")]
    df = spark.createDataFrame(lines, "conv_id long, line_no long, line string")
    rng = np.random.default_rng(1)
    s = transcripts.STATES
    model = transcripts.Model(*(np.log(rng.dirichlet(np.ones(x.shape[-1]), x.shape[:-1])) for x in (np.ones(s), np.ones((s, s)), np.ones((s, transcripts.OBSERVATIONS)))))
    got = {(r.conv_id, r.line_no): transcripts.ROLES.index(r.role) * 2 + r.begins for r in transcripts.parse_transcripts(df, model).collect() if r.line_no is not None}
    for c in (1, None):
        own = sorted((n, t) for k, n, t in lines if k == c)
        states = model.viterbi(np.array([transcripts.observe(t) for _, t in own]), None, None)
        assert [got[(c, n)] for n, _ in own] == states.tolist()
    out = transcripts.render_turns(transcripts.parse_transcripts(df, model))
    assert out.agg(F.sum("n_lines")).first()[0] == len(lines)
    assert transcripts.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_token_shards(documents, sample):
    from tokenizers import Tokenizer

    extra = [" ", "  x\n\ny  z\n w", "it's the dog's. Ok?\nYes!\n\n\nNo 12.5 x", "é × a÷b à la b 　x  y", "a b\x1c c \x85 d", "we're.they'll!I'd\t x", "\nA", " lead", "trail ", "<|endoftext|> x"]
    rows = [r for r in sample if r[0] != 9006] + [(-i, t) for i, t in enumerate(extra)]
    got = sorted(multiset(token_shards.token_shards(documents(rows), TOKENIZER, 2, shard_ids=5000), "doc_id", "start", "n_tokens", "ids_crc32").elements(), key=lambda r: r[1])
    tokenizer, want, at = Tokenizer.from_file(TOKENIZER), [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_long_texts_of_distinct_pieces(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_shards, "SLOTS", 1 << 10)
    encoder, tokenizer = token_shards.Encoder(TOKENIZER, 2), Tokenizer.from_file(TOKENIZER)
    rng = random.Random(5)
    long = " ".join(f"{rng.randrange(10**9):x}" for _ in range(5000))
    texts = ["", long, None, "a b", "x" * 3000 + " " + "é" * 800, long[:9000] + "\nend.", "", "so " * 900, ""]
    for chunk in token_shards.chunks(pa.array(texts), token_shards.SPACED, lower=False, most=20_000):
        ids, counts = encoder.encode(chunk)
        want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts[chunk.first_row : chunk.first_row + chunk.rows]]
        assert ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]
    assert chunk.first_row + chunk.rows == len(texts)


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for n in (0, 1, 511, 512, 5000):
        ids = rng.integers(0, 60, n).astype(np.uint16)
        matrix, doc_ids, nulls, counts = wavelet.unpack(b"".join(wavelet.pack(ids, 16, np.array([4, 0]), np.array([False, True]), np.array([n, 0]))))
        assert (matrix.decode() == ids).all() and doc_ids.tolist() == [4, 0] and nulls.tolist() == [False, True] and counts.tolist() == [n, 0]
        for i in rng.integers(0, n, 20) if n else []:
            assert matrix.access(int(i)) == ids[i]
        for v in (0, 7, 59, 61, 40_000):
            places = np.flatnonzero(ids == v)
            assert matrix.count(v) == len(places) and matrix.count(v, n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()
            assert [matrix.find(v, k) for k in (0, len(places) - 1, len(places))] == ([places[0], places[-1], -1] if len(places) else [-1, -1, -1])


def test_line_dedup(documents, sample):
    lines = ["The quick brown fox jumps", "The quick brown fox jump", "The quick brown fox jumpz", "Xhe quick brown fox jumps", "the quikc brown fox jumps", "short", "shorT", "short", " ", ""]
    rng = random.Random(9)
    rows = sample[:80] + sample[200:] + [(7000 + i, "\n".join(rng.choices(lines, k=6))) for i in range(30)]
    out = line_dedup.dedup_lines(documents(rows))
    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < line_dedup.MIN_CHARS or abs(len(a) - len(b)) > 1:
            return False
        i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]

    unique = [r for r in rows if r[0] is not None and Counter(x[0] for x in rows)[r[0]] == 1]
    earlier, want = [], {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for i, line in enumerate(text.split("\n") if text is not None else []):
            if line.strip(" \t\x0b\x0c\r"):
                if any(near(line, x) for x in earlier):
                    want.setdefault(doc_id, []).append(i)
                earlier.append(line)
    removed = {r.doc_id: list(r.removed) for r in out.collect()}
    for doc_id, *_ in unique:
        assert removed[doc_id] == want.get(doc_id, []), doc_id
    kept = {r.doc_id: r.text for r in out.collect()}
    for doc_id, text, *_ in unique:
        if text is not None:
            assert kept[doc_id] == "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want.get(doc_id, []))


def test_empty_tables(spark, documents):
    none = documents([(1, "x")]).where("false")
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for out in (decontaminate.decontaminate(none, items), pii_spans.find_pii(none), quality_rules.quality_rules(none, labels), mixing.mixture(none), mixing.mixed_documents(none),
                licenses.scan_licenses(none), ngram_join.jaccard_components(none), token_shards.token_shards(none, TOKENIZER), line_dedup.dedup_lines(none),
                warc.warc_round_trip(spark.createDataFrame([], "page_id long, html string"))):
        assert out.count() == 0
