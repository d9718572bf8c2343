"""One query per operator over whole tables, and SQL to compare with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bottomk, collocations, decontaminate, lexical, licenses, line_dedup, mixing, ngram_join, pii_spans, quality_rules, token_shards, transcripts, warc
from tidemark.llm.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated", "n_near")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans.find_pii(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.format_conversations(table(spark, sf_dir, "conversations"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.token_shards(table(spark, sf_dir, "documents"), TOKENIZER, END_ID)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"), "text")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_decontaminate, op2_pii, op3_quality_rules, op4_mixing, op5_licenses, op6_warc, op7_ngram_join, op8_chat_format, op9_token_shards, op10_line_dedup,
              op11_collocations, op12_lexical_search, op13_near_duplicates)
}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _near_sql(size: int, percent: int, columns: str) -> str:
    """Components of the documents linked by the Jaccard similarity of their word shingles."""
    return f"""
        WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size - 1}], ' ')) END) AS x
            FROM split),
        sizes AS (SELECT doc_id, count(x) AS n FROM split LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
            JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= {percent} * (m.n + n.n - count(*))),
        reached AS (SELECT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a),
        smallest AS (SELECT node, min(other) AS low FROM reached GROUP BY node),
        found AS (SELECT doc_id, n AS n_shingles, coalesce(low, doc_id) AS component_id FROM sizes LEFT JOIN smallest ON node = doc_id)
        SELECT {columns} FROM found"""


ORACLES: dict[str, str] = {
    "op1_decontaminate": f"""
        WITH split AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        words AS (SELECT doc_id, i AS pos, w[i] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM split)),
        items AS (SELECT item_id, w, least(10, len(w)) AS size
                  FROM (SELECT item_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
        windows AS (SELECT item_id, s, size, w[s:s + size - 1] AS ws FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS s FROM items)),
        grams AS (SELECT doc_id, pos, size, w[pos:pos + size - 1] AS ws
                  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM split, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
        hits AS (SELECT DISTINCT doc_id, pos, size, item_id FROM grams JOIN windows USING (size, ws)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM hits) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id),
        counted AS (SELECT t, count(*) AS n FROM words GROUP BY t),
        looked AS (SELECT * FROM (SELECT item_id, s, ws[i] AS t, s + i AS o FROM (SELECT item_id, s, ws, unnest(range(1, size + 1)) AS i FROM windows))
                   JOIN counted USING (t) QUALIFY row_number() OVER (PARTITION BY item_id, s ORDER BY n, o) <= 3),
        pairs AS (SELECT DISTINCT a.item_id, a.t AS ta, b.t AS tb, b.o - a.o AS gap FROM looked a JOIN looked b ON a.item_id = b.item_id AND a.s = b.s AND a.o < b.o),
        near AS (SELECT x.doc_id, count(DISTINCT item_id) AS n_near FROM pairs JOIN words x ON x.t = ta JOIN words y ON y.t = tb AND y.doc_id = x.doc_id
                 WHERE x.pos <> y.pos AND abs(y.pos - x.pos - gap) <= 8 GROUP BY x.doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
        FROM split LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN near USING (doc_id)""",
    "op7_ngram_join": _near_sql(5, 75, "doc_id, n_shingles, component_id"),
    "op11_collocations": f"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
        grams AS (
            SELECT lang, k, p, count(*) AS f
            FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p FROM split, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
            GROUP BY lang, k, p),
        sizes AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
        candidates AS (SELECT lang, k, p, f AS a FROM grams WHERE k > 1 AND f >= 10),
        covered AS (SELECT lang, p[1:2] AS p, a FROM candidates WHERE k = 3 UNION ALL SELECT lang, p[2:3], a FROM candidates WHERE k = 3),
        kept AS (SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM covered o WHERE o.lang = c.lang AND o.p = c.p AND 100 * o.a >= 50 * c.a)),
        cuts AS (
            SELECT c.lang, c.p, c.a, cut, x.f AS l, y.f AS r,
                   CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) c
            JOIN grams x ON x.lang = c.lang AND x.p = c.p[1:c.cut] JOIN grams y ON y.lang = c.lang AND y.p = c.p[c.cut + 1:c.k]),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
        ranked AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
                          row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank FROM lowest)
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""",
    "op12_lexical_search": f"""
        WITH split AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        held AS (SELECT doc_id, len(w) AS n, w FROM split WHERE len(w) > 0),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM held),
        postings AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM held) GROUP BY doc_id, n, t),
        weights AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, totals GROUP BY t),
        asked AS (
            SELECT item_id, t, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark) GROUP BY item_id, t),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (t) JOIN postings USING (t), totals GROUP BY item_id, doc_id),
        ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_near_duplicates": _near_sql(2, 80, "doc_id, n_shingles, component_id, doc_id = component_id AS kept"),
    "op6_warc": """
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
               CASE WHEN strlen(html) >= 100 AND page_id > min(page_id) OVER (PARTITION BY html) THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN strlen(html) >= 100 AND page_id > min(page_id) OVER (PARTITION BY html) THEN min(page_id) OVER (PARTITION BY html) END AS refers_to
        FROM pages""",
}
