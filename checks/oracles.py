"""The SQL (DuckDB) each query is compared with.

RE2 has no look-around, so a bounded alias is tested with an alternative that consumes its
neighbours, and the phone rules put the neighbours back.
"""

from __future__ import annotations

from checks.views import FETCHED, LANGUAGE_TREE, PART_SUBSTRINGS, PART_TREE
from tidemark.sources.flat import TOPIC_WORDS

# Building blocks: name -> body; each may use the ones before it.
CTES: dict[str, str] = {}

CTES["names"] = """
    SELECT DISTINCT l_orderkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey"""
CTES["texts"] = """
    SELECT l_orderkey, string_agg(p_name, ' ' ORDER BY p_name) AS description
    FROM names GROUP BY l_orderkey"""
CTES["postings"] = """
    SELECT lower(o_orderstatus) AS source,
           CAST(o_orderkey AS VARCHAR) AS job_id,
           o_orderpriority AS title,
           c_name AS company,
           description,
           c_mktsegment AS requirements,
           CAST(NULL AS VARCHAR) AS salary_text,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS salary_min,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * CAST(1.2 AS DOUBLE) END AS salary_max,
           CASE WHEN o_orderkey % 11 = 0 THEN 'negotiable'
                WHEN o_orderstatus = 'F' THEN 'month'
                WHEN o_orderstatus = 'O' THEN 'year'
                WHEN o_orderstatus = 'P' THEN 'hour' END AS salary_type,
           n_name AS city,
           CAST(NULL AS INTEGER) AS headcount,
           CAST(NULL AS VARCHAR) AS education,
           CAST(o_orderkey % 13 AS VARCHAR) || '年以上' AS experience,
           CAST(NULL AS VARCHAR) AS category,
           CAST(NULL AS VARCHAR) AS url,
           CASE WHEN o_orderkey % 97 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS posted_date,
           strftime(o_orderdate, '%Y-%m-%d') AS fetched_at
    FROM orders JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey
         LEFT JOIN texts ON o_orderkey = l_orderkey"""
CTES["cleaned"] = """
    SELECT *,
           coalesce(substr(posted_date, 1, 7), substr(fetched_at, 1, 7)) AS year_month,
           CASE WHEN regexp_matches(experience, '5年|資深|senior|10年|7年') THEN 'senior'
                WHEN regexp_matches(experience, '2年|3年|4年|mid') THEN 'mid'
                ELSE 'junior' END AS seniority,
           city AS region,
           lower(title || ' ' || coalesce(description, '') || ' ' || coalesce(requirements, ''))
               AS full_text
    FROM postings WHERE job_id IS NOT NULL AND title IS NOT NULL"""
CTES["ranked"] = """
    SELECT *,
           row_number() OVER (PARTITION BY lower(trim(company)), lower(trim(title)), region
                              ORDER BY posted_date DESC NULLS LAST, fetched_at DESC NULLS LAST,
                                       source DESC, job_id DESC) AS rn,
           min(posted_date) OVER (PARTITION BY lower(trim(company)), lower(trim(title)), region)
               AS first_seen,
           max(posted_date) OVER (PARTITION BY lower(trim(company)), lower(trim(title)), region)
               AS last_seen,
           count(*) OVER (PARTITION BY lower(trim(company)), lower(trim(title)), region)
               AS times_seen
    FROM cleaned"""
CTES["deduped"] = "SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1"


def _monthly(col: str) -> str:
    return f"""CASE salary_type WHEN 'month' THEN {col} WHEN 'year' THEN {col} / 12.0
                   WHEN 'hour' THEN {col} * 176 WHEN 'day' THEN {col} * 22 END"""


def _with_pay(table: str) -> str:
    return f"""
    SELECT * EXCLUDE (mid),
           CASE WHEN mid >= 10000 AND mid <= 1000000 THEN mid END AS salary_monthly_mid
    FROM (SELECT *, CASE WHEN salary_monthly_min IS NOT NULL AND salary_monthly_max IS NOT NULL
                         THEN (salary_monthly_min + salary_monthly_max) / 2.0
                         ELSE coalesce(salary_monthly_min, salary_monthly_max) END AS mid
          FROM (SELECT *, {_monthly('salary_min')} AS salary_monthly_min,
                       {_monthly('salary_max')} AS salary_monthly_max FROM {table}))"""


def _alias_test(alias: str, bounded: bool, text: str) -> str:
    quoted = alias.replace("'", "''")
    if not bounded:
        return f"contains({text}, '{quoted}')"
    return f"regexp_matches({text}, '(?:^|[^a-z0-9]){quoted}(?:$|[^a-z0-9])')"


def _term_tests(tree: dict, text: str, substrings: frozenset[str] | set[str] = frozenset()) -> dict[str, str]:
    """Term -> test, from the gazetteer's source text and not from its compiled form: an alias of ASCII letters,
    digits, space and . + # / is bounded unless it is listed as a substring."""
    tests: dict[str, list[str]] = {}
    for terms in tree.values():
        for term, aliases in terms.items():
            for a in aliases:
                plain = all(c.isascii() and (c.isalnum() or c in " .+#/") for c in a)
                tests.setdefault(term, []).append(_alias_test(a, plain and a not in substrings, text))
    return {term: " OR ".join(ts) for term, ts in tests.items()}


def _term_list(tree: dict, text: str, substrings: frozenset[str] | set[str] = frozenset()) -> str:
    cases = [f"CASE WHEN {t} THEN '{k}' END" for k, t in _term_tests(tree, text, substrings).items()]
    return "concat_ws(',', " + ",\n        ".join(cases) + ")"


PART_CATEGORY = {term: category for category, terms in PART_TREE.items() for term in terms}

CTES["norm"] = _with_pay("deduped")
CTES["skills"] = "\n    UNION ALL ".join(
    f"""SELECT '{term}' AS skill, source, job_id, year_month, region, seniority,
           salary_monthly_mid, company, title, '{PART_CATEGORY[term]}' AS category
    FROM norm WHERE {test}"""
    for term, test in _term_tests(PART_TREE, "full_text", PART_SUBSTRINGS).items()
)
CTES["monthly"] = """
    SELECT skill, year_month, count(DISTINCT concat_ws('-', source, job_id)) AS postings
    FROM skills WHERE year_month IS NOT NULL GROUP BY skill, year_month"""
CTES["totals"] = """
    SELECT skill, max(category) AS category,
           count(DISTINCT concat_ws('-', source, job_id)) AS total_postings
    FROM skills GROUP BY skill"""


def _mom(prev: str) -> str:
    return f"""
    SELECT *, CASE WHEN prev_count > 0 THEN
               round((postings - prev_count)::DOUBLE / prev_count::DOUBLE * 100, 1) END AS mom_pct
    FROM (SELECT *, {prev} AS prev_count FROM monthly)"""


CTES["mom"] = _mom("lag(postings) OVER (PARTITION BY skill ORDER BY year_month)")
CTES["overview"] = """
    SELECT skill, category, total_postings, year_month AS latest_month,
           postings AS latest_count, prev_count, mom_pct
    FROM totals LEFT JOIN
         (SELECT *, row_number() OVER (PARTITION BY skill ORDER BY year_month DESC) AS rn FROM mom)
         USING (skill)
    WHERE rn = 1 OR rn IS NULL"""


def _percentiles(by: str, columns: str) -> str:
    return f"""
    SELECT {columns},
           round(quantile_disc(salary_monthly_mid, 0.25)) AS p25,
           round(quantile_disc(salary_monthly_mid, 0.5)) AS p50,
           round(quantile_disc(salary_monthly_mid, 0.75)) AS p75,
           count(*) AS sample_size
    FROM skills WHERE salary_monthly_mid IS NOT NULL GROUP BY {by}"""


CTES["benchmark"] = f"""
    SELECT * FROM ({_percentiles("skill", "skill, 'ALL' AS region, 'ALL' AS seniority")}
    UNION ALL {_percentiles("skill, region", "skill, region, 'ALL' AS seniority")}
    UNION ALL {_percentiles("skill, seniority", "skill, 'ALL' AS region, seniority")})
    WHERE sample_size >= 3"""
CTES["kpi"] = """
    SELECT 'total_postings' AS metric, count(*)::DOUBLE AS value FROM norm
    UNION ALL SELECT 'distinct_skills', count(DISTINCT skill)::DOUBLE FROM skills
    UNION ALL SELECT 'distinct_companies', count(*)::DOUBLE FROM (SELECT DISTINCT company FROM norm)
    UNION ALL SELECT 'median_monthly_salary', coalesce(quantile_disc(salary_monthly_mid, 0.5), 0)
              FROM norm"""

# Parsed sources. Expected values come from the tables, not from the raw text made of them.
CTES["flat"] = f"""
    SELECT 'govt' AS source,
           CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey AS VARCHAR)
                ELSE md5(title || url) END AS job_id,
           title, company,
           'mail [email-removed], call [phone-removed] or [phone-removed], ref '
               || CAST(o_orderkey AS VARCHAR) AS description,
           concat_ws(' | ', '經驗:' || experience, '學歷:' || nullif(education, ''),
                     CASE WHEN o_orderkey % 2 = 0 THEN '工時:日班' END) AS requirements,
           salary_text,
           CASE WHEN o_totalprice > 0 THEN o_totalprice END AS salary_min,
           CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 6 <> 0 AND o_totalprice > 0
                THEN o_totalprice * CAST(1.2 AS DOUBLE) END AS salary_max,
           CASE salary_text WHEN '論件計酬' THEN 'piece' WHEN '時薪' THEN 'hour'
                WHEN '月薪' THEN 'month' WHEN '年薪' THEN 'year' ELSE 'negotiable' END AS salary_type,
           CASE c_nationkey % 4 WHEN 0 THEN '台北市' WHEN 1 THEN '新竹縣'
                WHEN 2 THEN '遠端信義區' END AS city,
           CAST(nullif(o_orderkey % 6, 0) AS INTEGER) AS headcount,
           education, experience, c_mktsegment AS category, url,
           CASE WHEN o_orderkey % 97 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS posted_date,
           '{FETCHED}' AS fetched_at
    FROM (SELECT *,
                 CASE WHEN o_orderkey % 3 = 0 THEN 'Software Engineer ' ELSE 'cook ' END
                     || o_orderpriority AS title,
                 c_name AS company,
                 CAST(o_orderkey % 13 AS VARCHAR) || '年以上' AS experience,
                 CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '大學' END AS education,
                 CASE WHEN o_orderkey % 7 = 0 THEN '論件計酬'
                      WHEN o_orderkey % 13 = 0 THEN '時薪'
                      WHEN o_orderstatus = 'F' THEN '月薪'
                      WHEN o_orderstatus = 'O' THEN '年薪' ELSE '面議(P)' END AS salary_text,
                 'https://jobs.example.com/d?E=' || CAST(o_custkey AS VARCHAR)
                     || CASE WHEN o_orderkey % 10 = 0 THEN '#' ELSE '&' END
                     || 'HIRE_ID=' || CAST(o_orderkey AS VARCHAR) AS url
          FROM orders JOIN customer ON o_custkey = c_custkey)"""

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(\+?886[-\s]?|0)\d{1,2}[-\s]?\d{3,4}[-\s]?\d{3,4}"
MOBILE = r"(\+?886[-\s]?|0)9\d{2}[-\s]?\d{3}[-\s]?\d{3}"


def _scrubbed(text: str) -> str:
    text = f"regexp_replace({text}, '{EMAIL}', '[email-removed]', 'g')"
    for rule in (PHONE, MOBILE):
        text = rf"regexp_replace({text}, '(^|\D){rule}(\D|$)', '\1[phone-removed]\3', 'g')"
    return text


CTES["payload"] = """
    SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS job_id, turn, role, text,
           conv_id,
           array_to_string(list_filter(
               list_concat(string_split(text, chr(10)),
                           [role, CAST(turn AS VARCHAR) || '年',
                            CASE WHEN turn % 2 = 1 THEN '大學' ELSE '' END, '英文 中等']),
               lambda p: p <> ''), ' | ') AS requirements
    FROM conversations"""
CTES["nested"] = f"""
    SELECT 'job104' AS source, job_id, role AS title,
           'conv ' || CAST(conv_id AS VARCHAR) AS company,
           {_scrubbed('text')} AS description,
           {_scrubbed('requirements')} AS requirements,
           salary_text,
           CAST(nullif(turn * 10000, 0) AS DOUBLE) AS salary_min,
           CASE WHEN turn % 2 = 0 THEN CAST(nullif(turn * 15000, 0) AS DOUBLE) END AS salary_max,
           CASE WHEN turn % 3 = 0 THEN 'month' WHEN turn % 3 = 1 THEN 'negotiable'
                ELSE 'hour' END AS salary_type,
           CASE WHEN turn % 2 = 0 THEN '台中市' ELSE '高雄市' END AS city,
           CAST(nullif(turn, 0) AS INTEGER) AS headcount,
           CASE WHEN turn % 2 = 1 THEN '大學' ELSE '' END AS education,
           CAST(turn AS VARCHAR) || '年' AS experience,
           role AS category,
           'https://www.104.com.tw/job/' || job_id AS url,
           '2024-01-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0') AS posted_date,
           '{FETCHED}' AS fetched_at
    FROM (SELECT *, CASE WHEN turn % 3 = 0 THEN '月薪4萬' WHEN turn % 3 = 1 THEN '面議 月薪'
                         ELSE '時薪200' END AS salary_text FROM payload)"""
CTES["parsed"] = "SELECT * FROM flat UNION ALL SELECT * FROM nested"


# The same chain over postings with city texts and without some companies.
CTES["sparse_postings"] = """
    SELECT * REPLACE (
        CASE CAST(job_id AS BIGINT) % 5 WHEN 0 THEN '台北市' || city WHEN 1 THEN '於新竹縣' || city WHEN 2 THEN '遠端' WHEN 3 THEN city END AS city,
        CASE WHEN CAST(job_id AS BIGINT) % 3 <> 0 THEN company END AS company)
    FROM postings"""
_CHAIN = ("postings", "cleaned", "ranked", "deduped", "norm", "skills", "benchmark", "kpi")
for _name in _CHAIN[1:]:
    _body = CTES[_name]
    for _before in _CHAIN:
        _body = _body.replace(f"FROM {_before}\n", f"FROM sparse_{_before}\n").replace(f"FROM {_before} ", f"FROM sparse_{_before} ").replace(f"FROM {_before})", f"FROM sparse_{_before})")
        if _body.endswith(f"FROM {_before}"):
            _body = _body.removesuffix(_before) + f"sparse_{_before}"
    if _name == "cleaned":
        _body = _body.replace("city AS region", """CASE CAST(job_id AS BIGINT) % 5 WHEN 0 THEN '台北市' WHEN 1 THEN '於新竹縣' WHEN 2 THEN '遠端' ELSE '其他' END AS region""")
    if _name == "ranked":
        _body = _body.replace("lower(trim(company))", "coalesce(lower(trim(company)), '')")
    CTES[f"sparse_{_name}"] = _body


def _sql(select: str) -> str:
    """The select with the blocks it needs, directly or through others, in order."""
    needed, text = [], select
    for name in reversed(CTES):
        if _uses(text, name):
            needed.append(name)
            text += CTES[name]
    blocks = ",\n".join(f"{n} AS ({CTES[n]})" for n in reversed(needed))
    return f"WITH {blocks}\n{select}" if blocks else select


def _uses(text: str, name: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").split()
    return any(a in ("FROM", "JOIN") and b == name for a, b in zip(words, words[1:]))


_CITIES = """
    SELECT c_custkey, city, {result} AS result FROM (
        SELECT c_custkey, c_mktsegment, c_nationkey % 5 AS k,
               CASE c_nationkey % 5 WHEN 0 THEN '台北市' || c_mktsegment
                    WHEN 1 THEN '於新竹縣' || c_mktsegment WHEN 2 THEN ' 遠端' || c_mktsegment
                    WHEN 3 THEN c_mktsegment ELSE '' END AS city
        FROM customer)"""

_TOPIC = "|".join(TOPIC_WORDS)

REPOSTED = """
        SELECT *, coalesce(substr(posted_date, 1, 7), substr(fetched_at, 1, 7)) AS month
        FROM (SELECT * REPLACE (
                  CASE WHEN source = 'f' THEN 'again ' || title ELSE title END AS title,
                  CASE WHEN source = 'f' THEN strftime(CAST(posted_date AS DATE) + INTERVAL 1 MONTH, '%Y-%m-%d') ELSE posted_date END AS posted_date,
                  CASE WHEN source = 'f' THEN strftime(CAST(fetched_at AS DATE) + INTERVAL 1 MONTH, '%Y-%m-%d') ELSE fetched_at END AS fetched_at)
              FROM postings)"""

SELECTS: dict[str, str] = {
    "bronze_scan": "SELECT * FROM postings",
    "bronze_landing": """
        SELECT * REPLACE (CASE WHEN source = 'f' THEN upper(reverse(title)) ELSE title END AS title,
                          CASE WHEN source = 'f' THEN fetched_at || 'T01' ELSE fetched_at END
                              AS fetched_at)
        FROM postings""",
    "bronze_merge": REPOSTED,
    "bronze_intake": REPOSTED,
    "silver_roundtrip": "SELECT * FROM cleaned",
    "mart_sink": "SELECT * FROM benchmark",
    "mart_sink_monthly": "SELECT * FROM monthly",
    "mart_sink_overview": "SELECT * FROM overview",
    "mart_sink_kpi": "SELECT * FROM kpi",
    "stage_counts": """
        SELECT 'cleaned' AS stage, count(*) AS n_rows FROM cleaned
        UNION ALL SELECT 'deduplicated', count(*) FROM deduped
        UNION ALL SELECT 'with_pay', count(salary_monthly_mid) FROM norm
        UNION ALL SELECT 'skill_rows', count(*) FROM skills
        UNION ALL SELECT 'distinct_skills', count(DISTINCT skill) FROM skills""",
    "conform": "SELECT * FROM postings",
    "parse_flat": "SELECT * FROM flat",
    "parse_nested": "SELECT * FROM nested",
    "parse_flat_json": "SELECT * FROM flat",
    "parse_nested_json": "SELECT * FROM nested",
    "union_sources": "SELECT * FROM parsed",
    "topic_filter": f"""
        SELECT title, category, name2 AS subcategory, url
        FROM (SELECT *, CASE WHEN regexp_extract(url, '(\\d+)$', 1)::BIGINT % 8 = 0
                             THEN '雲端服務' ELSE '其他' END AS name2 FROM flat )
        WHERE regexp_matches(title || ' ' || category || ' ' || name2, '(?i)({_TOPIC})')""",
    "record_cap": "SELECT * FROM parsed ORDER BY source, job_id LIMIT 1500",
    "upsert_latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY event_type, user_id
                                         ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "upsert_located": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY event_type, user_id
                                         ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "parse_number": """
        SELECT c_custkey,
               CASE WHEN c_acctbal > 0 THEN c_acctbal END AS with_commas,
               CASE WHEN c_acctbal > 0 AND c_acctbal < 1000 THEN c_acctbal END AS without_commas,
               CASE WHEN c_acctbal >= 1 THEN CAST(floor(c_acctbal) AS INTEGER) END AS whole,
               CAST(NULL AS DOUBLE) AS not_a_number
        FROM customer""",
    "city_prefix": _CITIES.format(
        result="""CASE k WHEN 0 THEN '台北市' WHEN 1 THEN '於新竹縣' WHEN 2 THEN trim(city)
                  WHEN 3 THEN city END"""
    ),
    "region_extract": _CITIES.format(
        result="""coalesce(nullif(regexp_extract(city, '(遠端|.{{2,3}}?[市縣])', 1), ''), '其他')"""
    ).replace("{{", "{").replace("}}", "}"),
    "iso_date": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS compact,
               CAST(NULL AS VARCHAR) AS slashed,
               strftime(o_orderdate, '%Y-%m-%d') AS slashed_digits
        FROM orders""",
    "url_id": """
        SELECT page_id, param, coalesce(param, md5(url)) AS id,
               coalesce(param, CAST(('0x' || substr(md5('t' || url), 1, 15))::BIGINT % 10000000000
                                    AS VARCHAR)) AS short_id
        FROM (SELECT *, nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS param FROM pages)""",
    "pay_unit": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 7 = 0 THEN 'piece' WHEN o_orderstatus = 'F' THEN 'month'
                    WHEN o_orderstatus = 'O' THEN 'year' ELSE 'negotiable' END AS from_label,
               CASE WHEN o_orderkey % 7 <> 0 AND o_orderstatus NOT IN ('F', 'O')
                    THEN 'negotiable' END AS from_longer_label,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'month'
                    WHEN o_orderstatus = 'O' THEN 'year' ELSE 'negotiable' END AS from_text
        FROM orders""",
    "join_parts": 'SELECT job_id, requirements FROM payload',
    "scrub_pii": rf"""
        SELECT doc_id, regexp_replace({_scrubbed('text')}, '\(\d{{3}}\) \d{{3}}-\d{{4}}',
                                      '[phone-removed]', 'g') AS text
        FROM documents""",
    "bronze_key": """
        SELECT source || '/' || source || '-' || job_id AS bronze_key,
               source || '-' || job_id AS uid FROM postings""",
    "year_month": "SELECT job_id, year_month FROM cleaned",
    "bucket_rules": """
        SELECT job_id, seniority,
               CASE WHEN years >= 5 THEN 'senior' WHEN years >= 2 THEN 'mid' ELSE 'junior' END
                   AS by_years
        FROM (SELECT *, CAST(job_id AS BIGINT) % 13 AS years FROM cleaned )""",
    "full_text": "SELECT job_id, full_text FROM cleaned",
    "clean": "SELECT * FROM cleaned",
    "pay_monthly": f"""
        SELECT job_id, {_monthly('salary_min')} AS monthly_min,
               {_monthly('salary_max')} AS monthly_max FROM postings""",
    "pay_norm": f"""
        SELECT source, job_id, salary_monthly_min, salary_monthly_max, salary_monthly_mid
        FROM ({_with_pay('cleaned ')})""",
    "dedup_latest": "SELECT * FROM deduped",
    "dedup_located": "SELECT * FROM deduped",
    "dedup_seen": """
        SELECT company, title, region, first_seen, last_seen, times_seen FROM deduped""",
    "term_match": f"""
        SELECT source, job_id, {_term_list(PART_TREE, 'full_text', PART_SUBSTRINGS)} AS skills FROM cleaned""",
    "term_match_documents": f"""
        SELECT doc_id, lang, {_term_list(LANGUAGE_TREE, 'lowered')} AS terms
        FROM (SELECT doc_id, lang, lower(text) AS lowered FROM documents)""",
    "term_match_join": """
        WITH lowered_docs AS (SELECT doc_id, lower(text) AS t FROM documents),
        pairs AS (SELECT DISTINCT unnest(regexp_extract_all(t, '[a-z0-9]+ [a-z0-9]+')) AS alias FROM lowered_docs),
        parts AS (SELECT DISTINCT unnest(regexp_extract_all(t, '[a-z][éñçßäöüó][a-z]')) AS alias FROM lowered_docs),
        split AS (SELECT doc_id, regexp_extract_all(t, '[a-z0-9]+|[^a-z0-9]+') AS k FROM lowered_docs),
        beside AS (SELECT DISTINCT doc_id, k[i] || ' ' || k[i + 2] AS alias
                   FROM (SELECT doc_id, k, unnest(range(1, len(k) - 1)) AS i FROM split) WHERE k[i + 1] = ' '),
        found AS (SELECT doc_id, alias AS skill FROM beside SEMI JOIN pairs USING (alias)
                  UNION ALL SELECT doc_id, 'part ' || alias FROM lowered_docs JOIN parts ON contains(t, alias))
        SELECT doc_id, CAST(count(skill) AS INT) AS n_terms, md5(coalesce(string_agg(skill, ',' ORDER BY skill), '')) AS terms_md5
        FROM lowered_docs LEFT JOIN found USING (doc_id) GROUP BY doc_id""",
    "term_extract": "SELECT * FROM skills",
    "demand_monthly": "SELECT * FROM monthly",
    "skill_totals": "SELECT * FROM totals",
    "demand_bitmap": """
        SELECT skill, max(category) AS category, year_month, false AS is_total, count(DISTINCT concat_ws('-', source, job_id)) AS postings
        FROM skills GROUP BY skill, year_month
        UNION ALL SELECT skill, category, NULL, true, total_postings FROM totals""",
    "mom_change": "SELECT * FROM mom",
    "mom_change_calendar": _mom(
        """(SELECT p.postings FROM monthly AS p WHERE p.skill = monthly.skill
            AND p.year_month = strftime(
                CAST(monthly.year_month || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m'))"""
    ),
    "skill_overview": "SELECT * FROM overview",
    "pay_percentiles": _percentiles("skill, region, seniority", "skill, region, seniority"),
    "pay_percentiles_sketch": _percentiles("skill, region, seniority", "skill, region, seniority"),
    "salary_benchmark": "SELECT * FROM benchmark",
    "salary_benchmark_merged": "SELECT * FROM benchmark",
    "regions_benchmark": "SELECT * FROM sparse_benchmark",
    "sparse_kpi": "SELECT * FROM sparse_kpi",
    "market_kpi": "SELECT * FROM kpi",
    "feed_skills": """
        SELECT * FROM overview WHERE category = 'product'
        ORDER BY total_postings DESC, skill LIMIT 100""",
    "feed_trending": """
        SELECT * FROM overview WHERE mom_pct IS NOT NULL AND total_postings >= 5
        ORDER BY mom_pct DESC, skill LIMIT 10""",
    "feed_trend": """
        SELECT year_month, postings FROM monthly WHERE skill = 'red-widget' ORDER BY year_month""",
    "feed_salary": """
        SELECT * FROM benchmark WHERE region = 'ALL' AND seniority = 'senior'
        ORDER BY p50 DESC NULLS LAST, skill LIMIT 100""",
    "feed_kpi": "SELECT metric, value FROM kpi ORDER BY metric",
    "skill_medians": """
        SELECT skill, p50 FROM benchmark WHERE region = 'ALL' AND seniority = 'ALL'
        AND skill IN ('widget', 'red', 'any-idget', 'none')""",
    "trend_pivot": """
        SELECT year_month, max(postings) FILTER (skill = 'widget') AS widget,
               max(postings) FILTER (skill = 'red') AS red,
               max(postings) FILTER (skill = 'bolt') AS bolt
        FROM monthly WHERE skill IN ('widget', 'red', 'bolt') GROUP BY year_month""",
}

ORACLES = {name: _sql(select) for name, select in SELECTS.items()}
