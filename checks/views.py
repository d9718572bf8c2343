"""Posting frames derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.terms import SUBSTRING, Gazetteer
from tidemark.operators.terms import term_extract
from tidemark.plans.pipeline import postings_norm
from tidemark.sources import lake

FETCHED = "2024-02-01T00:00:00+00:00"

PART_TREE = {
    "product": {w: [w] for w in ("widget", "gear", "bolt", "ring", "anvil", "gizmo", "plate", "rod")},
    "trait": {w: [w] for w in ("red", "hot", "old")},
    "combo": {"red-widget": ["red widget"]},
    "fragment": {"any-idget": ["idget"]},
}
PART_SUBSTRINGS = {"idget"}
PART_TERMS = Gazetteer.from_mapping(PART_TREE, modes=dict.fromkeys(PART_SUBSTRINGS, SUBSTRING))

# Function words, phrases and letters that tell the languages of the documents apart.
LANGUAGE_TREE = {
    "en": {
        "en-article": ["the", "a", "an"],
        "en-pronoun": ["it", "this", "that", "they", "you", "she", "he", "we", "who", "which"],
        "en-verb": ["is", "was", "are", "were", "be", "been", "have", "has", "had", "do", "does"],
        "en-preposition": ["of", "to", "in", "for", "with", "from", "by", "on", "at", "into"],
        "en-link": ["and", "or", "but", "because", "while"],
        "en-phrase": ["of the", "in the", "to the", "on the", "for the", "with the", "and the",
                      "that the", "is the", "at the", "it is", "this is"],
    },
    "fr": {
        "fr-article": ["le", "la", "les", "une", "des"],
        "fr-pronoun": ["elle", "il", "nous", "vous", "qui", "que"],
        "fr-preposition": ["dans", "avec", "pour", "sur", "sans", "par"],
        "fr-link": ["et", "ou", "mais", "donc"],
        "fr-phrase": ["de la", "de les", "et la", "et les", "pour la", "dans le", "dans la"],
        "fr-letters": ["é", "è", "ê", "ç", "eaux", "où"],
    },
    "de": {
        "de-article": ["der", "die", "das", "ein", "eine"],
        "de-pronoun": ["ich", "wir", "sie", "ihr"],
        "de-preposition": ["mit", "von", "auf", "zu", "bei"],
        "de-link": ["und", "oder", "aber"],
        "de-phrase": ["in der", "und die", "von der", "auf die", "mit der", "zu der"],
        "de-letters": ["ß", "ä", "ö", "ü", "heiß"],
    },
    "es": {
        "es-article": ["el", "los", "las", "una", "uno"],
        "es-preposition": ["con", "para", "por", "sin"],
        "es-link": ["y", "pero", "como"],
        "es-phrase": ["en el", "de los", "con la", "para el", "por la"],
        "es-letters": ["ñ", "á", "í", "ó", "ú", "ción"],
    },
}
LANGUAGE_TERMS = Gazetteer.from_mapping(LANGUAGE_TREE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, description): the distinct part names of an order, sorted and joined. Names are
    gathered as sets in the tasks of the join, before the shuffle by order, so an order with very many
    lines is reduced there and the lines are shuffled once."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sold = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    names = F.sort_array(F.collect_set("p_name"))
    return sold.groupBy("l_orderkey").agg(F.array_join(names, " ").alias("description"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per order, with some of the posting columns; the rest are for conform to add."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    status = F.col("o_orderstatus")
    unit = (
        F.when(key % 11 == 0, "negotiable")
        .when(status == "F", "month")
        .when(status == "O", "year")
        .when(status == "P", "hour")
    )
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(order_texts(spark, sf_dir), key == F.col("l_orderkey"), "left")
    )
    return joined.select(
        F.lower(status).alias("source"),
        key.cast("string").alias("job_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("c_name").alias("company"),
        "description",
        F.col("c_mktsegment").alias("requirements"),
        F.when(key % 5 != 0, price).alias("salary_min"),
        F.when(key % 5 != 0, price * 1.2).alias("salary_max"),
        unit.alias("salary_type"),
        F.col("n_name").alias("city"),
        F.concat((key % 13).cast("string"), F.lit("年以上")).alias("experience"),
        F.when(key % 97 != 0, _iso(F.col("o_orderdate"))).alias("posted_date"),
        _iso(F.col("o_orderdate")).alias("fetched_at"),
    )


def reposted(postings: DataFrame) -> DataFrame:
    """Postings of one source, a month later and with another title."""
    day = F.to_date("fetched_at")
    later = {"title": F.concat(F.lit("again "), "title"), "posted_date": _iso(F.add_months(F.to_date("posted_date"), 1)), "fetched_at": _iso(F.add_months(day, 1))}
    return postings.filter("source = 'f'").withColumns(later)


def region() -> Column:
    """The view's cities are nations, so they are the regions too."""
    return F.col("city")


def corpus_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gazetteer as large as the corpus: (skill, alias) of pairs of words in the documents, and of a
    letter with an accent between two without."""
    text = F.lower("text")
    pairs = F.regexp_extract_all(text, F.lit("([a-z0-9]+ [a-z0-9]+)"), 1)
    parts = F.regexp_extract_all(text, F.lit("([a-z][éñçßäöüó][a-z])"), 1)
    # Only pairs have a space. Both come from one scan and are told apart in one shuffle.
    aliases = table(spark, sf_dir, "documents").select(F.explode(F.concat(pairs, parts)).alias("alias")).distinct()
    return aliases.select(F.when(F.contains("alias", F.lit(" ")), F.col("alias")).otherwise(F.concat(F.lit("part "), "alias")).alias("skill"), "alias")


def sparse_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings with city texts that the default region rule reads, and companies that are missing."""
    key = F.col("job_id").cast("long")
    city = (F.when(key % 5 == 0, F.concat(F.lit("台北市"), "city")).when(key % 5 == 1, F.concat(F.lit("於新竹縣"), "city"))
            .when(key % 5 == 2, F.lit("遠端")).when(key % 5 == 3, F.col("city")))
    return postings(spark, sf_dir).withColumns({"city": city, "company": F.when(key % 3 != 0, F.col("company"))})


def norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings_norm(postings(spark, sf_dir), region())


def skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_extract(norm(spark, sf_dir), PART_TERMS)


def flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the flat source, one per order: strings under suffixed keys."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    text = key.cast("string")
    person = F.col("o_custkey").cast("string")
    label = (
        F.when(key % 7 == 0, "論件計酬")
        .when(key % 13 == 0, " 時薪　")
        .when(F.col("o_orderstatus") == "F", "月薪")
        .when(F.col("o_orderstatus") == "O", "年薪")
        .otherwise("面議(P)")
    )
    city = (
        F.when(F.col("c_nationkey") % 4 == 0, "台北市信義區")
        .when(F.col("c_nationkey") % 4 == 1, "　新竹縣竹北市")
        .when(F.col("c_nationkey") % 4 == 2, "遠端信義區")
        .otherwise("")
    )
    columns = {
        "OCCU_DESC（職務名稱）": F.concat(
            F.when(key % 3 == 0, "Software Engineer ").otherwise("cook "), "o_orderpriority"
        ),
        "COMPNAME（公司名稱）": F.col("c_name"),
        "JOB_DETAIL（工作內容）": F.concat(
            F.lit("mail u"), person, F.lit("@example.com, call 02-2345-6789 or 0912-345-678, ref "), text
        ),
        "SALARYCD（核薪方式）": label,
        "NT_L（薪資範圍下限）": F.format_number(price, 2),
        "NT_U（薪資範圍上限）": F.when(key % 5 == 0, "0")
        .when(key % 6 == 0, "")
        .otherwise((price * 1.2).cast("string")),
        "CITYNAME（工作地點）": city,
        "JOB_PERSON（雇用人數）": (key % 6).cast("string"),
        "EDGRDESC（最低學歷要求）": F.when(key % 4 == 0, "").otherwise("大學"),
        "EXPERIENCE（工作經驗）": F.concat((key % 13).cast("string"), F.lit("年以上")),
        "WKTIME（工作時間）": F.when(key % 2 == 0, "日班"),
        "CJOB_NAME1（職務大類別名稱）": F.col("c_mktsegment"),
        "CJOB_NAME2（職務小類別名稱）": F.when(key % 8 == 0, "雲端服務").otherwise("其他"),
        "URL_QUERY（職缺資料URL）": F.concat(
            F.lit("https://jobs.example.com/d?E="), person,
            F.when(key % 10 == 0, "#HIRE_ID=").otherwise("&HIRE_ID="), text,
        ),
        "TRANDATE（職缺更新日期）": F.when(key % 97 == 0, "2024").otherwise(
            F.date_format("o_orderdate", "yyyyMMdd")
        ),
    }
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(*[c.alias(n) for n, c in columns.items()])


def nested_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of the nested source, one per turn of a conversation; the items are the lines of
    the turn's text."""
    conversations = table(spark, sf_dir, "conversations")
    turn, text = F.col("turn"), F.col("text")
    items = F.transform(
        F.split(text, "\n"),
        lambda line: F.struct(
            F.when(turn % 2 == 0, line).alias("description"), line.alias("name")
        ),
    )
    header = F.struct(
        F.col("role").alias("jobName"),
        F.concat(F.lit("conv "), F.col("conv_id").cast("string")).alias("custName"),
        F.concat(F.lit("2024/01/"), F.lpad((turn % 28 + 1).cast("string"), 2, "0")).alias("appearDate"),
    )
    detail = F.struct(
        text.alias("jobDescription"),
        F.when(turn % 3 == 0, "月薪4萬").when(turn % 3 == 1, "面議 月薪").otherwise("時薪200").alias("salary"),
        (turn * 10000).alias("salaryMin"),
        F.when(turn % 2 == 0, turn * 15000).alias("salaryMax"),
        F.when(turn % 2 == 0, "台中市").otherwise("").alias("addressRegion"),
        F.lit("高雄市").alias("jobAddrNoDesc"),
        turn.cast("string").alias("needEmp"),
        F.array(F.struct(F.col("role").alias("description"))).alias("jobCategory"),
    )
    condition = F.struct(
        F.concat(turn.cast("string"), F.lit("年")).alias("workExp"),
        F.when(turn % 2 == 1, "大學").otherwise("").alias("edu"),
        F.lit(None).cast("string").alias("major"),
        F.lit("").alias("other"),
        F.lit("英文 中等").alias("language"),
        items.alias("skill"),
        F.lit(None).cast("array<struct<description:string,name:string>>").alias("specialty"),
        F.array("role").alias("tools"),
    )
    return conversations.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string")).alias("jobId"),
        F.struct(
            header.alias("header"), detail.alias("jobDetail"), condition.alias("condition")
        ).alias("data"),
    )
