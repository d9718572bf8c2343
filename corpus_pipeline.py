"""A corpus from documents: quality rules, near duplicates, benchmark passages, source weights, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, ngram_join, quality_rules, token_shards
from tidemark.llm.queries import END_ID, TOKENIZER
from tidemark.llm.tables import table
from tidemark.sources.lake import staged

#: No stage but the first could be written in SQL, and not that one.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filter_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id. A null id is linked with nothing
    and stays; rows that repeat the smallest id stay."""
    found = ngram_join.jaccard_components(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. A finding is told by id and text, so rows that
    repeat an id, or have none, stay or go each by its own text."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    clean = found.where("NOT contaminated").select(F.col("doc_id").alias("clean_id"), F.col("h").alias("clean_h")).distinct()
    same = [F.col("doc_id").eqNullSafe(F.col("clean_id")), F.xxhash64("text") == F.col("clean_h")]
    return docs.join(clean, same, "left_semi")


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix of sources takes."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the shard files."""
    return token_shards.token_shards(docs, TOKENIZER, END_ID)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("source mixing", source_weights),
    ("token ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
