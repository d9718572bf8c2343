"""Forest and threshold come from all labelled rows, however many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as Q


@pytest.fixture(scope="module")
def labelled(spark):
    """24,000 rows with a label; every seventh is bad, and has more symbols."""
    bad = F.col("doc_id") % 7 == 0
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1000))
    rows = spark.range(0, 24_000, 1, 5).withColumnRenamed("id", "doc_id")
    return rows.select("doc_id", F.when(bad, 0).otherwise(1).alias("quality"), (50 + h).alias("n_words"), (300 + 5 * h + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(97))).alias("word_chars"),
                       F.when(bad, 5 + h % 59).otherwise(h % 11).cast("long").alias("n_symbols"), F.lit(0).cast("long").alias("n_dup_lines"), (h % 3).cast("long").alias("n_repeat_words"))


def local(labelled):
    rows = labelled.toPandas()
    stats = {n: rows[n].to_numpy() for n in Q.STATS}
    left = ~Q.base_failed(stats)
    return Q.features(stats)[left], rows["quality"].to_numpy()[left] == 0


def test_threshold_is_that_of_all_labelled_rows(labelled):
    forest = Q.train(labelled.drop("quality"), labelled.select("doc_id", "quality"))
    found, (x, bad) = forest.threshold, local(labelled)
    forest.threshold = np.inf
    assert len(bad) == 24_000 and forest.calibrated(forest.scores(x), bad).threshold == found < 1


def test_trees_draw_from_all_labelled_rows(labelled):
    drawn = Q._drawn(labelled.withColumn("n_dup_lines", F.col("doc_id")), 24_000)
    assert drawn.groupby("tree").size().tolist() == [Q.ROWS_PER_TREE] * Q.TREES
    assert not drawn.duplicated(["tree", "n_dup_lines"]).any()
    # 25,600 draws of 24,000 rows leave out 1 in e of them or so.
    assert abs(drawn["n_dup_lines"].nunique() / 24_000 - 0.66) < 0.03


def test_no_threshold_without_both_labels(labelled):
    for kept in ("quality = 0", "quality = 1"):
        assert Q._fit(labelled.where(kept)).threshold == np.inf
