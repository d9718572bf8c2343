"""Connected components of an edge table by alternating stars.

Every round turns the edges of each node towards the smallest neighbour, first for the larger
neighbours and then for the smaller ones, until each edge goes straight to the smallest node of its
component. A round is two group-bys with partial aggregates and joins back, so a node with very many
edges is no group in memory. Rounds grow with the logarithm of the longest path. Each round's edges
are a table in the shared folder: a lost executor costs a part of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.lake import scratch, staged

MAX_ROUNDS = 100


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    m = _smallest(both).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    m = _smallest(edges)
    turned = edges.join(m, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return turned.unionByName(m.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node it can be reached from.
    Loops, repeated edges, either direction and an empty table are fine; edges with a null are left out.
    """
    with scratch(edges.sparkSession) as scope:
        edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges, before = staged(edges.distinct(), "edges"), None
        for _ in range(MAX_ROUNDS):
            last, edges = edges, staged(_small_star(_large_star(edges)).where("a <> b").distinct(), "edges")
            scope.drop(last)
            sign = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
            if sign == before:
                break
            before = sign
        else:
            raise RuntimeError(f"no fixed point in {MAX_ROUNDS} rounds")
        roots = edges.select(F.col("b").alias("a"), "b").distinct()
        return scope.keep(edges.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("component")), "components")


def with_rivals(lists: DataFrame, key: str, percent: int) -> DataFrame:
    """Members (key, n, label, ...) of lists that hold another component's member of a size that may
    link. Sizes fall in classes as wide as the threshold, so a partner is in the same class or one beside it."""
    own = lists.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int"))
    held = own.groupBy(key, "class").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    beside = held.select(key, F.explode(F.expr("array(class - 1, class, class + 1)")).alias("class"), "low", "high")
    several = beside.groupBy(key, "class").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    return own.join(several.select(key, "class"), [key, "class"], "left_semi").drop("class")
