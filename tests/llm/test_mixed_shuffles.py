"""How often the mixed corpus shuffles texts."""

from pyspark.sql import functions as F

from tidemark.llm import mixing


def test_mixed_texts_are_shuffled_once(spark, documents):
    rows = [(i, f"w{i} a b c", "s") for i in range(30)] * 2 + [(None, "x y z", None), (None, "x y z", None), (3, "w3 a b c", None)]
    docs = documents(rows).withColumn("text", F.concat("text", F.lit(" d")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mixed = mixing.mixed_documents(docs)
        plan = mixed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
        got = {(r.doc_id, r.source) for r in mixed.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got <= {(r[0], r[2]) for r in rows}
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    at = next(i for i, line in enumerate(plan) if "ExistingRDD" in line or "Scan" in line and "text" in line)
    above, level = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if depth(line) < level:
            above, level = [*above, line], depth(line)
    assert sum("Exchange" in line for line in above) == 1
