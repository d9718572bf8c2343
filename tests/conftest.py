import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session

    return session("4", "4g")


@pytest.fixture
def values(spark):
    """values(fn, [inputs]) -> results of the column function, one per input text."""
    from pyspark.sql import functions as F

    def run(fn, inputs, kind="string"):
        rows = [(i, v) for i, v in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]

    return run
