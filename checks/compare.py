"""Run every query and its SQL on one scale factor and compare them row by row.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def session(cpus: str = "8", memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None when the query and the SQL give the same columns and rows."""
    columns = sorted(df.columns)
    expected = con.sql(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({sql})")
    if sorted(con.sql(sql).columns) != columns:
        return f"columns {columns} != {sorted(con.sql(sql).columns)}"
    got = Counter(tuple(r) for r in df.select([f"`{c}`" for c in columns]).collect())
    want = Counter(expected.fetchall())
    if got == want:
        return None
    extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
    return (
        f"{sum(got.values())} rows != {sum(want.values())}; {sum((got - want).values())} differ\n"
        f"   got  {str(extra)[:900]}\n   want {str(missing)[:900]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark, con, bad = session(), database(sf_dir), 0
    print("no SQL:", sorted(set(QUERIES) - set(ORACLES)), "no query:", sorted(set(ORACLES) - set(QUERIES)))
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), con, ORACLES[name])
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name}", problem or "", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
