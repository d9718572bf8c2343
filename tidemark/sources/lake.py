"""Landing table, current table, silver tables and mart sink.

The landing table is append-only and partitioned by source. A key written again is one more row,
and the latest row of a key is the posting (`scan_bronze`), so a landing never rewrites what is
there and a failed job leaves nothing half replaced. `compact_bronze` writes the latest rows to a
new place. No write repartitions by source: a source may hold most of the rows.

The current table holds the latest row of each key by month, and updates rewrite only the months they
touch (`merge_current`). `intake` lands files that are new in a folder, each once, and brings them into
the current table.
"""

from __future__ import annotations

import functools
import os
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.text import year_month
from tidemark.operators.conform import conform
from tidemark.operators.latest import latest_located, latest_version

ROWS_PER_FILE = 5_000_000


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: the session's spark.checkpoint.dir. Where that is unset, a session
    on one machine gets a temporary folder, one per process; a cluster has no folder to guess."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _temporary_folder()


@functools.cache
def _temporary_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is not in use."""
    return os.path.join(shared_folder(spark), f"{name}-{os.urandom(8).hex()}")


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write the frame to the shared folder and read it back, for a plan that uses it more than
    once. The table outlives executors, and later uses read only the columns they need. `by` is a last
    column by whose values it is laid out in folders."""
    path = new_folder(df.sparkSession, name)
    if (scope := _SCOPE.get()) is not None:
        scope.paths.add(path)
    (df.write if by is None else df.write.partitionBy(by)).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def _place(spark: SparkSession, path: str):
    """(file system, path) in whatever store the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    store, where = _place(spark, path)
    store.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _place(spark, path)
    return store.exists(where)


class Scratch:
    """The staged tables of one operator."""

    def __init__(self, spark: SparkSession, outer: Scratch | None):
        self.spark, self.outer, self.paths = spark, outer, set()

    def drop(self, *tables: DataFrame) -> None:
        """Remove staged tables that nothing will read again."""
        for path in {t.staged_path for t in tables} & self.paths:
            remove(self.spark, path)
            self.paths.discard(path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """The frame as a staged table that outlives this scope: what the operator returns."""
        table = staged(df, name)
        self.paths.discard(table.staged_path)
        if self.outer is not None:
            self.outer.paths.add(table.staged_path)
        return table


_SCOPE: ContextVar[Scratch | None] = ContextVar("scratch", default=None)
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A scope that removes its staged tables at the end, also after a failure, and lets each query in
    it release its shuffle files once it is done. Only what is passed to `keep` stays, so a frame that
    still reads a staged table must not leave the scope unkept. While a query runs its files are all
    there, and later queries read finished tables, so a lost executor needs nothing that was removed."""
    scope, before = Scratch(spark, _SCOPE.get()), spark.conf.get(RELEASE, "false")
    token = _SCOPE.set(scope)
    spark.conf.set(RELEASE, "true")
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        spark.conf.set(RELEASE, before)
        for path in scope.paths:
            remove(spark, path)


# Landing

def land_bronze(postings: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append postings to the landing table, as Parquet or JSON lines."""
    writer = conform(postings).write.mode("append").partitionBy("source").format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).save(path)


def scan_bronze(
    spark: SparkSession, path: str, fmt: str = "parquet", latest: bool = True
) -> DataFrame:
    """Postings of a landing table: the latest row of each key, or all rows."""
    rows = conform(spark.read.schema(schemas.POSTING).format(fmt).load(path))
    if not latest:
        return rows
    return latest_located(rows) if fmt == "parquet" else latest_version(rows)


def scan_bronze_objects(spark: SparkSession, glob: str) -> DataFrame:
    """Postings kept as one JSON object per file (``<source>/<source>-<id>.json``). The path holds
    the key, so a key occurs once."""
    return conform(spark.read.schema(schemas.POSTING).option("multiLine", True).json(glob))


def compact_bronze(spark: SparkSession, path: str, target: str, fmt: str = "parquet") -> None:
    """Write the latest row of each key to a new landing table."""
    land_bronze(scan_bronze(spark, path, fmt), target, fmt)


# Current table

MONTH = "month"
#: Month of a posting without a date.
NO_MONTH = "none"


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The current postings and their month, by which folders are pruned."""
    return spark.read.schema(T.StructType([*schemas.POSTING, T.StructField(MONTH, T.StringType())])).parquet(path)


#: Rows of a month that one task merges and writes.
ROWS_PER_PART = 1 << 18


def merge_current(updates: DataFrame, path: str, key: tuple[str, ...] = ("source", "job_id"), order: tuple[str, ...] = ("fetched_at",)) -> list[str]:
    """Bring updates into the table of current postings at `path`, made if it is not there, and return the
    months that were written. The latest row of a key stays, an update before an existing row of its time.

    Months are touched by an update that is not older than the rows of its key, and by the rows that it replaces;
    both are found by keys, order and month alone. Only these months are read whole and written again, and whole
    rows are shuffled once, by month: a key that changes its month leaves a mark there that its row is gone.
    Rows without a key are left out. The merged months are staged before the table is written: a merge that fails
    can be run again, and a merge that is run again changes nothing.
    """
    spark = updates.sparkSession
    with scratch(spark):
        month = F.coalesce(year_month(F.col("posted_date"), F.col("fetched_at")), F.lit(NO_MONTH))
        rows = conform(updates).where(" AND ".join(f"{k} IS NOT NULL" for k in key))
        new = latest_version(rows, key, order).withColumn(MONTH, month)
        if not exists(spark, path):
            # Months are rebalanced, so that a large one becomes several files and a small one a single file.
            _overwrite_months(new.hint("rebalance", MONTH), path)
            return sorted(r[0] for r in read_current(spark, path).select(MONTH).distinct().collect())
        new = staged(new, "updates")
        met = staged(_met(read_current(spark, path), new, key, order), "met")
        months = _touched(new, met)
        old = read_current(spark, path).where(F.col(MONTH).isin(months))
        merged = staged(_merged(old, new.where(F.col(MONTH).isin(months)), met, key, order), "merged", MONTH)
        _overwrite_months(merged, path)
        left = {r[0] for r in merged.select(MONTH).distinct().collect()}
        for gone in set(months) - left:
            remove(spark, os.path.join(path, f"{MONTH}={gone}"))
    return sorted(months)


def _overwrite_months(rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(MONTH).parquet(path)


def _met(old: DataFrame, new: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Keys that the table and the updates hold: their latest row's order, `_new` and month, the update's month
    and the months of the table's rows. These are several only after a merge that failed."""
    rank = F.struct(*order, F.lit(0).alias("_new"), MONTH)
    update = new.select(*key, F.struct(*order, F.lit(1).alias("_new"), MONTH).alias("_update"))
    both = old.select(*key, rank.alias("_held")).join(update, list(key)).groupBy(*key)
    found = both.agg(F.greatest(F.max("_held"), F.max("_update")).alias("_best"), F.max("_update").alias("_update"), F.collect_set(f"_held.{MONTH}").alias("held"))
    return found.select(*key, "_best", F.col(f"_update.{MONTH}").alias("arrives"), "held")


def _touched(new: DataFrame, met: DataFrame) -> list[str]:
    """Months that an update comes into, and those with a row that is no longer the latest of its key."""
    late = met.where("_best._new = 0").select(F.col("arrives").alias(MONTH), F.lit(-1).alias("n"))
    comes = new.select(MONTH, F.lit(1).alias("n")).unionByName(late).groupBy(MONTH).agg(F.sum("n").alias("n")).where("n > 0")
    goes = met.select("_best", F.explode("held").alias(MONTH)).where(f"_best._new = 1 OR _best.{MONTH} <> {MONTH}")
    return [r[0] for r in comes.select(MONTH).union(goes.select(MONTH)).distinct().collect()]


def _merged(old: DataFrame, new: DataFrame, met: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The latest row of each key in the months of `old` and `new`. A key whose latest row is in another month is
    marked as gone by a row without content that outranks what is there."""
    spark, rank = old.sparkSession, [*order, "_new", "_gone"]
    at = F.explode(F.array_distinct(F.concat("held", F.array("arrives")))).alias(MONTH)
    gone = met.select(*key, "_best", at).where(f"_best.{MONTH} <> {MONTH}")
    gone = gone.select(*key, MONTH, *[F.col(f"_best.{c}").alias(c) for c in order if c not in key], F.lit(1).alias("_new"), F.lit(1).alias("_gone"))
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1))).withColumn("_gone", F.lit(0))
    sizes = old.select(MONTH).unionByName(new.select(MONTH)).groupBy(MONTH).agg(F.ceil(F.count("*") / ROWS_PER_PART).cast("int").alias("_parts"))
    sizes = F.broadcast(spark.createDataFrame([tuple(r) for r in sizes.collect()], f"{MONTH} string, _parts int"))
    dealt = rows.unionByName(gone, allowMissingColumns=True).join(sizes, MONTH).withColumn("_part", F.pmod(F.xxhash64(*key), "_parts"))
    row = F.struct(*rank, *[c for c in old.columns if c not in order])
    best = dealt.repartition(MONTH, "_part").groupBy(MONTH, "_part", *key).agg(F.max(row).alias("_row"))
    return best.where("_row._gone = 0").select(*[F.col(f"_row.`{c}`").alias(c) for c in old.columns])


# Intake

def land_new_files(spark: SparkSession, source: str, bronze: str, checkpoint: str, fmt: str = "json", files_per_batch: int | None = None) -> None:
    """Land the postings of files under `source` that were not landed before, and return when there are
    none left. The checkpoint holds which files a batch is made of, and the landing table's log which
    batches are whole: a batch that fails is run again and what it left is not seen by readers."""
    reader = spark.readStream.schema(schemas.POSTING).format(fmt)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    landing = conform(reader.load(source)).writeStream.format("parquet").partitionBy("source")
    query = landing.option("path", bronze).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def merge_landed(spark: SparkSession, bronze: str, current: str) -> list[str]:
    """Bring landed files into the current table that were not merged before; the months written. The
    names of merged files are kept beside the table, written after the merge: a file is merged again
    after a failure, which changes nothing, and is never left out."""
    ledger = current.rstrip("/") + "-merged-files"
    files = spark.createDataFrame([(f,) for f in spark.read.parquet(bronze).inputFiles()], "file string")
    if exists(spark, ledger):
        files = files.join(spark.read.schema("file string").parquet(ledger), "file", "left_anti")
    new = sorted(r.file for r in files.collect())
    if not new:
        return []
    months = merge_current(spark.read.schema(schemas.POSTING).option("basePath", bronze).parquet(*new), current)
    spark.createDataFrame([(f,) for f in new], "file string").coalesce(1).write.mode("append").parquet(ledger)
    return months


def intake(spark: SparkSession, source: str, root: str, fmt: str = "json", files_per_batch: int | None = None) -> list[str]:
    """New files under `source` to the landing table `root`/bronze and on to the current table
    `root`/current; the months written. Running it again, also after a failure in between, brings in
    what is new and nothing twice."""
    land_new_files(spark, source, os.path.join(root, "bronze"), os.path.join(root, "bronze-checkpoint"), fmt, files_per_batch)
    return merge_landed(spark, os.path.join(root, "bronze"), os.path.join(root, "current"))


# Silver

def write_silver(df: DataFrame, root: str, name: str) -> None:
    """Overwrite a silver table; adaptive execution sizes the files."""
    path = os.path.join(root, name)
    df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def read_silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, name))


# Marts

def check_mart(df: DataFrame, name: str) -> DataFrame:
    """The mart with its columns and types checked now, and its NOT NULL columns checked as the
    rows are written: a null there fails the job."""
    schema = schemas.MARTS[name]
    schemas.check_columns(df, schema, name)

    def column(field):
        if field.nullable:
            return F.col(field.name)
        missing = F.raise_error(F.lit(f"{name}.{field.name} is null"))
        return F.coalesce(F.col(field.name), missing.cast(field.dataType)).alias(field.name)

    return df.select([column(f) for f in schema])


#: The column each mart is looked up by.
LOOKUP = {"skill_demand_monthly": "skill", "skill_overview": "skill", "skill_salary_benchmark": "skill"}
#: Rows of a Parquet row group of a mart, so that a look-up reads few.
MART_GROUP_BYTES = 8 << 20


def for_lookup(df: DataFrame, column: str):
    """A writer of rows in ranges of the column, sorted, with a Bloom filter on it: a reader that wants one
    value skips files and row groups by their bounds, and the rest by the filter."""
    ordered = df.repartitionByRange(column).sortWithinPartitions(column)
    writer = ordered.write.mode("overwrite").option("parquet.block.size", MART_GROUP_BYTES)
    return writer.option(f"parquet.bloom.filter.enabled#{column}", True)


def write_mart(
    df: DataFrame,
    name: str,
    root: str | None = None,
    jdbc: Mapping[str, str] | None = None,
) -> None:
    """Overwrite a mart under `root` as Parquet, or in a database with the given JDBC options
    (url, user, password, driver, ...), where the table is truncated, not dropped, so that its
    definition and indexes stay."""
    if (root is None) == (jdbc is None):
        raise ValueError("give either root or jdbc")
    checked = check_mart(df, name)
    if jdbc is not None:
        checked.write.mode("overwrite").format("jdbc").options(**{**jdbc, "dbtable": name, "truncate": "true"}).save()
    elif name in LOOKUP:
        for_lookup(checked, LOOKUP[name]).parquet(os.path.join(root, name))
    else:
        checked.write.mode("overwrite").parquet(os.path.join(root, name))


# Versions of the marts

COMMITTED = "_COMMITTED"
KEPT_VERSIONS = 2


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """(number, whether it is whole) of the versions under `root`, in order."""
    store, where = _place(spark, os.path.join(root, "versions"))
    if not store.exists(where):
        return []
    names = [s.getPath().getName() for s in store.listStatus(where)]
    return sorted((int(n[1:]), exists(spark, os.path.join(root, "versions", n, COMMITTED))) for n in names if n.startswith("v"))


def version_path(root: str, number: int) -> str:
    return os.path.join(root, "versions", f"v{number:09d}")


def new_version(spark: SparkSession, root: str) -> int:
    """A version that no other writer has. Nobody reads it before `commit_version`."""
    number = max((n for n, _ in _versions(spark, root)), default=0) + 1
    while True:
        store, where = _place(spark, os.path.join(version_path(root, number), "_WRITER"))
        try:
            store.create(where, False).close()  # fails where the file is there
            return number
        except Exception as e:
            if not store.exists(where):
                raise e
            number += 1


def commit_version(spark: SparkSession, root: str, number: int, kept: int = KEPT_VERSIONS) -> None:
    """Make a version the one that is read: one file made at once, so readers see either all marts of
    this run or all of an earlier one. Whole versions before the last `kept` are removed, and what failed
    runs before them left."""
    store, where = _place(spark, os.path.join(version_path(root, number), COMMITTED))
    store.create(where, False).close()
    whole = [n for n, done in _versions(spark, root) if done]
    oldest = whole[-kept:][0]
    for n, _ in _versions(spark, root):
        if n < oldest:
            remove(spark, version_path(root, n))


def current_version(spark: SparkSession, root: str) -> int | None:
    """The version to read. Whoever reads several marts asks once and names it."""
    return max((n for n, done in _versions(spark, root) if done), default=None)


def read_mart(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A mart of the given version, or of the current one; without versions the mart under `root`."""
    version = current_version(spark, root) if version is None else version
    return spark.read.parquet(os.path.join(root if version is None else version_path(root, version), name))
