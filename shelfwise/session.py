"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Applied only to sessions this package creates; a cluster's own settings are left alone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Listing many day folders: a few tasks that list many folders each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.ui.enabled": "false",
}

#: Files that a task that writes by day may have open at once.
OPEN_FILES = 16

_LOCAL_ROOTS: dict[str, str] = {}


def local_session(cpus: int | str = "*", app: str = "shelfwise", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; never used on a cluster."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {**DEFAULTS, "spark.sql.shuffle.partitions": "8", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it.

    A temporary folder is used only by a local master that names none: there every executor
    is the same process. Anywhere else an unset folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="shelfwise-")
    return _LOCAL_ROOTS[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared work folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage durably: a lost executor re-reads files and does not redo the joins.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``written`` for the warehouse: the shuffle files behind it go as soon as it is done."""
    with freed_shuffles(df.sparkSession):
        return written(df, label)


@contextmanager
def stored_meanwhile(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The rows of ``df`` from a folder that is deleted behind the block. For rows that are shuffled
    once more in it: the shuffle files that they come from are gone by then."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    with freed_shuffles(spark):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path).select(*df.columns)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """For Python tasks over long texts: hand them this many rows at once, so that neither side
    holds the texts of Spark's 10,000."""
    with _set(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}):
        yield


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """For writes: delete the shuffle files of each when it ends. Spark would keep them until the
    driver's garbage is collected, so those of all steps of a build would lie on disk together.
    """
    with _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """For writes by day from rows as they lie: a task of few days need not sort its rows by day."""
    with _set(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        yield


@contextmanager
def many_writers(spark: SparkSession) -> Iterator[None]:
    """For writes by day: let every shuffle partition write its own days.

    A day lies in one partition, or in several when adaptive execution splits a large one, so
    merging small partitions would not save a file; it would only queue them in one task.
    A task holds some days' files open at once, so its rows need not be sorted by day first; only
    a task with more days sorts the rest.
    """
    with _set(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}), open_files(spark):
        yield
