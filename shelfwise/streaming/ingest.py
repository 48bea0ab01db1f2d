"""Continuous landing of sale files: the nightly load, file by file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.incremental import DailyFact
from shelfwise.plans import marts, quarantine, staging
from shelfwise.session import stored as written
from shelfwise.sources.landing import file_headers, parse_by_header, text_lines
from shelfwise.sources.schemas import RAW_COLUMNS, RAW_PATHS
from shelfwise.sources.versions import VersionedTable


def sales_lines(spark: SparkSession, zone: str, files_per_trigger: int = 1000) -> DataFrame:
    """Lines of new sale files; each file is picked up exactly once, whole within a micro-batch."""
    source = (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        .text(f"{zone.rstrip('/')}/{RAW_PATHS['sales']}")
    )
    return text_lines(source, file_versions=True)


def batch_label(files: DataFrame) -> str:
    """A name for a set of files in one state: the same for a batch that is replayed, another one
    for any other files, also where a new checkpoint counts batches from 0 again."""
    mixed = files.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64("path", "size", "modified")), F.lit(0)).alias("hash"),
        F.coalesce(F.bit_xor(F.xxhash64(F.lit("second"), "path", "size", "modified")), F.lit(0))
        .alias("other"),
    ).first()
    return f"files-{mixed['n']}-{mixed['hash'] & (2**64 - 1):016x}{mixed['other'] & (2**64 - 1):016x}"


def load_batch(fact: DailyFact, rejected: VersionedTable, ledger: VersionedTable
               ) -> Callable[[DataFrame, int], None]:
    """Split one micro-batch, load both sides, and enter its files in the ledger.

    Valid rows replace rows with the same key, whatever their date; rejected rows are appended. Each
    of the three commits carries the batch's label, and a replayed batch skips those that are
    there: what a driver lost between two commits had not done yet is all that is done. The text is
    read twice, once for the first lines of its files and once for its rows, which are stored typed.
    """

    def load(lines: DataFrame, batch_id: int) -> None:
        files = written(file_headers(lines), "batch_files")
        label = batch_label(files)
        if ledger.has(label):
            return
        parsed = parse_by_header(lines, RAW_COLUMNS["sales"], headers=files.select("path", "line"))
        typed = staging.typed_sales(parsed)
        stored = written(typed.withColumn("is_valid", staging.sales_row_is_valid()), "batch_rows")
        valid, broken = (stored.filter(x).select(*typed.columns) for x in ("is_valid", "NOT is_valid"))
        fact.load(marts.fct_sales(valid), label, only_newer=False)
        if not rejected.has(label):
            rejected.append(quarantine.quarantine_sales(broken), label)
        entries = files.select(
            "path", "size", "modified", F.lit(batch_id).cast("long").alias("batch_id"),
            F.lit(fact.table.version().number).alias("fact_version"))
        ledger.append(entries, label)

    return load


def sales_tables(spark: SparkSession, root: str
                 ) -> tuple[DailyFact, VersionedTable, VersionedTable]:
    """The fact, the rejected rows and the ledger of a stream, below one folder."""
    fact = DailyFact(VersionedTable(spark, f"{root}/fct_sales"), sums=marts.daily_sums)
    return (fact, VersionedTable(spark, f"{root}/quarantine_sales"),
            VersionedTable(spark, f"{root}/files"))


def run_available(spark: SparkSession, zone: str, root: str, files_per_trigger: int = 1000
                  ) -> None:
    """Load every file not loaded before into the tables below ``root``, then stop."""
    query = (
        sales_lines(spark, zone, files_per_trigger)
        .writeStream.foreachBatch(load_batch(*sales_tables(spark, root)))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
