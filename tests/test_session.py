from __future__ import annotations

import time
from pathlib import Path
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from shelfwise import session
from shelfwise.sources import sinks
from shelfwise.sources.versions import VersionedTable


def fake(master, configured=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: configured),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_the_cluster_names_the_work_folder():
    assert session.work_root(fake("yarn", "s3a://bucket/work/")) == "s3a://bucket/work"


def test_a_cluster_without_one_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(fake("spark://host:7077"))


def test_a_local_master_gets_a_folder_of_its_own():
    first = session.work_root(fake("local[2]"))
    assert first == session.work_root(fake("local[2]"))


def test_written_keeps_schema_and_rows(spark):
    df = spark.range(10).selectExpr("id", "cast(id % 2 as int) as part", "'x' as s")
    back = session.written(df, "t", "part")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_many_writers_restores_the_setting(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), session.many_writers(spark):
        assert spark.conf.get(name) == "false"
        raise ValueError
    assert spark.conf.get(name) == before


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def left_by(spark, write):
    """Shuffle files that ``write`` leaves; they may go a moment after it."""
    before, end = shuffle_files(spark), time.monotonic() + 20
    write()
    while (left := shuffle_files(spark) - before) and time.monotonic() < end:
        time.sleep(0.2)
    return left


def test_writes_leave_no_shuffle_files(spark, folder):
    df = spark.range(1000).selectExpr("cast(id as string) as k", "cast(id % 3 as string) as day")
    dealt = df.repartition(4, "k").groupBy("k").agg(F.max("day").alias("day"))
    table = VersionedTable(spark, f"{folder}/t")
    assert not left_by(spark, lambda: session.stored(dealt, "t"))
    assert not left_by(spark, lambda: table.replace(dealt, "day"))
    assert not left_by(spark, lambda: table.append(dealt, area="other"))
    assert not left_by(spark, lambda: sinks.write_partitioned(dealt, f"{folder}/csv", "day"))
    assert not left_by(spark, lambda: sinks.write_current_state(dealt, f"{folder}/now"))
    # What shares a plan with a write can be read after it, and read twice.
    assert dealt.count() == 1000 and len(dealt.collect()) == 1000 == len(dealt.collect())


def test_rows_stored_meanwhile_are_gone_after(spark):
    df = spark.range(10).selectExpr("id", "'x' as s").repartition(3)
    with session.stored_meanwhile(df, "t") as rows:
        assert rows.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, df.collect()))
        path = Path(urlparse(rows.inputFiles()[0]).path).parent
        assert path.exists()
    assert not path.exists()
    with pytest.raises(ValueError), session.stored_meanwhile(df, "t") as rows:
        path = Path(urlparse(rows.inputFiles()[0]).path).parent
        raise ValueError
    assert not path.exists()
