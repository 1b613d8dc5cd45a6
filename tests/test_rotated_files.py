"""Rotated files of many records: their order, the folders they lie in, and reading them back."""

import os
import random

import duckdb
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.plans.catalog import QUERIES
from millrace.streaming.bounded import until
from millrace.streaming.ingest import file_stream, keep_running
from millrace.streaming.rotation import folder_value, in_order, read_files, rotated, stateful_session, writing_files

FILES = "key string, file_no bigint, reason string, value string"
KEYS = ["a", "", None, "x=1/2:3", "50% [b] {c} ^#?*'\"\\", " end ", "tab\tline\n", "7", "a+b %2B", "%41"]


def test_full_files_keep_event_order_when_the_sort_by_key_spills(spark, folder):
    # runs of a spilled sort by key alone are merged in any order
    events = spark.range(5_000).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.element_at(F.array(F.lit("x"), F.lit("y"), F.lit(None).cast("string")), (F.col("id") % 11 % 3 + 1).cast("int")).alias("event_type"),
        F.lit(1.5).alias("value"), F.lit("{}").alias("props"),
    )
    events.coalesce(1).write.parquet(folder("events.parquet"))
    conf = spark._jvm.org.apache.spark.SparkEnv.get().conf()
    conf.set("spark.shuffle.spill.numElementsForceSpillThreshold", "150")
    try:
        found = rows(QUERIES["stream_rotation"].plan(spark, folder("")))
    finally:
        conf.remove("spark.shuffle.spill.numElementsForceSpillThreshold")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder('events.parquet')}/*.parquet'")
    expected = con.execute(f"SELECT id_sum, key, n_files, n_records, reason FROM ({QUERIES['stream_rotation'].sql})").fetchall()
    assert found == sorted(expected, key=repr)


@pytest.mark.parametrize("most", [1, 400, 5_000, 1 << 20])
def test_order_is_made_in_runs_on_disk(most):
    at = [random.Random(5).randrange(700) for _ in range(1_000)]
    parts = [pd.DataFrame({"at": at[k : k + 90], "value": [None if n == 3 else f"{n:03}" for n in at[k : k + 90]]}) for k in range(0, 1_000, 90)]
    assert [v for values in in_order(iter(parts), most) for v in values] == [None if n == 3 else f"{n:03}" for n in sorted(at)]
    assert list(in_order(iter([]), most)) == []


def test_order_reaches_over_files_and_a_null_comes_first(spark, folder):
    session = stateful_session(spark, partitions=2)
    numbers = spark.range(250).select(F.lit("a").alias("key"), F.col("id").cast("string").alias("value"))
    numbers.unionByName(spark.sql("SELECT 'a' AS key, 'none' AS value")).repartition(7, F.rand(1)).write.json(folder("landing"))
    stream = rotated(file_stream(session, folder("landing"), "key string, value string"), 100, 600.0, F.col("value").try_cast("bigint"))
    running = keep_running(stream.writeStream.foreachBatch(writing_files(folder("files"))), folder("mark"), every="300 milliseconds")
    until(session, running, messages=251)
    files = [[r.value for r in read_files(spark, folder("files")).where(F.col("file_no") == n).collect()] for n in (0, 1)]
    assert files == [["none", *map(str, range(99))], [str(n) for n in range(99, 199)]]


def _frame(spark, keys, texts):
    data = [(k, n, "size", f"{text} {k} {n} {i}") for text in texts for k in keys for n in range(3) for i in range(2)]
    return spark.createDataFrame([*data, *[(k, 3, "time", None) for k in keys]], FILES).coalesce(1)


def test_one_file_per_folder_and_a_repeated_batch_replaces_it(spark, folder):
    write = writing_files(folder("files"))
    old = _frame(spark, ["a", "b"], ["old"])
    old.write.partitionBy("key", "file_no").json(folder("files"))
    for text in ("first", "again"):
        write(_frame(spark, ["a", "b"], [text]), 0)
    write(spark.createDataFrame([], FILES), 1)
    assert rows(read_files(spark, folder("files"))) == rows(_frame(spark, ["a", "b"], ["again"]))
    assert [len(names) for at, _, names in os.walk(folder("files")) if "file_no=" in at] == [1] * 8
    write_none = writing_files(folder("none"))
    write_none(spark.createDataFrame([], FILES), 0)
    assert read_files(spark, folder("none")).count() == 0


def test_keys_of_any_text_are_read_back_as_from_sparks_writer(spark, folder):
    frame = _frame(spark, KEYS, ["text é \u2028 \"quoted\"\n"])
    frame.write.partitionBy("key", "file_no").json(folder("spark"))
    writing_files(folder("files"))(frame, 0)
    assert rows(read_files(spark, folder("files"))) == rows(spark.read.schema(FILES).json(folder("spark")))
    assert sorted(os.listdir(folder("files"))) == sorted(n for n in os.listdir(folder("spark")) if n.startswith("key="))
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    assert all(folder_value(chr(c), "utf-8") == escape(chr(c)) for c in range(1, 256))


def test_a_store_without_a_path_is_written_by_spark(spark, folder):
    os.makedirs(folder("files"))
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.rotation.link./in", f"file://{folder('files')}")
    frame = _frame(spark, ["a", None], ["text"])
    writing_files("viewfs://rotation/in/x")(frame, 0)
    assert rows(read_files(spark, "viewfs://rotation/in/x")) == rows(frame)


def test_rows_of_a_file_that_lie_apart_are_refused(spark, folder):
    with pytest.raises(Exception, match="lie apart"):
        writing_files(folder("files"))(_frame(spark, ["a"], ["one", "two"]), 0)


def test_listing_takes_few_tasks_and_leaves_the_session_as_it_was(spark, folder):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    writing_files(folder("files"))(spark.range(200).selectExpr("'a' AS key", "id AS file_no", "'size' AS reason", "'v' AS value").coalesce(1), 0)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        files = read_files(spark, folder("files"))
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism
    assert files.count() == 200 and spark.conf.get(name) == before
