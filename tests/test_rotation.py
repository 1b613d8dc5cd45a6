"""Streams that end by themselves, and files closed by number or by age across batches and restarts."""

from conftest import rows
from pyspark.sql import functions as F

from millrace.streaming.bounded import until
from millrace.streaming.ingest import batch_sink, file_sink, file_stream, keep_running, rows_read
from millrace.streaming.rotation import rotated, stateful_session, writing_files

PAIR = "key string, value string"


def test_files_close_by_number_or_age_and_nothing_is_lost(spark, folder):
    session = stateful_session(spark, partitions=2)

    def land(key, first, last):
        values = spark.range(first, last).select(F.lit(key).cast("string").alias("key"), F.format_string("%04d", "id").alias("value"))
        values.coalesce(1).write.mode("append").json(folder("landing"))

    def start():
        out = batch_sink(rotated(file_stream(session, folder("landing"), PAIR), 100, seconds=20.0), writing_files(folder("files")))
        return keep_running(out, folder("mark"), every="300 milliseconds")

    def read():
        return spark.read.schema("reason string, value string, key string, file_no bigint").json(folder("files"))

    land("a", 0, 150)
    running = start()
    until(session, running, messages=150)
    # the stream dies with 50 records waiting
    running = start()
    try:
        land("a", 150, 210)
        until(session, running, messages=60)
    finally:
        running.stop()
    by_number = read().groupBy("file_no", "reason").count()
    assert rows(by_number) == [(100, 0, "size"), (100, 1, "size")]
    running = start()
    try:
        land("b", 0, 3)
        land(None, 0, 2)
        until(session, running, idle=24.0)
    finally:
        running.stop()
    found = rows(read().groupBy("key", "file_no", "reason").count().select("count", "file_no", "key", "reason"))
    assert found == sorted([(100, 0, "a", "size"), (100, 1, "a", "size"), (10, 2, "a", "time"), (3, 0, "b", "time"), (2, 0, None, "time")], key=repr)
    assert sorted(r.value for r in read().where("key = 'a'").collect()) == [f"{n:04}" for n in range(210)]


def test_stream_ends_when_idle_or_after_messages(spark, folder):
    spark.range(100).repartition(4).write.json(folder("landing"))

    def start():
        stream = file_stream(spark, folder("landing"), "id bigint", files_per_batch=1)
        return keep_running(file_sink(stream, folder("main")), folder("mark"), every="200 milliseconds")

    first = start()
    assert until(spark, first, messages=30) == "messages" and rows_read(first) >= 30 and not first.isActive
    second = start()
    assert until(spark, second, idle=1.5) == "idle" and not second.isActive
    assert sorted(r.id for r in spark.read.parquet(folder("main")).collect()) == list(range(100))
    third = start()
    third.stop()
    assert until(spark, third, idle=60) == "ended"
