"""Streams: once-only ingest, retries, dead letters."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.aggregate import price_stats
from millrace.streaming.ingest import (
    batch_sink,
    decode,
    delivering,
    drain,
    file_sink,
    file_stream,
    first_messages,
    keep_running,
    newest_batch,
    quarantining,
    replacing,
    rows_read,
    sending,
    write_batch,
)

TICK = "id bigint, symbol string, price double"


@pytest.fixture
def land(spark, folder):
    def put(first, last):
        spark.range(first, last).select("id", F.concat(F.lit("s"), F.col("id") % 3).alias("symbol"), (F.col("id") / 4).alias("price")).write.mode("append").json(folder("landing"))

    return put


def test_second_run_adds_nothing(spark, folder, land):
    def run():
        return drain(file_sink(file_stream(spark, folder("landing"), TICK), folder("main")), folder("mark"))

    land(0, 10)
    assert rows_read(run()) == 10
    assert rows_read(run()) == 0
    land(10, 15)
    assert rows_read(run()) == 5
    assert spark.read.parquet(folder("main")).count() == 15


def test_flaky_target_is_tried_again(spark, folder, land):
    land(0, 10)
    tries = []

    def flaky(df, batch_no):
        tries.append(batch_no)
        if len(tries) < 3:
            raise OSError("try again")
        write_batch(df, batch_no, folder("main"))

    drain(batch_sink(file_stream(spark, folder("landing"), TICK), delivering(flaky, folder("dead"), pause=0.0)), folder("mark"))
    assert tries == [0, 0, 0] and spark.read.parquet(folder("main")).count() == 10


def test_dead_letters_keep_every_row(spark, folder, land):
    land(0, 10)

    def broken(df, batch_no):
        raise OSError("gone")

    drain(batch_sink(file_stream(spark, folder("landing"), TICK), delivering(broken, folder("dead"), pause=0.0)), folder("mark"))
    dead = spark.read.parquet(folder("dead"))
    assert dead.count() == 10 and rows(dead.select("error", "attempts").distinct()) == [(3, "OSError: gone")]


def test_only_the_bad_record_is_given_up(spark, folder, land):
    land(0, 10)

    def send(record):
        if record["id"] == 4:
            raise ValueError("x" * 1000)

    drain(batch_sink(file_stream(spark, folder("landing"), TICK), sending(send, folder("sent"), pause=0.0)), folder("mark"))
    sent = spark.read.parquet(folder("sent"))
    assert sent.where("error is null and attempts = 1").count() == 9
    assert [tuple(r) for r in sent.where("error is not null").select("id", "attempts", "error").collect()] == [(4, 3, "ValueError: " + "x" * 1000)]


def test_complete_figures_are_kept_twice_at_most(spark, folder):
    for n in range(5):
        replacing(folder("out"))(spark.range(3).withColumn("n", F.lit(n)), n)
    everything = spark.read.parquet(folder("out"))
    assert {r.n for r in everything.select("n").distinct().collect()} == {3, 4}
    assert newest_batch(spark, folder("out"), spark.range(1).withColumn("n", F.lit(1)).schema).select("n").distinct().first()[0] == 4


def test_repeated_batch_replaces_itself(spark, folder):
    for _ in range(2):
        write_batch(spark.range(5), 0, folder("main"))
    write_batch(spark.range(3), 1, folder("main"))
    assert spark.read.parquet(folder("main")).count() == 8


def test_stats_are_the_same_in_batch_and_stream(spark, folder, land):
    land(0, 50)
    land(50, 90)
    stats = price_stats(file_stream(spark, folder("landing"), TICK, files_per_batch=1), "symbol", "price")
    drain(batch_sink(stats, replacing(folder("out")), "complete"), folder("mark"))
    batch = price_stats(spark.read.schema(TICK).json(folder("landing")), "symbol", "price")
    assert rows(newest_batch(spark, folder("out"), stats.schema)) == rows(batch)


def test_quarantine_and_decode(spark, folder):
    messages = [("k", '{"id": 1, "symbol": "a", "price": 2.5}', 0, 10), ("k", '{"id": "x"}', 1, 11), ("k", "junk", 2, 12), (None, '{"id": 4}', 0, 13)]
    spark.createDataFrame(messages, "key string, value string, partition int, offset bigint").write.json(folder("topic"))
    stream = file_stream(spark, folder("topic"), "key string, value string, partition int, offset bigint")
    rules = {"unreadable": F.col("_corrupt_record").isNull(), "no price": F.col("price").isNotNull()}
    drain(batch_sink(decode(stream, TICK), quarantining(rules, folder("good"), folder("bad"))), folder("mark"))
    assert [(r.id, r.partition, r.offset) for r in spark.read.parquet(folder("good")).collect()] == [(1, 0, 10)]
    assert {(r.offset, r.reason) for r in spark.read.parquet(folder("bad")).collect()} == {(11, "unreadable"), (12, "unreadable"), (13, "no price")}
    assert rows(first_messages(spark.read.json(folder("topic")), 2, "offset").select("offset")) == [(10,), (11,)]


def test_timed_sink_bounds_records_per_file(spark, folder, land):
    land(0, 250)
    running = keep_running(file_sink(file_stream(spark, folder("landing"), TICK), folder("out"), "json", rows_per_file=100), folder("mark"), "1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    written = spark.read.schema(TICK).json(folder("out"))
    assert written.count() == 250
    assert written.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0] <= 100


def test_new_checkpoint_adds_to_what_is_there(spark, folder, land):
    def run(mark):
        drain(batch_sink(file_stream(spark, folder("landing"), TICK), lambda df, n: write_batch(df, n, folder("main"))), folder(mark))

    land(0, 10)
    run("first")
    land(10, 13)
    run("second")  # reads all 13 rows anew, as batch 0 of another stream
    run("second")
    assert spark.read.schema(TICK).parquet(folder("main")).count() == 10 + 13


def test_replay_of_a_table_in_parts(spark, tmp_path):
    from conftest import SF_DIR

    from millrace.plans.catalog import QUERIES

    events = spark.read.parquet(f"{SF_DIR}/events.parquet").limit(500).repartition(5)
    events.write.parquet(str(tmp_path / "events.parquet"))
    assert QUERIES["stream_replay"].plan(spark, str(tmp_path)).count() == 500
