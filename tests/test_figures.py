"""The commit log at any length, and running figures that change only where a batch has rows."""

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.aggregate import price_stats
from millrace.sources.versions import BucketedTable, CommitLog
from millrace.streaming.figures import RunningStats

SYMBOL = T.StructField("symbol", T.StringType())


def test_one_line_is_read_however_many_commits_there_are(spark, folder):
    log = CommitLog(spark, folder("log"))
    assert log.state().seq == -1 and not log.state(batch="b0").done and not log.has("write")
    for seq in range(103):
        log.note(seq, "odd" if seq % 2 else "even", version=None if seq == 102 else seq, batch=f"b{seq}")
    state = log.state("even", "b4")
    assert (state.seq, state.newest, state.current, state.last_alive, state.done) == (102, 101, None, 101, True)
    assert len(spark.read.text(log.newest_folder()).inputFiles()) == 1
    assert not log.state("odd", "b4").done and not log.state(batch="b103").done and log.state(batch="b102").done
    assert log.has("odd") and not log.has("drop") and log.read().count() == 103


def test_a_line_that_was_broken_off_does_not_count(spark, folder):
    log = CommitLog(spark, folder("log"))
    log.note(0, "write", version=0, batch="a")
    Path(log._line_folder(1), "_temporary").mkdir(parents=True)
    assert log.state().seq == 0
    # a mark without its line, then another batch takes the number
    spark.createDataFrame([(1, "write", "lost", "x")], CommitLog.MARK).write.json(log._mark_folder("lost"))
    log.note(1, "write", version=1, batch="b")
    assert not log.state(batch="lost").done and log.state(batch="b").done and log.state(batch="a").done


def test_a_batch_touches_its_own_buckets_and_counts_once(spark, folder):
    ticks = spark.range(40_000).select(F.concat(F.lit("s"), F.col("id") % 10_000).alias("symbol"), (F.col("id") / 100).alias("price"))
    stats = RunningStats(spark, folder("stats"), SYMBOL, "price", buckets=4)
    stats.add(ticks, "one")
    before = stats.table.log.state().places
    more = spark.createDataFrame([("s7", 900.25), ("s7", None)], "symbol string, price double")
    for _ in range(2):  # the second is a repeated batch
        stats.add(more, "two")
    after = stats.table.log.state().places
    assert sum(a != b for a, b in zip(before, after, strict=True)) == 1
    assert rows(stats.read()) == rows(price_stats(ticks.unionByName(more), "symbol", "price", digits=2))
    stats.add(more.where("false"), "three")
    assert stats.table.log.state().places == after


def test_null_keys_hot_keys_and_a_crash(spark, folder):
    ticks = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").alias("symbol"), (F.col("id") / 4).alias("price"))
    stats = RunningStats(spark, folder("stats"), SYMBOL, "price", buckets=2)
    assert stats.read().isEmpty()
    note = stats.table.log.note

    def lost(*_, **__):
        raise OSError("lost the driver")

    stats.table.log.note = lost
    with pytest.raises(OSError):
        stats.add(ticks, "one")
    stats.table.log.note = note
    for _ in range(2):
        stats.add(ticks, "one")
    assert rows(stats.read()) == rows(price_stats(ticks, "symbol", "price", digits=2))
    again = RunningStats(spark, folder("stats"), SYMBOL, "price", buckets=2)
    assert rows(again.read()) == rows(stats.read())


def test_a_repeated_batch_of_a_bucketed_table_is_left_out(spark, folder):
    df = spark.range(10).select("id", F.lit(1).alias("n"))
    table = BucketedTable(spark, folder("t"), df.schema, ["id"], 2)
    table.replace(df)
    for _ in range(2):
        table.change(df, lambda old: old.withColumn("n", F.col("n") + 1), "b")
    assert {r.n for r in table.read().collect()} == {2}
