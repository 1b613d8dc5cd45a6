"""Event-time windows with late rows, and change feeds with several readers."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.streaming.feed import ChangeFeed
from millrace.streaming.ingest import BATCH, STREAM, batch_sink, drain, file_sink, file_stream, write_batch
from millrace.streaming.windows import setting_late_aside, window_counts

TICK = "id bigint, at timestamp, k string"


def test_windows_late_rows_and_bounded_state(spark, folder):
    """Batches of an hour each; the last one brings a row for an hour long gone and one that is in time."""

    def land(minutes):
        made = spark.createDataFrame([(n, m) for n, m in enumerate(minutes)], "id long, m long")
        made.select("id", F.timestamp_seconds(F.col("m") * 60).alias("at"), F.lit("x").alias("k")).coalesce(1).write.mode("append").json(folder("landing"))
        drain(batch_sink(file_stream(spark, folder("landing"), TICK), setting_late_aside("at", "10 minutes", "30 minutes", folder("seen"))), folder("m1"))
        on_time = file_stream(spark, folder("seen/on_time"), f"{TICK}, {STREAM} string, {BATCH} bigint", "parquet")
        return drain(file_sink(window_counts(on_time, "at", ["k"], "10 minutes", "30 minutes"), folder("out")), folder("m2"))

    held = []
    for hour in range(4):
        query = land(range(hour * 60, hour * 60 + 60))
        held.append(query.lastProgress.stateOperators[0].numRowsTotal)
        assert all(p.stateOperators[0].numRowsDroppedByWatermark == 0 for p in query.recentProgress)
    # 24 windows so far, but only those of the last half hour stay in the state
    assert max(held) <= 4
    land([5, 215, 238, None])
    late = spark.read.schema(TICK).parquet(folder("seen/late"))
    assert rows(late.select(F.unix_seconds("at") / 60)) == [(5.0,), (None,)]
    found = spark.read.parquet(folder("out")).select((F.unix_seconds("window_start") / 60).cast("int").alias("m"), "n")
    # the greatest time is minute 239 (less 30: 209), so windows up to 200-210 are out, each once
    assert rows(found) == sorted([(m, 10) for m in range(0, 200, 10)], key=repr)


def test_repeated_batch_splits_as_before(spark, folder):
    write = setting_late_aside("at", "10 minutes", "0 minutes", folder("seen"))
    first = spark.sql("select 1L as id, timestamp_seconds(6000) as at, 'x' as k")
    second = spark.sql("select 2L as id, timestamp_seconds(60) as at, 'x' as k union all select 3L, timestamp_seconds(9000), 'x'")
    third = spark.sql("select 4L as id, timestamp_seconds(6060) as at, 'x' as k")
    for number, batch in [(0, first), (1, second), (1, second), (0, first), (2, third), (1, second)]:
        write(batch, number)
    read = {n: sorted(r.id for r in spark.read.parquet(folder(f"seen/{n}")).collect()) for n in ("on_time", "late")}
    assert read == {"on_time": [1, 3], "late": [2, 4]}


def test_readers_have_positions_of_their_own(spark, folder):
    schema = spark.createDataFrame([], "id long, action string, is_update boolean").schema
    feed = ChangeFeed(spark, folder("feed"), schema)

    def commit(number, first, last):
        feed.append(spark.range(first, last).select("id", F.lit("INSERT").alias("action"), F.lit(False).alias("is_update")), number)

    def seen(reader):
        return sorted(r.id for r in spark.read.parquet(folder(reader)).collect())

    def read_on(reader):
        feed.read_on(lambda df, n: write_batch(df, n, folder(reader)), folder(f"{reader}-at"))

    commit(0, 0, 5)
    read_on("a")
    commit(1, 5, 9)
    commit(1, 100, 200)  # a repeated commit is left alone
    failing = []

    def fails(df, n):
        write_batch(df, n, folder("a"))
        failing.append(n)
        raise OSError("after the write, before the position moved")

    with pytest.raises(Exception, match="before the position moved"):
        feed.read_on(fails, folder("a-at"))
    read_on("a")
    read_on("b")
    assert failing and seen("a") == seen("b") == list(range(9))
    read_on("b")
    commit(2, 9, 10)
    read_on("b")
    assert seen("a") == list(range(9)) and seen("b") == list(range(10))
