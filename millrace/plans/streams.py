"""Streaming queries. Each writes its input as files, drains the stream, and returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.semi import JSON_TIMES, row_json
from millrace.functions.text import move_path, path_value
from millrace.functions.times import ntz
from millrace.operators.aggregate import price_stats
from millrace.operators.merge import merge_scd1
from millrace.plans.dimension import (
    FIELDS,
    KEY,
    LOADED,
    MERGED,
    REMOVED,
    _AFTER,
    _CHANGES,
    _END,
    _merged_sql,
    changes,
    customers,
    history,
    staged_customers,
    staging,
)
from millrace.plans.loads import TICKS_SQL, stage_ticks
from millrace.plans.registry import query
from millrace.plans.tables import SCHEMAS, table
from millrace.plans.weather import STATS_SQL, ticks
from millrace.session import new_folder, stored
from millrace.sources.files import list_staged
from millrace.sources.versions import BucketedTable
from millrace.streaming.bounded import until
from millrace.streaming.dimension import dimension_tables, maintaining
from millrace.streaming.feed import ChangeFeed, into_history
from millrace.streaming.figures import RunningStats
from millrace.streaming.ingest import (
    BATCH,
    STREAM,
    batch_sink,
    decode,
    drain,
    file_sink,
    file_stream,
    keep_running,
    newest_batch,
    quarantining,
    replacing,
    sending,
    rows_read,
    write_batch,
)
from millrace.streaming.rotation import read_files, rotated, stateful_session, writing_files
from millrace.streaming.windows import setting_late_aside, window_counts

_TICK = "tick_id bigint, symbol string, price double, timestamp timestamp_ntz"


def _write_ticks(df: DataFrame, folder: str) -> None:
    df.write.mode("append").options(**JSON_TIMES).json(folder)


@query("stream_ingest_once", "STM-09 STM-04 STM-03 SNK-09", TICKS_SQL)
def _(spark, sf_dir):
    landing, main, mark = (new_folder(spark, n) for n in ("landing", "main", "mark"))
    early = F.col("timestamp") < ntz("2024-01-15 00:00:00")
    source = ticks(spark, sf_dir)
    for part in (source.where(early), source.where(~early)):  # the second drain sees only the new files
        _write_ticks(part, landing)
        drain(file_sink(file_stream(spark, landing, _TICK), main, rows_per_file=100_000), mark)
    drain(file_sink(file_stream(spark, landing, _TICK), main), mark)  # nothing new: adds nothing
    return spark.read.schema(_TICK).parquet(main)


@query(
    "stream_csv_ingest",
    "STM-09 SRC-03",
    "SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def _(spark, sf_dir):
    landing, main, mark = (new_folder(spark, n) for n in ("landing", "main", "mark"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows.write.option("header", True).option("sep", "|").csv(landing)
    stream = file_stream(spark, landing, rows.schema, "csv", options={"header": "true", "sep": "|"})
    drain(file_sink(stream, main), mark)
    return spark.read.schema(rows.schema).parquet(main)


@query("stream_symbol_stats", "STM-12 AGG-08", STATS_SQL)
def _(spark, sf_dir):
    landing, out, mark = (new_folder(spark, n) for n in ("landing", "stats", "mark"))
    _write_ticks(ticks(spark, sf_dir), landing)
    stats = price_stats(file_stream(spark, landing, _TICK), "symbol", "price", digits=2)
    drain(batch_sink(stats, replacing(out), "complete"), mark)
    return newest_batch(spark, out, stats.schema)


@query("stream_running_stats", "STM-12 AGG-08", STATS_SQL)
def _(spark, sf_dir):
    landing, out, mark = (new_folder(spark, n) for n in ("landing", "running", "mark"))
    source = ticks(spark, sf_dir)
    stats = RunningStats(spark, out, source.schema["symbol"], "price")
    early = F.col("timestamp") < ntz("2024-01-15 00:00:00")
    for part in (source.where(early), source.where(~early)):  # the second batch is added to the figures of the first
        _write_ticks(part, landing)
        drain(batch_sink(file_stream(spark, landing, _TICK), stats.writer()), mark)
    return stats.read()


# messages as a topic hands them out: key, value, partition, offset
_MESSAGE = "key string, value string, partition int, offset bigint"


def _write_messages(spark, sf_dir, folder: str) -> None:
    value = row_json("tick_id", "symbol", "price", "timestamp")
    cut = F.when(F.col("price") < 1, F.substring(value, 1, 20)).otherwise(value)
    messages = ticks(spark, sf_dir).select(
        F.col("symbol").alias("key"), cut.alias("value"), F.length("symbol").alias("partition"), F.col("tick_id").alias("offset")
    )
    messages.write.json(folder)


@query(
    "stream_decode",
    "STM-01 STM-02 STM-06 UDF-07",
    f"SELECT symbol AS key, CAST(length(symbol) AS INTEGER) AS partition, tick_id AS offset, * FROM ({TICKS_SQL}) WHERE price >= 1",
)
def _(spark, sf_dir):
    topic, main, mark = (new_folder(spark, n) for n in ("topic", "main", "mark"))
    _write_messages(spark, sf_dir, topic)
    decoded = decode(file_stream(spark, topic, _MESSAGE), _TICK)
    drain(file_sink(decoded.where("_corrupt_record is null").drop("_corrupt_record"), main), mark)
    return spark.read.schema(f"key string, partition int, offset bigint, {_TICK}").parquet(main)


@query(
    "stream_quarantine",
    "STM-08 DQ-05",
    """SELECT CASE WHEN value < 1 THEN 'unreadable' WHEN value > 150 THEN 'price out of range' END AS reason, COUNT(*) AS n,
       CAST(SUM(event_id) AS BIGINT) AS offset_sum FROM events GROUP BY 1""",
)
def _(spark, sf_dir):
    topic, good, bad, mark = (new_folder(spark, n) for n in ("topic", "good", "bad", "mark"))
    _write_messages(spark, sf_dir, topic)
    rules = {"unreadable": F.col("_corrupt_record").isNull(), "price out of range": F.col("price") <= 150}
    decoded = decode(file_stream(spark, topic, _MESSAGE), _TICK)
    drain(batch_sink(decoded, quarantining(rules, good, bad)), mark)
    columns = f"key string, partition int, offset bigint, {_TICK}, _corrupt_record string"
    kept = spark.read.schema(columns).parquet(good).withColumn("reason", F.lit(None).cast("string"))
    both = kept.unionByName(spark.read.schema(f"{columns}, reason string").parquet(bad))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("offset").alias("offset_sum"))


def _accept(record: dict) -> None:
    """A target that takes prices up to 150."""
    if record["price"] > 150:
        raise ValueError("price out of range")


@query(
    "stream_dead_letter",
    "STM-05",
    """SELECT CASE WHEN value > 150 THEN 'dead' ELSE 'delivered' END AS place, COUNT(*) AS n, CAST(SUM(event_id) AS BIGINT) AS key_sum,
       CAST(CASE WHEN value > 150 THEN 3 ELSE 1 END AS INTEGER) AS attempts FROM events GROUP BY 1, 4""",
)
def _(spark, sf_dir):
    landing, sent, mark = (new_folder(spark, n) for n in ("landing", "sent", "mark"))
    _write_ticks(ticks(spark, sf_dir), landing)
    drain(batch_sink(file_stream(spark, landing, _TICK), sending(_accept, sent, pause=0.0)), mark)
    place = F.when(F.col("error").isNull(), F.lit("delivered")).otherwise(F.lit("dead"))
    told = spark.read.schema(f"{_TICK}, attempts int, error string").parquet(sent)
    return told.groupBy(place.alias("place"), "attempts").agg(F.count(F.lit(1)).alias("n"), F.sum("tick_id").alias("key_sum"))


@query("stream_json_batches", "SNK-08 STM-04", TICKS_SQL)
def _(spark, sf_dir):
    landing, main, mark = (new_folder(spark, n) for n in ("landing", "main", "mark"))
    _write_ticks(ticks(spark, sf_dir), landing)
    sink = batch_sink(file_stream(spark, landing, _TICK), lambda df, batch_no: write_batch(df, batch_no, main, "json", rows_per_file=50_000))
    drain(sink, mark)
    return spark.read.schema(_TICK).json(main).select(*(f.split()[0] for f in _TICK.split(", ")))


@query("stream_new_checkpoint", "STM-04 STM-09", TICKS_SQL)
def _(spark, sf_dir):
    """A stream that starts over with a new checkpoint numbers its batches from 0 again, and adds to what is there."""
    main = new_folder(spark, "main")
    early = F.col("timestamp") < ntz("2024-01-15 00:00:00")
    source = ticks(spark, sf_dir)
    for part in (source.where(early), source.where(~early)):
        landing, mark = new_folder(spark, "landing"), new_folder(spark, "mark")
        _write_ticks(part, landing)
        drain(batch_sink(file_stream(spark, landing, _TICK), lambda df, batch_no: write_batch(df, batch_no, main)), mark)
    return spark.read.schema(_TICK).parquet(main).select(*(f.split()[0] for f in _TICK.split(", ")))


@query("stream_replay", "STM-14 STM-04", TICKS_SQL)
def _(spark, sf_dir):
    # an existing table goes through the streaming path as it lies; no copy is made first. The pattern lets it be one file
    # or a folder of files: a plain path has to be a folder.
    main, mark = new_folder(spark, "main"), new_folder(spark, "mark")
    stored_table = file_stream(spark, f"{sf_dir}/events.parque[t]", SCHEMAS["events"], "parquet", files_per_batch=100)
    stream = stored_table.select(
        F.col("event_id").alias("tick_id"), F.col("event_type").alias("symbol"), F.col("value").alias("price"), F.col("ts").alias("timestamp")
    )
    drain(file_sink(stream, main), mark)
    return spark.read.schema(_TICK).parquet(main)


@query(
    "stream_archive",
    "STM-13 SRC-17 F-STR-10",
    """SELECT strftime(o_orderdate, '%Y') AS batch_id, 'processed' AS state, COUNT(*) AS n_rows FROM orders GROUP BY 1
       UNION ALL SELECT 'late', 'processing', 1""",
)
def _(spark, sf_dir):
    """Landing files of all batches are loaded and then move to the archive; the last batch is still on its way."""
    landing, archive, main, mark = (new_folder(spark, n) for n in ("landing", "processed", "main", "mark"))
    schema = "o_orderkey bigint, o_totalprice double, batch_id string"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("batch_id"))
    late = spark.range(1).select((-F.col("id") - 1).alias("o_orderkey"), F.lit(1.0).alias("o_totalprice"), F.lit("late").alias("batch_id"))
    # files are moved by the batch after the one that read them
    for part in (orders.hint("rebalance", "batch_id"), late):
        part.write.mode("append").partitionBy("batch_id").json(landing)
        drain(file_sink(file_stream(spark, landing, schema, archive=archive), main), mark)
    loaded = spark.read.schema(schema).parquet(main).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))
    here = list_staged(spark, landing, ".json").select(path_value(F.col("path"), "batch_id").alias("batch_id")).distinct()
    state = F.when(F.col("_waiting"), F.lit("processing")).otherwise(F.lit("processed"))
    return loaded.join(here.withColumn("_waiting", F.lit(True)), "batch_id", "left").select("batch_id", state.alias("state"), "n_rows")


@query(
    "file_manifest",
    "STM-13 F-STR-10 F-STR-09",
    """SELECT DISTINCT strftime(o_orderdate, '%Y') AS batch_id, 'landing/' || strftime(o_orderdate, '%Y') AS landed_as,
       'processing/' || strftime(o_orderdate, '%Y') AS picked_as, 'processed/' || strftime(o_orderdate, '%Y') AS done_as FROM orders""",
)
def _(spark, sf_dir):
    landing = new_folder(spark, "landing")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("batch_id"))
    orders.hint("rebalance", "batch_id").write.partitionBy("batch_id").json(landing)
    batch = path_value(F.col("path"), "batch_id")
    files = list_staged(spark, landing, ".json").select(batch.alias("batch_id"), F.concat(F.lit("landing/"), batch).alias("landed_as"))
    moved = files.withColumn("picked_as", move_path(F.col("landed_as"), "landing/", "processing/"))
    return moved.withColumn("done_as", move_path(F.col("picked_as"), "processing/", "processed/")).distinct()


@query(
    "stream_scd2",
    "STM-11 TBL-13 TBL-16",
    f"""WITH {_AFTER.replace('AND balance < 0', 'AND FALSE')} SELECT * REPLACE ({_END}) FROM hist_after WHERE name NOT LIKE '% old'""",
)
def _(spark, sf_dir):
    landing, dim, mark = (new_folder(spark, n) for n in ("landing", "dimension", "mark"))
    first = customers(spark, sf_dir).withColumnRenamed("update_timestamp", "loaded_at")
    second = staged_customers(spark, sf_dir).withColumn("loaded_at", F.when(F.col("load_seq") == 1, ntz(LOADED)).otherwise(ntz(MERGED))).drop("load_seq")
    current, history = dimension_tables(spark, dim, first.select(*KEY, *FIELDS).schema, KEY, buckets=8)
    for part in (first, second):
        part.write.mode("append").json(landing)
        stream = file_stream(spark, landing, first.schema)
        drain(batch_sink(stream, maintaining(current, history, KEY, FIELDS)), mark)
    return history.read().withColumn("end_time", F.date_format("end_time", "yyyy-MM-dd HH:mm:ss"))


@query("stream_scd1_on_timer", "STM-10 TBL-11", f"WITH {_merged_sql(False)} SELECT * FROM merged")
def _(spark, sf_dir):
    """Half of the staged rows lie there, half arrive while the merge wakes up by a timer."""
    landing, dim, mark = (new_folder(spark, n) for n in ("landing", "dimension", "mark"))
    first = customers(spark, sf_dir)
    current = BucketedTable(spark, dim, first.schema, KEY, buckets=8)
    current.replace(first)
    staged_rows, early = staging(spark, sf_dir), F.col("customer_id") % 2 == 0
    staged_rows.where(early).write.parquet(landing)

    def merge(df, batch_no):
        staged = stored(df)
        current.change(staged, lambda rows: merge_scd1(rows, staged, KEY, FIELDS, ntz(MERGED)))

    running = keep_running(batch_sink(file_stream(spark, landing, staged_rows.schema, "parquet"), merge), mark, every="1 second")
    try:
        staged_rows.where(~early).write.mode("append").parquet(landing)
        running.processAllAvailable()
    finally:
        running.stop()
    return current.read()


@query("stream_timed_rotation", "STM-07 SNK-09 STM-04", TICKS_SQL)
def _(spark, sf_dir):
    # small files by time and by record count, as an object-store connector rotates them
    landing, main, mark = (new_folder(spark, n) for n in ("landing", "rotated", "mark"))
    _write_ticks(ticks(spark, sf_dir), landing)
    sink = file_sink(file_stream(spark, landing, _TICK), main, "json", rows_per_file=10_000)
    running = keep_running(sink, mark, every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(_TICK).json(main)


@query(
    "stream_rotation",
    "STM-07 SNK-09",
    """SELECT event_type AS key, reason, CAST(count(DISTINCT n // 100) AS BIGINT) AS n_files, count(*) AS n_records,
       CAST(SUM(event_id) AS BIGINT) AS id_sum FROM (
         SELECT event_id, event_type, n, CASE WHEN n // 100 = (total // 100) THEN 'time' ELSE 'size' END AS reason FROM (
           SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS n,
                  count(*) OVER (PARTITION BY event_type) AS total FROM events)) GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """Files of 100 records per symbol; what is left over waits for two seconds. Full files come in event order."""
    landing, main, mark = (new_folder(spark, n) for n in ("landing", "rotated", "mark"))
    ticks(spark, sf_dir).select(F.col("symbol").alias("key"), row_json("tick_id", "price").alias("value")).write.json(landing)
    session = stateful_session(spark, partitions=4)
    stream = file_stream(session, landing, "key string, value string")
    order = F.get_json_object("value", "$.tick_id").cast("bigint")
    running = keep_running(batch_sink(rotated(stream, 100, seconds=2.0, order=order), writing_files(main)), mark, every="1 second")
    try:
        until(session, running, idle=4.0)
    finally:
        running.stop()
    named = read_files(spark, main).withColumn("id", F.get_json_object("value", "$.tick_id").cast("bigint"))
    return named.groupBy("key", "reason").agg(
        F.count_distinct("file_no").alias("n_files"), F.count(F.lit(1)).alias("n_records"), F.sum("id").alias("id_sum")
    )


@query("stream_until_idle", "STM-03 STM-04", TICKS_SQL)
def _(spark, sf_dir):
    """The stream ends by itself once nothing has come for two seconds; half of the ticks come while it runs."""
    landing, main, mark = (new_folder(spark, n) for n in ("landing", "main", "mark"))
    source, early = ticks(spark, sf_dir), F.col("timestamp") < ntz("2024-01-15 00:00:00")
    _write_ticks(source.where(early), landing)
    running = keep_running(file_sink(file_stream(spark, landing, _TICK), main), mark, every="500 milliseconds")
    try:
        _write_ticks(source.where(~early), landing)
        until(spark, running, idle=2.0)
    finally:
        running.stop()
    return spark.read.schema(_TICK).parquet(main)


@query(
    "stream_first_n",
    "STM-03",
    "SELECT 'messages' AS first_end, TRUE AS enough, 'idle' AS second_end, COUNT(*) AS n_rows, CAST(SUM(event_id) AS BIGINT) AS id_sum FROM events",
)
def _(spark, sf_dir):
    """One consumer stops after a tenth of the messages or more, the next one goes on where it stopped."""
    landing, main, mark = (new_folder(spark, n) for n in ("landing", "main", "mark"))
    _write_ticks(ticks(spark, sf_dir).repartition(8, "tick_id"), landing)
    wanted = spark.read.schema(_TICK).json(landing).count() // 10
    ends = []
    for bounds in ({"messages": wanted}, {"idle": 2.0}):
        stream = file_stream(spark, landing, _TICK, files_per_batch=1)
        running = keep_running(file_sink(stream, main), mark, every="200 milliseconds")
        try:
            ends.append((until(spark, running, **bounds), rows_read(running)))
        finally:
            running.stop()
    (first, read), (second, _) = ends
    told = spark.read.schema(_TICK).parquet(main).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("tick_id").alias("id_sum"))
    return told.select(F.lit(first).alias("first_end"), F.lit(read >= wanted).alias("enough"), F.lit(second).alias("second_end"), "n_rows", "id_sum")


def _feed(spark, sf_dir) -> tuple[ChangeFeed, list[DataFrame]]:
    """An empty feed, and the customers' changes as two commits: what the merge did, then who left."""
    rows = changes(spark, sf_dir).withColumn("changed_at", ntz(REMOVED))
    left = (F.col("action") == "DELETE") & ~F.col("is_update")
    return ChangeFeed(spark, new_folder(spark, "feed"), rows.schema), [rows.where(~left), rows.where(left)]


@query("feed_history", "TBL-14 STM-11 TBL-16", f"WITH {_AFTER} SELECT * REPLACE ({_END}) FROM hist_after")
def _(spark, sf_dir):
    feed, commits = _feed(spark, sf_dir)
    kept = dimension_tables(spark, new_folder(spark, "dimension"), customers(spark, sf_dir).select(*KEY, *FIELDS).schema, KEY, buckets=8)[1]
    kept.start(history(spark, sf_dir), "start")
    position = new_folder(spark, "position")
    for number, rows in enumerate(commits):
        feed.append(rows, number)
        feed.read_on(into_history(kept, KEY, FIELDS), position)
    return kept.read().withColumn("end_time", F.date_format("end_time", "yyyy-MM-dd HH:mm:ss"))


@query(
    "feed_readers",
    "TBL-14 STM-11",
    f"""WITH {_CHANGES} SELECT reader, action, is_update, COUNT(*) AS n, CAST(SUM(customer_id) AS BIGINT) AS key_sum
        FROM changes, (VALUES ('early'), ('late')) AS r(reader) GROUP BY ALL""",
)
def _(spark, sf_dir):
    """One reader follows commit by commit, the other comes when all is there; a commit that is repeated is seen once."""
    feed, commits = _feed(spark, sf_dir)
    out = {reader: (new_folder(spark, reader), new_folder(spark, "position")) for reader in ("early", "late")}

    def read_on(reader: str) -> None:
        folder, position = out[reader]
        feed.read_on(lambda df, batch_no: write_batch(df, batch_no, folder), position)

    for number, rows in enumerate(commits):
        for _attempt in range(2):
            feed.append(rows, number)
        read_on("early")
    read_on("late")
    seen = [spark.read.schema(feed.schema).parquet(folder).withColumn("reader", F.lit(reader)) for reader, (folder, _) in out.items()]
    return seen[0].unionByName(seen[1]).groupBy("reader", "action", "is_update").agg(F.count(F.lit(1)).alias("n"), F.sum("customer_id").alias("key_sum"))


@query(
    "stream_windows",
    "STM-08 STM-12 AGG-08",
    """WITH r AS (SELECT event_type AS symbol, date_trunc('hour', ts) AS h, event_type = 'signup' AND ts < TIMESTAMP '2024-01-15' AS late FROM events),
       m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)
       SELECT symbol, CASE WHEN late THEN NULL ELSE h END AS window_start, late, COUNT(*) AS n
       FROM r, m WHERE late OR h + INTERVAL 1 HOUR <= mark GROUP BY 1, 2, 3""",
)
def _(spark, sf_dir):
    """Counts per hour; one symbol's ticks of the first half come when their hours are closed."""
    landing, seen, out, marks, mark = (new_folder(spark, n) for n in ("landing", "seen", "windows", "marks", "mark"))
    tick = _TICK.replace("timestamp_ntz", "timestamp")
    source, early, slow = ticks(spark, sf_dir), F.col("timestamp") < ntz("2024-01-15 00:00:00"), F.col("symbol") == "signup"
    for part in (source.where(early & ~slow), source.where(~early), source.where(early & slow)):
        part.withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.mode("append").options(**JSON_TIMES).json(landing)
        drain(batch_sink(file_stream(spark, landing, tick), setting_late_aside("timestamp", "1 hour", "1 hour", seen)), marks)
        on_time = file_stream(spark, f"{seen}/on_time", f"{tick}, {STREAM} string, {BATCH} bigint", "parquet")
        drain(file_sink(window_counts(on_time, "timestamp", ["symbol"], "1 hour", "1 hour"), out), mark)
    counts = spark.read.schema("window_start timestamp, symbol string, n bigint").parquet(out)
    counts = counts.select("symbol", F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.lit(False).alias("late"), "n")
    late = spark.read.schema(tick).parquet(f"{seen}/late").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(late.select("symbol", F.lit(None).cast("timestamp_ntz").alias("window_start"), F.lit(True).alias("late"), "n"))
