"""Structured Streaming: sources, once-only file ingest, quarantine, delivery with retries, running figures.

The checkpoint folder of a query plays the part of a consumer group: it remembers which files or offsets were read.
Every sink written from a micro-batch goes to a folder of that batch, so a repeated batch replaces its own output.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.semi import JSON_TIMES
from millrace.operators.quality import split_valid
from millrace.sources.versions import overwrite_partitions

BATCH = "batch_no"
STREAM = "stream_id"
WRITTEN = "written_at"
BatchWriter = Callable[[DataFrame, int], None]


# ---------------------------------------------------------------- sources


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    kind: str = "json",
    files_per_batch: int | None = None,
    archive: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files that appear in a folder, each read once; with ``archive``, read files are moved there."""
    reader = spark.readStream.format(kind).schema(schema).options(**dict(options or {}))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder)


def topic_stream(spark: SparkSession, servers: str, topic: str, per_batch: int | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """A Kafka topic from its earliest offset, with key, value, partition and offset (needs the Kafka package)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**dict(options or {}))
    )
    if per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().select("key", "value", "partition", "offset")


def decode(messages: DataFrame, schema: str, corrupt: str = "_corrupt_record") -> DataFrame:
    """Message fields beside key, partition and offset where present; unreadable values stay in ``_corrupt_record``."""
    record = F.from_json(
        F.col("value").cast("string"),
        f"{schema}, {corrupt} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )
    keep = [F.col("key").cast("string").alias("key") if c == "key" else F.col(c) for c in messages.columns if c != "value"]
    return messages.select(*keep, record.alias("_record")).select(*[c for c in messages.columns if c != "value"], "_record.*")


# ---------------------------------------------------------------- running


def drain(writer, checkpoint: str) -> StreamingQuery:
    """Run a stream writer over what is there now, then stop."""
    running = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    return running


def keep_running(writer, checkpoint: str, every: str = "60 seconds") -> StreamingQuery:
    """Start a stream writer that wakes up in the given interval until it is stopped."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def rows_read(query: StreamingQuery) -> int:
    return sum(p.numInputRows for p in query.recentProgress)


def first_messages(messages: DataFrame, n: int, *order: str) -> DataFrame:
    """Bounded look at a topic or folder read as a batch."""
    return messages.orderBy(*order).limit(n)


# ---------------------------------------------------------------- sinks


def file_sink(stream: DataFrame, folder: str, kind: str = "parquet", rows_per_file: int | None = None):
    """Exactly-once file sink; ``rows_per_file`` bounds the records per file as an object-store connector does."""
    writer = stream.writeStream.format(kind).option("path", folder).outputMode("append")
    if kind == "json":
        writer = writer.options(**JSON_TIMES)
    return writer if rows_per_file is None else writer.option("maxRecordsPerFile", rows_per_file)


def batch_sink(stream: DataFrame, write: BatchWriter, mode: str = "append"):
    return stream.writeStream.foreachBatch(write).outputMode(mode)


def stream_id(df: DataFrame) -> str:
    """Id of the stream that a micro-batch belongs to: kept in its checkpoint, new with a new one; empty outside a stream."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def write_batch(df: DataFrame, batch_no: int, folder: str, kind: str = "parquet", rows_per_file: int | None = None) -> None:
    """Write a micro-batch under its stream and number, replacing an earlier try of the same batch and no other.

    Batch numbers start again with a new checkpoint, so a number alone would overwrite what an earlier stream wrote.
    """
    options = dict(JSON_TIMES) if kind == "json" else {}
    if rows_per_file is not None:
        options["maxRecordsPerFile"] = str(rows_per_file)
    numbered = df.withColumns({STREAM: F.lit(stream_id(df) or "none"), BATCH: F.lit(batch_no)})
    overwrite_partitions(numbered, folder, [STREAM, BATCH], kind, options)


def quarantining(rules: Mapping[str, Column], good_folder: str, bad_folder: str) -> BatchWriter:
    """Batch writer that keeps good rows and bad rows (with the reason) apart; the batch is decoded once for both."""

    def write(df: DataFrame, batch_no: int) -> None:
        df = df.persist()
        try:
            good, bad = split_valid(df, rules)
            write_batch(good, batch_no, good_folder)
            write_batch(bad, batch_no, bad_folder)
        finally:
            df.unpersist()

    return write


def _described(failure: Exception) -> str:
    return f"{type(failure).__name__}: {failure}"


def delivering(deliver: BatchWriter, dead_folder: str, attempts: int = 3, pause: float = 2.0) -> BatchWriter:
    """Batch writer that tries ``deliver`` a few times, then puts the batch aside with the error and goes on.

    For targets that take a batch as a whole; ``sending`` gives up single records. No row is lost: what could not be
    delivered lies in ``dead_folder`` under its batch number.
    """

    def write(df: DataFrame, batch_no: int) -> None:
        for attempt in range(1, attempts + 1):
            try:
                return deliver(df, batch_no)
            except Exception as failure:  # any failure of the target counts as a failed try
                error = _described(failure)
                if attempt < attempts:
                    time.sleep(pause)
        write_batch(df.withColumns({"error": F.lit(error), "attempts": F.lit(attempts)}), batch_no, dead_folder)

    return write


def sending(send: Callable[[dict], None], folder: str, attempts: int = 3, pause: float = 2.0) -> BatchWriter:
    """Batch writer that hands each record to ``send`` inside the tasks, up to ``attempts`` times, and goes on with the next.

    ``folder`` gets every record with ``attempts`` and ``error`` (null: delivered), under its batch number. A task that is
    repeated sends its records again, so the target has to take a record twice without harm.
    """

    def outcome(record: dict) -> tuple[int, str | None]:
        for attempt in range(1, attempts + 1):
            try:
                send(record)
                return attempt, None
            except Exception as failure:  # as above, but for this record only
                error = _described(failure)
                if attempt < attempts:
                    time.sleep(pause)
        return attempts, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [outcome(record) for record in batch.to_pylist()]
            added = pa.array([n for n, _ in told], pa.int32()), pa.array([e for _, e in told], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "attempts", "error"])

    def write(df: DataFrame, batch_no: int) -> None:
        schema = T.StructType([*df.schema.fields, T.StructField("attempts", T.IntegerType()), T.StructField("error", T.StringType())])
        write_batch(df.mapInArrow(run, schema), batch_no, folder)

    return write


def replacing(folder: str) -> BatchWriter:
    """Batch writer for complete-mode figures: each batch holds them all, and takes the place of the one before the last."""
    return lambda df, batch_no: write_batch(df.withColumn(WRITTEN, F.unix_micros(F.current_timestamp())), batch_no % 2, folder)


def newest_batch(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What the last batch wrote, of whichever stream."""
    own = [T.StructField(WRITTEN, T.LongType()), T.StructField(STREAM, T.StringType()), T.StructField(BATCH, T.LongType())]
    all_batches = spark.read.schema(T.StructType([*schema.fields, *own])).parquet(folder)
    last = all_batches.agg(F.max(WRITTEN)).scalar()
    return all_batches.where(F.col(WRITTEN) == last).drop(WRITTEN, STREAM, BATCH)
