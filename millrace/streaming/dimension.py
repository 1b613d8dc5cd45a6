"""Streaming upkeep of a dimension: every batch of staged rows updates the current table and the row history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.history import scd2_changes, start_history
from millrace.operators.merge import latest_per_key, merge_changes, merge_scd1
from millrace.session import stored
from millrace.sources.versions import BucketedTable, HistoryTable
from millrace.streaming.ingest import BatchWriter, stream_id, write_batch

_TIMES = [T.StructField(n, T.TimestampNTZType()) for n in ("start_time", "end_time")]


def dimension_tables(spark, folder: str, fields: T.StructType, keys: Sequence[str], buckets: int) -> tuple[BucketedTable, HistoryTable]:
    """Current table and history of a dimension with the given key and attribute fields."""
    stamps = [T.StructField(n, T.TimestampNTZType()) for n in ("update_timestamp", "loaded_at")]
    current = T.StructType([*fields.fields, *stamps])
    history = T.StructType([*fields.fields, *_TIMES, T.StructField("is_current", T.BooleanType())])
    return (
        BucketedTable(spark, f"{folder}/current", current, keys, buckets),
        HistoryTable(spark, f"{folder}/history", history, keys, buckets),
    )


def maintaining(
    current: BucketedTable, history: HistoryTable, keys: Sequence[str], columns: Sequence[str], late_folder: str | None = None
) -> BatchWriter:
    """Batch writer: type-1 merge into ``current``, and the same changes into ``history``.

    Rows carry ``loaded_at``; the newest row per key wins, and the greatest ``loaded_at`` is the time of
    the batch. It comes from the data, so a repeated batch stamps the same time. Where a key of the batch already has
    that time or a later one, the batch's time is a microsecond after it, so that versions follow each other. History
    goes first: a retry then still finds the same changes, the history skips what it has, and the merge finds rows that
    are already merged unchanged.

    ``current`` keeps each key's own ``loaded_at``. A row from before it comes too late for that key: neither table
    takes it, so that both keep showing the same newest version, and it is written to ``late_folder`` (``late`` beside
    the two tables unless given) under its batch number. Of rows with the same ``loaded_at`` in two batches the later
    batch wins.
    """
    aside = late_folder or f"{current.folder.rsplit('/', 2)[0]}/late"

    def write(df: DataFrame, batch_no: int) -> None:
        read = stored(df.select(*keys, *columns, "loaded_at"))
        if read.isEmpty():
            return
        staged = stored(latest_per_key(read, keys, [F.desc("loaded_at")]))
        batch = f"batch-{stream_id(df)}-{batch_no}"
        now = staged.agg(F.max("loaded_at")).scalar()
        first = staged.select(*keys, *columns, now.alias("update_timestamp"), "loaded_at")
        if not history.started():
            history.start(start_history(first.drop("loaded_at")), batch)
        if not current.started():
            current.replace(first)
            return
        only = current.touched(staged)
        had = current.read(only).select(*keys, "update_timestamp", F.col("loaded_at").alias("_had"))
        had = stored(had.join(staged.select(*keys, "loaded_at"), list(keys)).withColumn("_late", F.coalesce(F.col("loaded_at") < F.col("_had"), F.lit(False))))
        late = had.where("_late").select(*keys)
        write_batch(read.join(late, list(keys), "left_semi"), batch_no, aside)
        staged = stored(staged.join(late, list(keys), "left_anti"))
        if staged.isEmpty():
            return
        after = had.where("not _late").agg(F.max(F.col("update_timestamp") + F.expr("INTERVAL '0.000001' SECOND")))
        now = F.greatest(staged.agg(F.max("loaded_at")).scalar(), after.scalar())
        if not history.has_batch(batch):
            changes = stored(merge_changes(current.read(only), staged, keys, columns, now))
            history.advance(stored(scd2_changes(changes, history.open_rows(only), keys, columns, now)), batch)

        def merged(rows: DataFrame) -> DataFrame:
            loaded = rows.select(*keys, "loaded_at").unionByName(staged.select(*keys, "loaded_at"))
            loaded = loaded.groupBy(*keys).agg(F.max("loaded_at").alias("loaded_at"))
            return merge_scd1(rows, staged, keys, columns, now).join(loaded, list(keys), "left")

        current.change(staged, merged)

    return write
