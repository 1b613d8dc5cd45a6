"""Figures per window of event time, with a bound on how late rows may come and a place for those that come later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.streaming.ingest import BATCH, STREAM, BatchWriter, stream_id, write_batch

_MARKS = f"latest timestamp, {STREAM} string, {BATCH} bigint"


def window_counts(stream: DataFrame, at: str, keys: Sequence[str], size: str, lateness: str) -> DataFrame:
    """Rows per key and tumbling window: (window_start, keys, n), each window once, when no row may come for it any more.

    ``at`` has to be a timestamp. The state holds the windows that end after the watermark, the greatest time seen less
    ``lateness``; Spark evicts a window with the batch after that, and would drop a row for it.
    """
    window = F.window(at, size)
    counts = stream.withWatermark(at, lateness).groupBy(window.alias("_window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("_window.start").alias("window_start"), *keys, "n")


def _window_end(at: Column, size: str) -> Column:
    """End of the tumbling window of a time; ``F.window`` itself would drop rows without a time."""
    step = F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {size})")
    micros = F.unix_micros(at)
    return F.timestamp_micros(micros - F.pmod(micros, step) + step)


def _watermark(df: DataFrame, marks: str, batch_no: int, lateness: str) -> Column:
    """Greatest time of this stream's earlier batches less the lateness; null in its first batch."""
    try:
        earlier = df.sparkSession.read.schema(_MARKS).parquet(marks)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return F.lit(None).cast("timestamp")
    own = earlier.where((F.col(STREAM) == (stream_id(df) or "none")) & (F.col(BATCH) < batch_no))
    return own.agg(F.max("latest") - F.expr(f"INTERVAL {lateness}")).scalar()


def setting_late_aside(at: str, size: str, lateness: str, folder: str) -> BatchWriter:
    """Batch writer that lands rows in ``folder/on_time``, but those whose window is closed in ``folder/late``.

    A window is closed as ``window_counts`` closes it: when it ends at or before the greatest time of the batches before,
    less the lateness. Each batch's greatest time is kept beside the rows under the batch's number, so a repeated batch
    splits its rows as before, also after a restart. A stream of ``on_time`` never has a row that Spark would drop, as
    its watermark lags behind. A row without a time is late.
    """

    def write(df: DataFrame, batch_no: int) -> None:
        df = df.persist()
        try:
            mark = _watermark(df, f"{folder}/marks", batch_no, lateness)
            late = F.coalesce(_window_end(F.col(at), size) <= mark, F.col(at).isNull())
            split = df.withColumn("_late", late)
            write_batch(split.where("not _late").drop("_late"), batch_no, f"{folder}/on_time")
            write_batch(split.where("_late").drop("_late"), batch_no, f"{folder}/late")
            write_batch(df.agg(F.max(at).alias("latest")), batch_no, f"{folder}/marks")
        finally:
            df.unpersist()

    return write
