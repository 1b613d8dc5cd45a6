"""A change stream with a position per reader.

Change rows (``action`` INSERT or DELETE, ``is_update``) are appended to a folder, a sub-folder per commit. Each reader streams
the folder with a checkpoint of its own, which is its position: it moves only once the reader's own write is done, and readers
don't know of each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.history import scd2_changes
from millrace.session import stored
from millrace.sources.versions import HistoryTable, overwrite_partitions
from millrace.streaming.ingest import BatchWriter, batch_sink, drain, file_stream

COMMIT = "commit_no"


class ChangeFeed:
    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self._stored = T.StructType([*schema.fields, T.StructField(COMMIT, T.LongType())])

    def has(self, commit: int) -> bool:
        try:
            self.spark.read.schema(self.schema).parquet(f"{self.folder}/{COMMIT}={commit}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def append(self, changes: DataFrame, commit: int) -> None:
        """Add a commit, all of it or nothing. One that is there already is left alone, since readers may have seen it."""
        if not self.has(commit):
            rows = changes.select(*self.schema.names).withColumn(COMMIT, F.lit(commit).cast("bigint"))
            overwrite_partitions(rows, self.folder, [COMMIT])

    def stream(self, files_per_batch: int | None = None) -> DataFrame:
        """The changes from the first one on, with their commit."""
        return file_stream(self.spark, self.folder, self._stored, "parquet", files_per_batch)

    def read_on(self, write: BatchWriter, position: str) -> None:
        """Hand everything that the reader with the checkpoint ``position`` hasn't seen yet to ``write``."""
        drain(batch_sink(self.stream(), write), position)


def into_history(history: HistoryTable, keys: Sequence[str], columns: Sequence[str], at: str = "changed_at") -> BatchWriter:
    """Batch writer of a reader that keeps a row history: one commit after the other, each once.

    ``at`` tells when a commit's changes were made, which is when deleted rows end. The commits of a batch are few numbers:
    those that came since the reader was here last.
    """

    def write(df: DataFrame, batch_no: int) -> None:
        read = stored(df)
        for (commit,) in read.select(COMMIT).distinct().orderBy(COMMIT).collect():
            batch = f"{COMMIT}-{commit}"
            if history.has_batch(batch):
                continue
            changes = stored(read.where(F.col(COMMIT) == commit).drop(COMMIT))
            only = history.opened.touched(changes)
            now = changes.agg(F.max(at)).scalar()
            history.advance(stored(scd2_changes(changes, history.open_rows(only), keys, columns, now)), batch)

    return write
