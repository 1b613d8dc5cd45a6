"""Tables that can change: whole versions, hash buckets of which only touched ones are rewritten, row history.

Nothing is moved or deleted by hand and every write goes through Spark's own commit, so lost executors only
cost a task retry. What a table consists of is said by a log of one line per commit. One writer at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.history import apply_scd2
from millrace.session import stored


class State(NamedTuple):
    """What a log says: sequence number of the newest line, versions, buckets, keys, and whether the batch asked for is in it."""

    seq: int = -1
    newest: int = -1
    current: int | None = None
    last_alive: int | None = None
    places: list[int | None] | None = None
    keys: list[str] | None = None
    actions: tuple[str, ...] = ()
    done: bool = False


class CommitLog:
    """One line per commit: sequence number, version in force after it (null = none), action, batch.

    A bucketed table's line also says in which commit's folder the rows of each bucket lie, and its key columns. A line
    repeats what is still true of earlier ones, so only the newest is read, however many there are: lines lie in folders
    by pairs of digits of their number, and the newest is found by listing a few folders of at most a hundred names. A batch
    is found by a mark in a folder of its own; the mark is written before the line and counts only if that line has its id.
    """

    SCHEMA = (
        "seq bigint, version bigint, action string, batch string, at timestamp, newest bigint, last_alive bigint, "
        "places array<bigint>, keys array<string>, actions array<string>, id string"
    )
    MARK = "seq bigint, action string, batch string, id string"
    PAIRS = 5

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _read(self, folder: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", True).json(folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """All lines."""
        return self._read(f"{self.folder}/lines", self.SCHEMA)

    def _line_folder(self, seq: int) -> str:
        digits = f"{seq:0{2 * self.PAIRS}d}"
        return "/".join([f"{self.folder}/lines", *(digits[i : i + 2] for i in range(0, len(digits), 2))])

    def _mark_folder(self, batch: str) -> str:
        return f"{self.folder}/batches/{hashlib.sha256(batch.encode()).hexdigest()}"

    def _names(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted((s.getPath().getName() for s in files.listStatus(path)), reverse=True) if files.exists(path) else []

    def newest_folder(self, folder: str | None = None, pairs: int = 0) -> str | None:
        """Folder of the newest line; one whose write was broken off has no file yet and doesn't count."""
        folder = folder or f"{self.folder}/lines"
        names = self._names(folder)
        if pairs == self.PAIRS:
            return folder if any(name.startswith("part-") for name in names) else None
        return next(filter(None, (self.newest_folder(f"{folder}/{name}", pairs + 1) for name in names)), None)

    def state(self, action: str = "", batch: str | None = None) -> State:
        """What the log says; ``done`` tells whether the action (any, if empty) ran for the batch."""
        folder = self.newest_folder()
        if folder is None:
            return State()
        line = self._read(folder, self.SCHEMA).first()
        done = batch is not None and self._done(action, batch)
        return State(line.seq, line.newest, line.version, line.last_alive, line.places, line.keys, tuple(line.actions), done)

    def _done(self, action: str, batch: str) -> bool:
        # one mark per action and try
        for mark in self._read(self._mark_folder(batch), self.MARK).where(F.col("batch") == batch).collect():
            line = self._read(self._line_folder(mark.seq), self.SCHEMA).first()
            if action in ("", mark.action) and line is not None and line.id == mark.id:
                return True
        return False

    def has(self, action: str) -> bool:
        return action in self.state().actions

    def note(
        self,
        seq: int,
        action: str,
        version: int | None = None,
        batch: str | None = None,
        places: Sequence[int | None] = (),
        keys: Sequence[str] = (),
    ) -> None:
        before, one = self.state(), self.spark.range(1)
        named = {"seq": F.lit(seq).cast("bigint"), "action": F.lit(action), "batch": F.lit(batch).cast("string"), "id": F.lit(uuid.uuid4().hex)}
        if batch is not None:
            one.select(*[c.alias(name) for name, c in named.items()]).coalesce(1).write.mode("append").json(self._mark_folder(batch))
        lists = {"places": list(places) or before.places, "keys": list(keys) or before.keys, "actions": sorted({*before.actions, action})}
        kinds = {"places": "bigint", "keys": "string", "actions": "string"}
        named |= {
            "version": F.lit(version).cast("bigint"),
            "at": F.current_timestamp(),
            "newest": F.lit(max(before.newest, -1 if version is None else version)).cast("bigint"),
            "last_alive": F.lit(before.last_alive if version is None else version).cast("bigint"),
            **{name: F.array(*[F.lit(v).cast(kinds[name]) for v in values]) for name, values in lists.items() if values},
        }
        one.select(*[c.alias(name) for name, c in named.items()]).coalesce(1).write.mode("overwrite").json(self._line_folder(seq))


class VersionedTable:
    """A folder with one Parquet folder per version. Dropping and restoring are log lines.

    Every commit writes the whole table: meant for tables that are replaced or looked at as of earlier
    versions. For small batches into a large table use ``BucketedTable``.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.log = CommitLog(spark, f"{self.folder}/commits")

    def _data(self, version: int) -> str:
        return f"{self.folder}/data/_version={version}"

    def has_batch(self, batch: str) -> bool:
        return self.log.state(batch=batch).done

    def commit(self, df: DataFrame, action: str = "write", batch: str | None = None) -> int:
        """Write the next version and point to it. A batch that was committed before is left alone."""
        state = self.log.state(batch=batch)
        if state.done:
            return state.current
        version = state.newest + 1
        df.write.mode("overwrite").parquet(self._data(version))
        self.log.note(state.seq + 1, action, version, batch)
        return version

    def version(self) -> int | None:
        """The version in force, none if the table is dropped or was never written."""
        return self.log.state().current

    def read(self, version: int | None = None) -> DataFrame:
        """The table now, or as it was at an earlier version."""
        chosen = self.version() if version is None else version
        if chosen is None:
            raise LookupError(f"{self.folder} is dropped or was never written")
        return self.spark.read.parquet(self._data(chosen))

    def drop(self) -> None:
        self.log.note(self.log.state().seq + 1, "drop")

    def undrop(self) -> None:
        state = self.log.state()
        self.log.note(state.seq + 1, "undrop", state.last_alive)

    def restore(self, version: int) -> None:
        self.log.note(self.log.state().seq + 1, "restore", version)


def overwrite_partitions(df: DataFrame, folder: str, keys: Sequence[str], kind: str = "parquet", options: Mapping[str, str] | None = None) -> None:
    """Replace only the partitions the frame has rows for; the others keep their files."""
    writer = df.write.mode("overwrite").options(**dict(options or {})).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).format(kind).save(folder)


class BucketedTable:
    """Rows in buckets by key hash. A change reads and rewrites only the buckets its keys fall into.

    Each commit writes its buckets to a folder of its own, ``_commit=N/_bucket=B``, and one log line then points to them: a
    crash at any time leaves the table as it was, and readers never see half a batch. The log also holds keys and number of
    buckets, so a table can't be opened with others. Folders that no bucket uses any more are listed by ``unused``, for
    the cluster to expire once no reader needs them.

    Choose ``buckets`` so that one bucket is a few gigabytes. Each written bucket carries one hidden row, so that a
    bucket whose rows are all gone has a folder too.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], buckets: int):
        self.spark, self.keys, self.buckets, self.schema = spark, list(keys), buckets, schema
        self.folder = f"{folder.rstrip('/')}/rows"
        self.log = CommitLog(spark, f"{folder.rstrip('/')}/commits")
        self._stored = T.StructType([*schema.fields, T.StructField("_live", T.BooleanType()), T.StructField("_bucket", T.IntegerType())])

    def _state(self):
        state = self.log.state()
        if state.places is not None and (len(state.places), list(state.keys)) != (self.buckets, self.keys):
            raise ValueError(f"{self.folder} has {len(state.places)} buckets by {state.keys}, not {self.buckets} by {self.keys}")
        return state

    def started(self) -> bool:
        return self._state().places is not None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Bucket numbers of the rows' keys: at most ``buckets`` integers."""
        return [r[0] for r in rows.select(self._bucket()).distinct().collect()]

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """The table, or some of its buckets (other folders are not listed as input)."""
        places = self._state().places
        if places is None:
            raise LookupError(f"{self.folder} was never written")
        wanted = range(self.buckets) if only is None else only
        paths = [f"{self.folder}/_commit={places[b]}/_bucket={b}" for b in wanted if places[b] is not None]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self._stored).option("basePath", self.folder).parquet(*paths)
        return rows.where("_live").select(*self.schema.names)

    def has_batch(self, batch: str) -> bool:
        return self.log.state(batch=batch).done

    def replace(self, rows: DataFrame, only: Sequence[int] | None = None, batch: str | None = None) -> None:
        """Put the rows, which may be made from the table's own, in place of the given (by default all) buckets.

        A bucket may take a third of the rows: the rebalance lets AQE split it over several files.
        """
        state, replaced = self._state(), range(self.buckets) if only is None else only
        commit = state.seq + 1
        hidden = self.spark.createDataFrame([(b,) for b in replaced], "_bucket int")
        hidden = hidden.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema], F.lit(False).alias("_live"), "_bucket")
        live = rows.select(*self.schema.names).withColumns({"_live": F.lit(True), "_bucket": self._bucket()})
        out = live.unionByName(hidden).hint("rebalance", "_bucket")
        out.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/_commit={commit}")
        places = list(state.places or [None] * self.buckets)
        for bucket in replaced:
            places[bucket] = commit
        self.log.note(commit, "replace all" if only is None else "replace", batch=batch, places=places, keys=self.keys)

    def change(self, rows: DataFrame, merge: Callable[[DataFrame], DataFrame], batch: str | None = None) -> None:
        """Rewrite the buckets of the rows' keys with what ``merge`` makes of theirs; a batch that is in the log is left out."""
        if batch is not None and self.has_batch(batch):
            return
        only = self.touched(rows)
        if only:
            self.replace(merge(self.read(only)), only, batch)

    def unused(self) -> DataFrame:
        """Folders of earlier commits that no bucket points to any more, one row ``folder`` each."""
        lines = self.log.read().select("seq", F.posexplode("places").alias("bucket", "commit")).where("commit is not null")
        used = lines.groupBy("bucket").agg(F.max("commit").alias("commit"))
        old = lines.select("bucket", "commit").distinct().join(used, ["bucket", "commit"], "left_anti")
        return old.select(F.concat(F.lit(f"{self.folder}/_commit="), "commit", F.lit("/_bucket="), "bucket").alias("folder"))


class HistoryTable:
    """Row history: open rows in buckets, closed rows in a folder of the batch that closed them.

    A batch reads and rewrites the open rows of its own buckets; rows closed by earlier batches are never touched.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], buckets: int):
        self.spark, self.keys, self.schema = spark, list(keys), schema
        self.opened = BucketedTable(spark, f"{folder.rstrip('/')}/open", schema, keys, buckets)
        self.closed_folder = f"{folder.rstrip('/')}/closed"
        self.log = CommitLog(spark, f"{folder.rstrip('/')}/commits")

    def start(self, history: DataFrame, batch: str) -> None:
        self._write(history.select(*self.schema.names), None, batch)

    def advance(self, classified: DataFrame, batch: str) -> None:
        """Apply a batch of classified changes (stored, as they are read several times).

        Only open rows are matched. New versions start at the batch's own time, which no closed row has.
        """
        only = self.opened.touched(classified)
        if only:
            self._write(stored(apply_scd2(self.opened.read(only), classified, self.keys)), only, batch)

    def has_batch(self, batch: str) -> bool:
        return self.log.state("open", batch).done

    def started(self) -> bool:
        return self.log.has("open")

    def _write(self, after: DataFrame, only: Sequence[int] | None, batch: str) -> None:
        """Closed rows first. A retry keeps them: part of the open rows may have moved on since."""
        closed = self.log.state("closed", batch)
        seq = closed.seq
        if not closed.done:
            overwrite_partitions(after.where("not is_current").withColumn("closed_in", F.lit(batch)), self.closed_folder, ["closed_in"])
            seq += 1
            self.log.note(seq, "closed", batch=batch)
        self.opened.replace(after.where("is_current"), only)
        self.log.note(seq + 1, "open", batch=batch)

    def open_rows(self, only: Sequence[int] | None = None) -> DataFrame:
        return self.opened.read(only)

    def read(self) -> DataFrame:
        with_batch = T.StructType([*self.schema.fields, T.StructField("closed_in", T.StringType())])
        closed = self.spark.read.schema(with_batch).parquet(self.closed_folder).drop("closed_in")
        return self.open_rows().unionByName(closed)
