"""Files that are closed by number of records or by age, whichever comes first, across micro-batches.

Records of one key wait in the stream's state until there are enough of them or the oldest has waited long enough. A key has at
most ``size`` records waiting, however long the stream runs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.sources.versions import overwrite_partitions
from millrace.streaming.ingest import BatchWriter

ROTATED = "key string, file_no bigint, reason string, value string"
_RUN_BYTES = 64 << 20
_FIRST = -(2**63)
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session beside the given one whose streams keep their state on disk, as timers and lists in state need it.

    ``partitions`` is the number of state stores of a new stream; a checkpoint keeps the number that it started with.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    return session


def _piece(run: pa.Table) -> int:
    return max(1, run.num_rows // 64)


def _sorted_runs(parts: Iterator[pd.DataFrame], folder: str, most: int) -> Iterator[pa.Table | str]:
    """The rows sorted by ``at`` in runs of ``most`` bytes: those that are full as files in the folder, the last as a table."""
    waiting, size = [], 0
    for part in parts:
        waiting.append(pa.table({"at": pa.array(part["at"], pa.int64()), "value": pa.array(part["value"], pa.string())}))
        size += waiting[-1].nbytes
        if size >= most:
            run, path = pa.concat_tables(waiting).sort_by("at"), f"{folder}/{uuid.uuid4().hex}"
            with pa.OSFile(path, "wb") as file, pa.ipc.new_file(file, run.schema) as writer:
                writer.write_table(run, max_chunksize=_piece(run))
            yield path
            waiting, size = [], 0
    if waiting:
        yield pa.concat_tables(waiting).sort_by("at")


def in_order(parts: Iterator[pd.DataFrame], most: int = _RUN_BYTES) -> Iterator[list[str]]:
    """Values of the parts by ``at``. Memory holds ``most`` bytes and a 64th of each full run; the runs wait on the task's own disk."""

    def pieces(run: pa.Table | str) -> Iterator[pa.Table]:
        if isinstance(run, pa.Table):
            yield from (run.slice(k, _piece(run)) for k in range(0, run.num_rows, _piece(run)))
            return
        with pa.OSFile(run) as file:
            reader = pa.ipc.open_file(file)
            for k in range(reader.num_record_batches):
                yield pa.Table.from_batches([reader.get_batch(k)])

    with ExitStack() as stack:
        folder = stack.enter_context(tempfile.TemporaryDirectory(prefix="rotation-"))
        runs = [pieces(run) for run in _sorted_runs(parts, folder, most)]
        heads = [next(run) for run in runs]
        while heads:
            # what the run that ends first has in memory is followed by nothing smaller in any other run
            ends = [h["at"].to_numpy() for h in heads]
            bound = min(at[-1] for at in ends)
            cuts = [int(np.searchsorted(at, bound, side="right")) for at in ends]
            yield pa.concat_tables([h.slice(0, cut) for h, cut in zip(heads, cuts, strict=True)]).sort_by("at")["value"].to_pylist()
            left = [(run, h.slice(cut) if cut < h.num_rows else next(run, None)) for run, h, cut in zip(runs, heads, cuts, strict=True)]
            runs, heads = [run for run, h in left if h is not None], [h for _, h in left if h is not None]


class _Rotation(StatefulProcessor):
    def __init__(self, size: int, wait_ms: int, ordered: bool):
        self._size, self._wait_ms, self._ordered = size, wait_ms, ordered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", "value string")
        # number of records that wait, number of the file they will be in, and when it is due
        self._place = handle.getValueState("place", "waiting int, file_no bigint, due bigint")

    def _now(self) -> tuple[int, int, int]:
        place = self._place.get()
        return (0, 0, 0) if place is None else (place[0], place[1], place[2])

    @staticmethod
    def _files(key: tuple, file_no: int | np.ndarray, reason: str, values: Sequence[str]) -> pd.DataFrame:
        return pd.DataFrame({"key": key[0], "file_no": file_no, "reason": reason, "value": list(values)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before, file_no, due = self._now()
        # records that are not in the state; once a file is closed it holds none
        held, closed = [], False
        for values in in_order(rows) if self._ordered else (list(part["value"]) for part in rows):
            held += values
            if len(held) + (0 if closed else before) < self._size:
                continue
            if not closed and before:
                held = [r[0] for r in self._waiting.get()] + held
                self._waiting.clear()
            closed = True
            full = len(held) // self._size * self._size
            yield self._files(key, file_no + np.arange(full) // self._size, "size", held[:full])
            file_no += full // self._size
            held = held[full:]
        if held:
            self._waiting.appendList([(v,) for v in held])
        waiting = len(held) + (0 if closed else before)
        if closed or not before:
            if due:
                self._handle.deleteTimer(due)
            due = timerValues.getCurrentProcessingTimeInMs() + self._wait_ms if waiting else 0
            if due:
                self._handle.registerTimer(due)
        self._place.update((waiting, file_no, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting, file_no, _ = self._now()
        if waiting:
            yield self._files(key, file_no, "time", [r[0] for r in self._waiting.get()])
            self._waiting.clear()
        self._place.update((0, file_no + 1 if waiting else file_no, 0))

    def close(self) -> None:
        pass


def rotated(records: DataFrame, size: int = 100, seconds: float = 60.0, order: Column | None = None) -> DataFrame:
    """(key, file_no, reason, value) of the files that are full, or whose first record has waited for ``seconds``.

    ``records`` is a stream of (key, value) texts from a ``stateful_session``; a null key is a key of its own. A key is read by
    one task, as a topic's partition is by one connector task: add a number to the keys to spread one over several files.
    A key's records of one micro-batch are taken in the ``order`` of a number (null first), or else as the shuffle hands them
    out, which is no order once a batch has several input splits. A file's rows come together.
    """
    named = {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    if order is not None:
        named["at"] = F.coalesce(order.cast("bigint"), F.lit(_FIRST))
    keyed = records.select(*[c.alias(name) for name, c in named.items()]).groupBy("key")
    return keyed.transformWithStateInPandas(_Rotation(size, int(seconds * 1000), order is not None), ROTATED, "Append", "ProcessingTime")


def _local_path(spark: SparkSession, folder: str) -> str | None:
    """The folder's path if it is on a mounted disk (``file:``), after making it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = files.makeQualified(path).toUri()
    if uri.getScheme() != "file":
        return None
    files.mkdirs(path)
    return uri.getPath()


_ESCAPED = {c: f"%{c:02X}" for c in (*range(1, 32), *map(ord, "\"#%'*/:=?\\{[]^"), 127)}


def folder_value(key: str | None, encoding: str) -> str:
    """A text as Spark names it in a partition's folder, where Java writes file names in the encoding."""
    return key.translate(_ESCAPED).encode(encoding, "replace").decode(encoding) if key else _NO_KEY


def _put(folder: str, key: str | None, file_no: int, lines: Sequence[str], encoding: str) -> None:
    at = f"{folder}/key={folder_value(key, encoding)}/file_no={file_no}"
    os.makedirs(at, exist_ok=True)
    for name in os.listdir(at):
        if re.match(r"\.?part-\d{5}-", name):  # an earlier try's, if Spark wrote it
            os.remove(f"{at}/{name}")
    # some keys share a folder, as the null and the empty one do
    new, name = f".{uuid.uuid4().hex}", f"part-{zlib.crc32(repr(key).encode()):08x}.json"
    with open(f"{at}/{new}", "w", encoding="utf-8", newline="\n") as file:
        file.writelines(f"{line}\n" for line in lines)
    os.replace(f"{at}/{new}", f"{at}/{name}")


def _putting(folder: str, encoding: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        newest: dict[str | None, int] = {}
        for (key, file_no), found in groupby(rows, key=lambda row: row[:2]):
            if newest.get(key, -1) >= file_no:
                raise ValueError(f"the rows of file {file_no} of key {key!r} lie apart")
            newest[key] = file_no
            _put(folder, key, file_no, [line for _, _, line in found], encoding)
        yield pa.RecordBatch.from_arrays([pa.array([len(newest)], pa.int64())], names=["n_keys"])

    return put


def writing_files(folder: str) -> BatchWriter:
    """Batch writer that puts each rotated file into a folder of its own, ``key=K/file_no=N``. A repeated batch finds its state as
    it was, gives its files the same numbers, and replaces them.

    On mounted disks the tasks write the files themselves, each under a hidden name first: Hadoop starts up to four processes for
    each small file there, and moves the folders one by one at the end. Other stores are written by Spark.
    """

    def write(df: DataFrame, batch_no: int) -> None:
        path = _local_path(df.sparkSession, folder)
        if path is None:
            overwrite_partitions(df.select("reason", "value", "key", "file_no"), folder, ["key", "file_no"], "json")
        else:
            lines = df.select("key", "file_no", F.to_json(F.struct("reason", "value")).alias("line"))
            encoding = df.sparkSession._jvm.java.lang.System.getProperty("sun.jnu.encoding")
            lines.mapInArrow(_putting(path, encoding), "n_keys bigint").write.format("noop").mode("overwrite").save()

    return write


def _unescaped(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(reason, value, key, file_no) of all rotated files, as a read of the partitioned folder gives them.

    The folders are listed by a few tasks per core, not by one task each. Key and number are taken from the paths: the driver
    would infer partitions in a time that grows with the square of the number of folders.
    """
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        files = spark.read.schema("reason string, value string").option("recursiveFileLookup", True).json(folder)
    finally:
        spark.conf.set(name, before)
    place = [F.regexp_extract("_metadata.file_path", r"/key=([^/]*)/file_no=(\d+)/[^/]*$", k) for k in (1, 2)]
    # a path is told as in a web address, and the folder's name is escaped itself
    key = _unescaped(_unescaped(F.when(place[0] != _NO_KEY, place[0])))
    return files.select("reason", "value", key.alias("key"), place[1].cast("bigint").alias("file_no"))
