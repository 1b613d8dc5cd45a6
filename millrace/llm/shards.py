"""Token ids in training order.

Documents' ids, each closed by the end token, run on through each input split and are cut into sequences of one length.
A keyed Feistel permutation over the number of sequences (cycle-walking: outside numbers are permuted again) gives each
its slot in the training order, and a range of slots makes a shard: a file of records of one stride, 16-bit ids and a line
feed, as Spark's text writer ends a value. The sequence of any slot, and the slot of any sequence, follow from the key, so a
reader can start anywhere.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import default_vocabulary, encode, encoding
from millrace.session import new_folder, stored


@dataclass(frozen=True)
class Order:
    """A keyed permutation of 0 .. n-1, both ways, on arrays."""

    n: int
    key: int
    rounds: int = 6

    @property
    def _half(self) -> int:
        return max(1, ((max(self.n, 2) - 1).bit_length() + 1) // 2)

    def _round(self, x: np.ndarray, k: int) -> np.ndarray:
        h = (x + np.uint64((self.key * 0x9E3779B97F4A7C15 + k * 0xD1B54A32D192ED03) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        return (h >> np.uint64(32)) & np.uint64((1 << self._half) - 1)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        half, mask = np.uint64(self._half), np.uint64((1 << self._half) - 1)
        left, right = x >> half, x & mask
        for k in reversed(range(self.rounds)) if back else range(self.rounds):
            if back:
                left, right = right ^ self._round(left, k), left
            else:
                left, right = right, left ^ self._round(right, k)
        return (left << half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(np.asarray(x, np.uint64), back)
        while (outside := out >= np.uint64(self.n)).any():
            out[outside] = self._once(out[outside], back)
        return out.astype(np.int64)

    def slot(self, sequence: np.ndarray) -> np.ndarray:
        return self._walk(sequence, False)

    def sequence(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, True)


@dataclass(frozen=True)
class Layout:
    """What a reader has to know: ``n`` sequences of ``length`` ids, ``per_shard`` records to a file, and the key."""

    n: int
    length: int
    per_shard: int
    key: int
    tokens: int

    @property
    def stride(self) -> int:
        return 2 * self.length + 1

    @property
    def order(self) -> Order:
        return Order(self.n, self.key)


SEQUENCE = "part int, nth bigint, ids binary, n_tokens int"


def sequences(docs: DataFrame, text: str, length: int, vocabulary: str) -> str:
    """Write (part, nth, ids, n_tokens) of the running ids of each split to a shared folder; the last one of a split is
    filled up with the end token."""
    schema = pa.schema([("part", pa.int32()), ("nth", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, end = TaskContext.get().partitionId(), 0, encoding(vocabulary).eot_token
        rest = np.empty(0, "<u2")

        def out(block: np.ndarray, sizes: list[int]) -> pa.RecordBatch:
            nonlocal nth
            rows = [block[i : i + length].tobytes() for i in range(0, len(block), length)]
            numbers = list(range(nth, nth + len(rows)))
            nth += len(rows)
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(([part] * len(rows), numbers, rows, sizes), schema, strict=True)], schema=schema)

        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                ids = [np.array([*encode(t or "", vocabulary, specials=False), end], "<u2") for t in batch.column(0).slice(first, 256).to_pylist()]
                block = np.concatenate([rest, *ids])
                whole = len(block) // length * length
                rest = block[whole:]
                if whole:
                    yield out(block[:whole], [length] * (whole // length))
        if len(rest):
            yield out(np.concatenate([rest, np.full(length - len(rest), end, "<u2")]), [len(rest)])

    folder = new_folder(docs.sparkSession, "sequences")
    docs.select(text).mapInArrow(run, SEQUENCE).write.option("compression", "zstd").parquet(folder)
    return folder


def _in_small_batches(spark: SparkSession, folder: str, records: int = 1024) -> DataFrame:
    """The stored sequences, read through a session that hands a few megabytes of them to Python at a time."""
    session = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.session.timeZone"):
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    return session.read.schema(SEQUENCE).parquet(folder)


def write_shards(
    docs: DataFrame,
    folder: str,
    *,
    text: str = "text",
    length: int = 2048,
    per_shard: int = 4096,
    key: int = 1,
    vocabulary: str | None = None,
) -> Layout:
    """Write the shards of ``docs`` below ``folder``, as shard=<number>/<one file>, and the layout beside them.

    A null or empty text is just the end token; repeated rows are written each; other columns aren't read; an empty table
    gives a layout of no sequences. Vocabularies of more than 65536 ids don't fit and are refused. A task that is repeated
    replaces its files. No task holds more than a shard.
    """
    spark = docs.sparkSession
    path = vocabulary or default_vocabulary()
    if encoding(path).n_vocab > 2**16:
        raise ValueError("16-bit records hold 65536 ids at most")
    cut = sequences(docs, text, length, path)
    parts = spark.read.schema(SEQUENCE).parquet(cut).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"))
    parts = stored(parts)
    n, tokens = parts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    layout = Layout(n, length, per_shard, key, tokens)
    spark.createDataFrame([(json.dumps(asdict(layout)),)], "value string").coalesce(1).write.text(f"{folder}/layout")
    # one row per input split
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    blob = pa.schema([("shard", pa.int64()), ("slots", pa.binary()), ("records", pa.binary())])

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block per shard and batch: its records, compressed together."""
        pack = zstandard.ZstdCompressor(3)
        for batch in batches:
            slot = layout.order.slot(batch.column(0).to_numpy())
            records, shard = batch.column(1), slot // per_shard
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.diff(shard[order])) + 1
            rows = [(int(shard[g[0]]), slot[g].tobytes(), pack.compress(b"".join(records[i].as_py() for i in g))) for g in np.split(order, cuts) if len(g)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), blob, strict=True)], schema=blob)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The records of a shard, which lie together, in the order of their slots."""
        unpack, wide = zstandard.ZstdDecompressor(), 2 * length
        shard, slots, blocks = None, [], []

        def out() -> Iterator[pa.RecordBatch]:
            place = np.concatenate(slots)
            data = b"".join(unpack.decompress(b) for b in blocks)
            order = np.argsort(place)
            for some in np.split(order, range(512, len(order), 512)):
                values = [data[i * wide : (i + 1) * wide] for i in some]
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(values), pa.int64()), pa.array(values, pa.binary())], names=["shard", "record"])

        for batch in batches:
            for s, place, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s != shard and slots:
                    yield from out()
                    slots, blocks = [], []
                shard = s
                slots.append(np.frombuffer(place, np.int64))
                blocks.append(block)
        if slots:
            yield from out()

    numbered = _in_small_batches(spark, cut).join(offsets, "part").select(F.col("before") + F.col("nth"), "ids")
    shards = max(1, -(-n // per_shard))
    dealt = numbered.mapInArrow(scatter, "shard bigint, slots binary, records binary").repartition(shards, "shard").sortWithinPartitions("shard")
    rows = dealt.mapInArrow(gather, "shard bigint, record binary").select("shard", F.col("record").cast("string").alias("value"))
    rows.write.partitionBy("shard").text(f"{folder}/shards")
    return layout


def read_layout(spark: SparkSession, folder: str) -> Layout:
    return Layout(**json.loads(spark.read.text(f"{folder}/layout").first()[0]))


def read_shards(spark: SparkSession, folder: str, first_slot: int = 0) -> DataFrame:
    """slot, sequence, shard, record, ids (binary, unsigned 16 bit) from ``first_slot`` on, without opening earlier shards."""
    layout = read_layout(spark, folder)
    schema = pa.schema([("slot", pa.int64()), ("sequence", pa.int64()), ("shard", pa.int64()), ("record", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, first = content.as_buffer(), shard * layout.per_shard
                count = min(layout.per_shard, layout.n - first)
                if data.size != count * layout.stride:
                    raise ValueError(f"shard {shard} has {data.size} bytes instead of {count * layout.stride}")
                for some in np.split(np.arange(max(0, first_slot - first), count), range(512, count, 512)):
                    ids = [data.slice(i * layout.stride, layout.stride - 1).to_pybytes() for i in some.tolist()]
                    slot = first + some
                    columns = [slot, layout.order.sequence(slot) if len(slot) else slot, np.full(len(slot), shard), some, ids]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    if not layout.n:
        return spark.createDataFrame([], "slot bigint, sequence bigint, shard bigint, record bigint, ids binary")
    files = spark.read.format("binaryFile").load(f"{folder}/shards")
    wanted = files.where(F.col("shard") >= first_slot // layout.per_shard).select(F.col("shard").cast("bigint"), "content")
    return wanted.mapInArrow(run, "slot bigint, sequence bigint, shard bigint, record bigint, ids binary")


def materialised(docs: DataFrame, **options) -> DataFrame:
    """Write the shards to a new shared folder and read them back."""
    folder = new_folder(docs.sparkSession, "shards")
    write_shards(docs, folder, **options)
    return read_shards(docs.sparkSession, folder)
