"""Best-fit packing by length patterns.

Pieces are counted by length: at most as many counts as a sequence has tokens, however many documents there are. Patterns
of up to three lengths that fill a sequence are fitted to that histogram by non-negative least squares; the fitted counts
are rounded, and what is left goes, longest first, where it fits best. The plan is a list of slots (length, ranks, sequence,
offset), and every piece finds its slot by its rank among the pieces of its length, which no task has to see together.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import default_vocabulary, encode
from millrace.session import new_folder, stored

_RANK_BITS = 48
PIECES = "doc_id bigint, piece int, start bigint, length int, ids binary, ids_crc32 bigint, part int, nth bigint"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: the first one takes what doesn't fill whole sequences."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, id: str, text: str, capacity: int, vocabulary: str, end: int) -> DataFrame:
    """Token ids of each document, ``end`` added, cut into pieces, with the number of its task and its place among the
    pieces of the same length in that task; written to the shared folder, so that these stay as they are."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32())]
        + [("ids", pa.binary()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                out = []
                for doc, said in zip(*(c.to_pylist() for c in batch.slice(first, 256).columns), strict=True):
                    ids = np.array([*encode(said or "", vocabulary, specials=True), end], "<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        own = ids[start : start + length].tobytes()
                        out.append((doc, k, start, length, own, zlib.crc32(own), part, seen[length]))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    folder = new_folder(docs.sparkSession, "pieces")
    rows = docs.select(F.col(id).cast("bigint"), F.col(text)).mapInArrow(run, PIECES)
    rows.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(PIECES).parquet(folder)


def patterns(lengths: np.ndarray, capacity: int, waste: int) -> np.ndarray:
    """Rows of three lengths (0: none), falling, that leave at most ``waste`` tokens free: each pair with the longest third
    that fits, each length with the longest second, and each length alone."""
    fits = np.full(capacity + 1, 0, np.int64)  # the longest length that is at most the index
    fits[lengths] = lengths
    fits = np.maximum.accumulate(fits)
    found = [np.array([[capacity, 0, 0]])] if fits[capacity] == capacity else []
    for a in lengths[lengths < capacity]:
        seconds = lengths[(lengths <= a) & (lengths <= capacity - a)]
        thirds = fits[np.minimum(seconds, capacity - a - seconds)]
        rows = np.column_stack([np.full(len(seconds), a), seconds, thirds])
        alone = fits[min(a, capacity - a)]
        found.append(np.vstack([rows, [[a, alone, 0]]]))
    rows = np.unique(np.vstack(found), axis=0) if found else np.empty((0, 3), np.int64)
    return rows[rows.sum(1) >= capacity - waste]


def fit(rows: np.ndarray, counts: np.ndarray, steps: int) -> np.ndarray:
    """Repeat counts of the patterns, not negative, whose lengths come nearest to ``counts`` in least squares.

    Accelerated projected gradient; lengths are weighted by the root of their share so that rare ones count too.
    """
    scale = max(counts.sum(), 1.0)
    want = counts / scale
    weight = 1.0 / np.sqrt(np.maximum(want, 1e-9))
    weight /= weight.max()
    used = rows > 0
    flat = np.where(used, rows, 0).ravel()

    def forward(x: np.ndarray) -> np.ndarray:
        out = np.bincount(flat, np.repeat(x, 3), len(counts))
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return np.where(used, r[rows], 0).sum(1)

    probe = np.ones(len(rows))
    for _ in range(12):
        probe = back(weight**2 * forward(probe))
        bound = np.linalg.norm(probe)
        probe /= max(bound, 1e-300)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - back(weight**2 * (forward(y) - want)) / (1.05 * max(bound, 1e-300)), 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x * scale


def plan(counts: np.ndarray, capacity: int, waste: int, steps: int) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """Patterns with their numbers of sequences, holding exactly ``counts`` (by length); the number of patterns that were fitted."""
    left = counts.astype(np.int64).copy()
    rows = patterns(np.flatnonzero(left), capacity, waste)
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    closed: dict[tuple[int, ...], int] = defaultdict(int)

    def put(pattern: tuple[int, ...], n: int) -> None:
        free = capacity - sum(pattern)
        if free:
            open_bins[free].append((pattern, n))
        else:
            closed[pattern] += n

    if len(rows):
        whole = np.floor(np.cumsum(fit(rows, counts.astype(float), steps)) + 0.5).astype(np.int64)
        times = np.diff(whole, prepend=0)
        for r in np.flatnonzero(times > 0):
            lengths, n = rows[r][rows[r] > 0], int(times[r])
            needed = np.bincount(lengths, minlength=len(left))
            n = int(min(n, *(left[u] // needed[u] for u in set(lengths.tolist()))))
            if n > 0:
                left -= needed * n
                put(tuple(int(v) for v in lengths), n)
    fitted = sum(closed.values()) + sum(n for b in open_bins.values() for _, n in b)
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            room = min((f for f, b in open_bins.items() if f >= length and b), default=None)
            if room is None:
                each = capacity // length
                put((length,) * each, n // each)
                if n % each:
                    put((length,) * (n % each), 1)
                break
            pattern, have = open_bins[room].pop()
            used = min(n, have)
            if used < have:
                open_bins[room].append((pattern, have - used))
            put((*pattern, length), used)
            n -= used
    for bins in open_bins.values():
        for pattern, n in bins:
            closed[pattern] += n
    return [(p, n) for p, n in sorted(closed.items()) if n], fitted


def slots(planned: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length and first rank), first sequence and offset of each run of pieces that sit alike."""
    next_rank: dict[int, int] = defaultdict(int)
    keys, firsts, offsets, sequence = [], [], [], 0
    for pattern, n in planned:
        offset = 0
        for length in pattern:
            keys.append((length << _RANK_BITS) + next_rank[length])
            firsts.append(sequence)
            offsets.append(offset)
            next_rank[length] += n
            offset += length
        sequence += n
    order = np.argsort(np.array(keys, np.int64))
    return tuple(np.array(x, np.int64)[order] for x in (keys, firsts, offsets))


def packed(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    vocabulary: str | None = None,
    end: int = 0,
    waste: int = 16,
    steps: int = 200,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (binary, unsigned 32 bit), ids_crc32, sequence_id, offset.

    A document's ids are those of its text and ``end``; a null or empty text is just ``end``. Only documents that are
    longer than a sequence are cut. Repeated rows are packed each, null ids are passed on, other columns aren't read, and
    an empty table gives no pieces. Columns that aren't asked for aren't read back, the ids among them.

    The driver holds the histogram (``capacity`` numbers) and the slots, whose number depends on ``capacity`` and not on
    the number of documents.
    """
    spark = docs.sparkSession
    cuts = pieces(docs, id, text, capacity, vocabulary or default_vocabulary(), end)
    per_part = stored(cuts.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    table = spark.sparkContext.broadcast(slots(plan(counts, capacity, waste, steps)[0]))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def slot(length, rank):
        import pandas as pd

        keys, firsts, places = table.value
        key = (length.to_numpy(np.int64) << _RANK_BITS) + rank.to_numpy(np.int64)
        at = np.searchsorted(keys, key, "right") - 1
        return pd.DataFrame({"sequence_id": firsts[at] + (key - keys[at]), "offset": places[at]})

    found = cuts.join(offsets, ["length", "part"]).withColumn("_slot", slot("length", F.col("_before") + F.col("nth")))
    return found.select(
        "doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"), "ids", "ids_crc32", "_slot.sequence_id", "_slot.offset"
    )
