"""Hard negatives by exact inner products of whole numbers, scored with tables instead of multiplications (four Russians).

A candidate's components are split into bit planes (two's complement), and the bits of eight dimensions of one plane make
one byte. For an anchor, the sums of its components over all 256 subsets of each eight dimensions are tabled. A plane's
share of the score is then one lookup per eight dimensions, and the planes are shifted and added up, from the sign down.

Candidates are kept in cells of neighbouring ids and anchors in groups; one task scores one group against one cell, holds
the cell only packed, reads the group block by block and keeps the best few of each anchor. What the tasks found is
ranked per anchor. So nothing is broadcast and no pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import with_identity
from millrace.session import stored

_BLOCK = 4096
_ANCHORS = 64
_CHUNK = 1024
#: cell and part tell the task, kind 0 comes before kind 1; n rows, their numbers, ids, labels, and planes or components.
_BLOCKS = "cell bigint, part bigint, kind int, first bigint, n int, bits int, nos binary, ids binary, labels binary, body binary, goals binary"
_FOUND = "anchor bigint, goal int, id bigint, score bigint"
_LEAST = np.iinfo(np.int64).min // 4


@dataclass(frozen=True)
class Grid:
    """Rows of a cell and anchors of a group: between the given bounds, and some ``tasks`` of each in between."""

    least_rows: int = 2**13
    most_rows: int = 2**20
    least_anchors: int = 2**6
    most_anchors: int = 2**14
    tasks: int = 16

    def rows(self, n: int) -> int:
        return min(self.most_rows, max(self.least_rows, -(-n // (4 * self.tasks))))

    def anchors(self, n: int) -> int:
        return min(self.most_anchors, max(self.least_anchors, -(-n // self.tasks)))


def whole_numbers(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component as bigint; null for a null vector or a component that is null or not finite."""
    values = F.transform(vector, lambda x: x.cast("double"))
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    big = F.raise_error(F.lit(f"a component times {factor} has more than 31 bits")).cast("bigint")
    floored = F.transform(values, lambda x: F.when(F.abs(x * factor) >= F.lit(2.0**31 - 1), big).otherwise(F.floor(x * factor).cast("bigint")))
    return F.when(usable, floored)


def planes(q: np.ndarray, bits: int) -> np.ndarray:
    """(bits, groups of eight, rows) bytes: the b-th bits of the components (rows, dimensions), eight dimensions to a byte."""
    rows, dims = q.shape
    groups = -(-dims // 8)
    padded = np.zeros((groups * 8, rows), np.int64)
    padded[:dims] = q.T
    out = np.empty((bits, groups, rows), np.uint8)
    for b in range(bits):
        out[b] = np.packbits(((padded >> b) & 1).astype(np.uint8).reshape(groups, 8, rows), axis=1, bitorder="little")[:, 0]
    return out


def bits_of(q: np.ndarray) -> int:
    """Bits that hold every component in two's complement."""
    return max(int(q.max()).bit_length(), (-int(q.min()) - 1).bit_length() if q.min() < 0 else 0) + 1 if q.size else 1


def tables(q: np.ndarray) -> np.ndarray:
    """(groups of eight, 256, anchors): sums of the components (anchors, dimensions) over each subset of eight dimensions."""
    anchors, dims = q.shape
    groups = -(-dims // 8)
    padded = np.zeros((groups * 8, anchors), np.int64)
    padded[:dims] = q.T
    out = np.zeros((groups, 256, anchors), np.int64)
    for b in range(8):
        out[:, 1 << b : 2 << b] = out[:, : 1 << b] + padded[b::8][:, None, :]
    return out


def scores(table: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(rows, anchors): inner products by lookups; ``packed`` are planes of the rows. Missing dimensions count as 0."""
    groups = min(len(table), packed.shape[1])
    total = np.zeros((packed.shape[2], table.shape[2]), table.dtype)
    for b in range(len(packed) - 1, -1, -1):
        if b < len(packed) - 1:
            total <<= 1
        for g in range(groups):
            part = table[g].take(packed[b, g], axis=0)
            # the highest plane is the sign
            (np.subtract if b == len(packed) - 1 else np.add)(total, part, out=total)
    return total


def _narrowed(table: np.ndarray, bits: int) -> np.ndarray:
    """The table with as few bytes per sum as the scores allow."""
    most = int(np.abs(table).max(initial=0)) * max(len(table), 1) << bits
    if most >= 2**62:
        raise OverflowError("scores don't fit into 64 bits")
    return table.astype(np.int32) if most < 2**31 else table


class Best:
    """The first ``k`` rows per anchor and goal, by score and then by place, of rows that come in id order."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low.copy(), high, k
        goals = low.shape[1]
        self.ids = [[np.empty(0, np.int64) for _ in range(goals)] for _ in low]
        self.scores = [[np.empty(0, np.int64) for _ in range(goals)] for _ in low]

    def add(self, found: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """``found`` and ``allowed`` are (rows, anchors)."""
        for goal in range(self.low.shape[1]):
            hits = (found >= self.low[:, goal]) & (found <= self.high[:, goal]) & allowed
            anchors, rows = np.nonzero(hits.T)
            if not len(anchors):
                continue
            values = found[rows, anchors].astype(np.int64)
            # by anchor, then score, then place: rows are in order already
            order = np.lexsort((-values, anchors))
            starts = np.flatnonzero(np.r_[True, np.diff(anchors[order]) > 0])
            for at, end in zip(starts, [*starts[1:], len(order)], strict=True):
                a, own = anchors[order[at]], order[at : min(end, at + self.k)]
                value = np.concatenate([self.scores[a][goal], values[own]])
                place = np.argsort(-value, kind="stable")[: self.k]
                self.scores[a][goal] = value[place]
                self.ids[a][goal] = np.concatenate([self.ids[a][goal], ids[rows[own]]])[place]
                if len(place) == self.k:
                    # a later row has a greater id, so it needs a better score
                    self.low[a, goal] = max(self.low[a, goal], value[place[-1]] + 1)


@dataclass
class _Rows:
    """Packed rows of a cell, in id order."""

    ids: np.ndarray
    labels: np.ndarray
    packed: np.ndarray

    def of(self, rows: np.ndarray) -> _Rows:
        return _Rows(self.ids[rows], self.labels[rows], self.packed[:, :, rows])


def _search(cell: list[_Rows], by_label: list[dict[int, _Rows]], ids, labels, q, goals, k: int, same: bool) -> tuple[list, list, list, list]:
    """(slot of the anchor, goal, id, score) of the best rows of a cell for a block of anchors; with ``same`` among other rows
    of the anchor's label, else among rows of other labels with a score within the goals."""
    out = ([], [], [], [])
    table = tables(q)
    parts = [(np.flatnonzero(labels == v), [x[v] for x in by_label if v in x]) for v in np.unique(labels)] if same else [(np.arange(len(ids)), cell)]
    for slots, blocks in parts:
        own = np.ascontiguousarray(table[:, :, slots])
        low, high = (goals[slots, :, 0], goals[slots, :, 1]) if not same else (np.full((len(slots), 1), _LEAST), np.full((len(slots), 1), -_LEAST))
        best = Best(low, high, k)
        for rows in blocks:
            narrow = _narrowed(own, len(rows.packed))
            for at in range(0, len(rows.ids), _CHUNK):
                piece = slice(at, at + _CHUNK)
                found = scores(narrow, rows.packed[:, :, piece])
                if same:
                    allowed = rows.ids[piece, None] != ids[None, slots]
                else:
                    allowed = rows.labels[piece, None] != labels[None, slots]
                best.add(found, rows.ids[piece], allowed)
        for n, slot in enumerate(slots):
            for goal in range(low.shape[1]):
                size = len(best.ids[n][goal])
                for column, values in zip(out, ([slot] * size, [goal] * size, best.ids[n][goal], best.scores[n][goal]), strict=True):
                    column.extend(values)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows, shorter ones padded with zeros."""
    lists = [np.asarray(x, np.int64) for x in column.to_pylist()]
    out = np.zeros((len(lists), max(map(len, lists), default=0)), np.int64)
    for row, x in zip(out, lists, strict=True):
        row[: len(x)] = x
    return out


def _block_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in _BLOCKS.split(", "))])


def _blocks(rows: DataFrame, kind: int, most: int, goals: int) -> DataFrame:
    """Blocks of up to ``most`` rows (key, no, id, label, q, goals) with one key, in the order of ``no``: (cell or part, ...)."""
    schema = _block_schema()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0))
            cuts = np.flatnonzero(np.r_[True, np.diff(keys) != 0]) if len(keys) else []
            for at, end in zip(cuts, [*cuts[1:], len(keys)], strict=True):
                for first in range(at, end, most):
                    part = batch.slice(first, min(most, end - first))
                    q, bits, key = _matrix(part.column(4)), 0, int(keys[first])
                    ids, labels, no = (np.asarray(part.column(c)).astype(np.int64) for c in (2, 3, 1))
                    if kind == 0:
                        bits = bits_of(q)
                        body = planes(q, bits)
                    else:
                        body = q
                    goal = np.full((len(ids), max(goals, 1), 2), 0, np.int64)
                    goal[:, :, 0] = 1  # no score lies between 1 and 0
                    for slot, given in enumerate(part.column(5).to_pylist() if goals else []):
                        for n, (low, high) in enumerate((g["low"], g["high"]) for g in given):
                            goal[slot, n] = low, high
                    row = (key, key, kind, int(no[0]), len(ids), bits, no.tobytes(), ids.tobytes(), labels.tobytes(), body.tobytes(), goal.tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return rows.mapInArrow(run, _BLOCKS)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for n in range(batch.num_rows):
            yield batch.slice(n, 1).to_pylist()[0]


def _whole(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.int64)


def _scored(cells: DataFrame, anchors: DataFrame, counts: tuple[int, int], k: int, goals: int, same: bool) -> DataFrame:
    """(anchor, goal, id, score): the best ``k`` rows of each cell per anchor and goal."""
    n_cells, n_parts = counts
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = cells.drop("part").withColumn("part", up_to(n_parts))
    right = anchors.drop("cell").withColumn("cell", up_to(n_cells))
    schema = pa.schema([("anchor", pa.int64()), ("goal", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, cell, by_label = None, [], []
        for row in _block_rows(batches):
            if (row["cell"], row["part"]) != task:
                task, cell, by_label = (row["cell"], row["part"]), [], []
            ids, labels = _whole(row["ids"]), _whole(row["labels"])
            if row["kind"] == 0:
                packed = np.frombuffer(row["body"], np.uint8)
                own = _Rows(ids, labels, packed.reshape(row["bits"], -1, row["n"]))
                cell.append(own)
                if same:
                    by_label.append({int(v): own.of(np.flatnonzero(labels == v)) for v in np.unique(labels)})
                continue
            q = _whole(row["body"]).reshape(row["n"], -1)
            wanted = _whole(row["goals"]).reshape(row["n"], max(goals, 1), 2)
            slots, goal, found, score = _search(cell, by_label, ids, labels, q, wanted, k, same)
            columns = (_whole(row["nos"])[np.array(slots, np.int64)], np.array(goal, np.int32), np.array(found, np.int64), np.array(score, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    both = left.select(*(x.split()[0] for x in _BLOCKS.split(", "))).unionByName(right)
    task = (F.col("cell") * n_parts + F.col("part")).cast("int")
    dealt = both.repartitionById(n_cells * n_parts, task).sortWithinPartitions("cell", "part", "kind", "first")
    return dealt.mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _hundredth(x: Column) -> Column:
    """A whole number by 100, rounded down."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100)).cast("bigint")


def hard_negatives(
    rows: DataFrame,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
    factor: int = 256,
    grid: Grid = Grid(),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, a row per negative.

    Scores are inner products of the vectors' whole numbers (``whole_numbers``). An anchor's positives are its best
    ``positives`` rows of the same label and another id, its negatives for a positive the best ``negatives`` rows of other
    labels whose score lies within ``percent`` of the positive's; equal scores come in id order.

    Rows without an id, a label or a usable vector take no part. Shorter vectors count as padded with zeros. Repeated rows
    are rows of their own: each of them is found, and each anchor among them has its own negatives, but a row with the
    anchor's id is never its positive. Components whose whole numbers have more than 31 bits, and scores beyond 64 bits, are
    errors. Other columns aren't read; an empty table has no negatives.
    """
    spark = rows.sparkSession
    named = F.col(label) if isinstance(label, str) else label
    usable = rows.select(
        F.col(id).cast("bigint").alias("id"), named.cast("bigint").alias("label"), whole_numbers(F.col(vector), factor).alias("q"), anchors.alias("asks")
    ).where("id is not null and label is not null and q is not null")
    usable = usable.withColumn("_tie", F.xxhash64("q"))
    known = stored(with_identity(usable, ["id", "label", "_tie"], "no"))
    asking = stored(with_identity(known.where("asks").drop("no"), ["id", "label", "_tie"], "no"))
    n, m = (df.agg(F.max("no")).first()[0] or 0 for df in (known, asking))
    if not n or not m:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    per_cell, per_part = grid.rows(n), grid.anchors(m)
    counts = -(-n // per_cell), -(-m // per_part)
    none = F.array().cast("array<struct<low:bigint,high:bigint>>").alias("goals")

    def keyed(df: DataFrame, size: int, number: int, goals: Column = none) -> DataFrame:
        key = F.call_function("div", F.col("no") - 1, F.lit(size)).alias("key")
        dealt = df.select(key, "no", "id", "label", "q", goals).repartitionById(number, F.col("key").cast("int"))
        return dealt.sortWithinPartitions("key", "no")

    cells = stored(_blocks(keyed(known, per_cell, counts[0]), 0, _BLOCK, 0))
    near = _scored(cells, _blocks(keyed(asking, per_part, counts[1]), 1, _ANCHORS, 0), counts, positives, 0, same=True)
    found = stored(_ranked(near, ["anchor"], positives).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), (F.col("rank") - 1).alias("goal")))

    least, most = percent
    # score * 100 lies between both bounds: the lower one is rounded up, the upper one down
    bounds = F.struct(
        (-_hundredth(F.col("positive_score") * -least)).alias("low"), _hundredth(F.col("positive_score") * most).alias("high")
    )
    wanted = found.select("anchor", F.struct("goal", bounds.alias("bounds")).alias("g")).groupBy("anchor").agg(F.sort_array(F.collect_list("g")).alias("g"))
    goals = wanted.select(F.col("anchor").alias("no"), F.col("g.bounds").alias("goals"))
    aimed = _blocks(keyed(asking.join(goals, "no"), per_part, counts[1], F.col("goals")), 1, _ANCHORS, positives)
    far = _ranked(_scored(cells, aimed, counts, negatives, positives, same=False), ["anchor", "goal"], negatives)
    named_anchors = asking.select(F.col("no").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        far.select("anchor", "goal", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(found.join(named_anchors, "anchor"), ["anchor", "goal"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
