"""Near-duplicate groups by MinHash.

One permutation: a shingle's hash gives both its bin and its value, and a document's signature is the least value per bin.
A bin without shingles borrows from the first filled one in its own random order of bins (optimal densification), which
keeps the chance that two documents agree in a bin equal to their similarity. Runs of ``rows`` bins are hashed to buckets.

A bucket doesn't give all its pairs: one member, the centre, is compared with the others (a star). Every comparison is
exact, on full shingle sets. Links that a star can't see, between members that aren't like its centre, are found in
further rounds with new centres (four times as many each time), but only in buckets whose members are still in several
components, and only across these. Before sets are read, a sketch that holds the parity of the shingles in each of 512 cells
drops pairs that can't be similar enough: two sets differ in at least as many shingles as their sketches in cells, so no
link is lost. So pairs stay in proportion to bucket sizes, and no link between buckets' members that
would join two components is lost. Documents with the same set are one node from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.graph import components
from millrace.llm.hashing import mixed, shingle_set, word_hashes
from millrace.session import stored


@dataclass(frozen=True)
class Banding:
    """32 bands of 5 bins miss a pair of similarity 0.8 three times in a million."""

    bands: int = 32
    rows: int = 5
    seed: int = 7

    @property
    def bins(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=4)
def _orders(bins: int, seed: int) -> np.ndarray:
    """For each bin, the random order in which it asks the others for a value."""
    rng = np.random.default_rng(seed)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def signature(shingles: np.ndarray, banding: Banding) -> np.ndarray:
    """The value of each bin, of a sorted non-empty set of hashes."""
    k = banding.bins
    bins = ((shingles >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(bins, prepend=np.uint64(k)))
    at = bins[first].astype(np.int64)
    out, filled = np.zeros(k, np.uint64), np.zeros(k, bool)
    out[at], filled[at] = shingles[first], True
    empty, orders, turn = np.flatnonzero(~filled), _orders(k, banding.seed), 0
    while len(empty):
        asked = orders[empty, turn]
        given = filled[asked]
        out[empty[given]] = out[asked[given]]
        empty, turn = empty[~given], turn + 1
    return out


def buckets(values: np.ndarray, banding: Banding) -> np.ndarray:
    """One 64-bit bucket per band."""
    bands = values.reshape(banding.bands, banding.rows)
    h = mixed(np.arange(1, banding.bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for r in range(banding.rows):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + bands[:, r])
    return h


CELLS = 512


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity of the number of shingles in each cell, 64 cells to a number."""
    cells = np.bincount((shingles & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def _sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    for text in column.cast(pa.binary()):
        yield shingle_set(word_hashes((text.as_py() or b"").lower()), words)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def fingerprints(docs: DataFrame, words: int, banding: Banding) -> DataFrame:
    """doc_id, n_shingles, digest of the set, its buckets and sketch (null without shingles), of a frame (doc_id, text)."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("buckets", longs), ("sketch", longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands, cells = [], [], [], []
            for s in _sets(batch.column(1), words):
                sizes.append(len(s))
                digests.append(_digest(s) if len(s) else None)
                bands.append(buckets(signature(s, banding), banding).view(np.int64) if len(s) else None)
                cells.append(sketch(s) if len(s) else None)
            columns = [batch.column(0), *(pa.array(v, f.type) for v, f in zip((sizes, digests, bands, cells), list(schema)[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, buckets array<bigint>, sketch array<bigint>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """digest and shingles of each row of a frame (doc_id, text) that has any."""
    schema = pa.schema([("digest", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                sets = [s for s in _sets(batch.column(1).slice(first, 256), words) if len(s)]
                columns = [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.mapInArrow(run, "digest binary, shingles array<bigint>")


def _can_link(percent: int) -> Column:
    """Whether sizes and sketches of two sets (n, sketch and _n, _s) allow the similarity: the smaller set has at least
    ``percent`` of the larger one's size, and they differ in few enough shingles."""
    differ = sum((F.bit_count(F.col("sketch")[k].bitwiseXOR(F.col("_s")[k])) for k in range(CELLS // 64)), F.lit(0))
    few = (100 + percent) * differ <= (100 - percent) * (F.col("n") + F.col("_n"))
    return (100 * F.least("n", "_n") >= percent * F.greatest("n", "_n")) & few


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) of digests whose sets have an intersection of at least ``percent`` of their union."""
    x = sets.select(F.col("digest").alias("x"), F.col("shingles").alias("_x"))
    y = sets.select(F.col("digest").alias("y"), F.col("shingles").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    return pairs.join(y, "y").join(x, "x").where(100 * both >= percent * (F.size("_x") + F.size("_y") - both)).drop("_x", "_y")


def near_groups(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    banding: Banding = Banding(),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (least id of the group), kept, n_texts.

    Rows without words (a null text has none) are linked with nothing. Rows that share an id count as linked, repeated
    rows as one document. A row without an id is linked with nothing: its component is null and it is kept. ``n_texts``
    counts the different shingle sets of the group. Other columns aren't read; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    prints = stored(fingerprints(texts, words, banding))
    known = prints.where("digest is not null and doc_id is not null")
    nodes = stored(known.groupBy("digest").agg(F.min("doc_id").alias("label"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch")))

    rows = nodes.select("digest", "n", "label", F.explode("buckets").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("among")).where("among > 1")
    members = stored(rows.join(shared, "bucket"))
    # the member that meets most others is most like them, so its star leaves least for later rounds
    met = members.groupBy("digest").agg(F.sum("among").alias("met")).join(nodes.select("digest", "sketch"), "digest")
    members = stored(members.drop("among").join(met, "digest"))
    wanted = members.select(F.col("label").alias("doc_id")).distinct()
    # the list of ids grows with the corpus, so it is never sent whole to every task
    sets = stored(full_sets(texts.join(wanted.hint("merge"), "doc_id"), words).groupBy("digest").agg(F.first("shingles").alias("shingles")))

    same_id = known.select(F.col("doc_id").alias("a"), "digest").join(nodes.select("digest", F.col("label").alias("b")), "digest").where("a <> b")
    links = same_id.select("a", "b").join(nodes.select(F.col("label").alias("a")).distinct(), "a")
    # an id over several texts links their labels, also where it is the label of none
    several = same_id.groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most")).where("least <> most")
    across = same_id.join(several, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    roots = stored(components(links.unionByName(across)))
    members, centres = stored(_relabelled(members, roots)), 1
    while True:
        mixed_buckets = members.groupBy("bucket").agg(F.min("label").alias("_l"), F.max("label").alias("_h")).where("_l <> _h").select("bucket")
        members = stored(members.join(mixed_buckets, "bucket"))
        if members.isEmpty():
            break
        in_order = Window.partitionBy("bucket").orderBy(F.col("met").desc(), "digest")
        chosen = stored(members.withColumn("_rn", F.row_number().over(in_order)).where(F.col("_rn") <= centres))
        star = chosen.select("bucket", F.col("digest").alias("x"), F.col("label").alias("a"), F.col("n").alias("_n"), F.col("sketch").alias("_s"))
        pairs = members.select("bucket", F.col("digest").alias("y"), F.col("label").alias("b"), "n", "sketch").join(star, "bucket")
        pairs = pairs.where((F.col("a") != F.col("b")) & _can_link(percent)).select("x", "y", "a", "b").distinct()
        new = stored(components(_linked(stored(pairs), sets, percent).select("a", "b")))
        roots = stored(_joined(roots, new))
        # a centre has now met all members of its bucket
        rest = members.join(chosen.select("bucket", "digest"), ["bucket", "digest"], "left_anti")
        members, centres = stored(_relabelled(rest, new)), centres * 4

    labels = nodes.select("digest", F.col("label").alias("id"), F.lit(1).alias("_node")).join(roots, "id", "left")
    labels = labels.select("digest", F.coalesce("root", "id").alias("component_id"))
    many = labels.groupBy("component_id").agg(F.count(F.lit(1)).alias("n_texts"))
    found = prints.join(stored(labels), "digest", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    )
    return found.join(many, "component_id", "left").select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        F.coalesce(F.when(F.col("digest").isNotNull(), F.col("n_texts")), F.lit(1)).cast("bigint").alias("n_texts"),
    )


def _relabelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    moved = rows.join(roots, F.col("label") == F.col("id"), "left")
    return moved.withColumn("label", F.coalesce("root", "label")).drop("id", "root")


def _joined(roots: DataFrame, new: DataFrame) -> DataFrame:
    """One map from ids to roots out of two, the second over the roots of the first."""
    later = new.select(F.col("id").alias("root"), F.col("root").alias("_root"))
    return roots.join(later, "root", "left").select("id", F.coalesce("_root", "root").alias("root")).union(new)


def without_near_copies(docs: DataFrame, *, id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one document per group, with their columns, whatever these are called.

    Rows without an id stay, and so do rows without words; repeated rows are one document, which stays or goes as a whole.
    """
    name = "_gone"
    while name in docs.columns:
        name += "_"
    gone = stored(near_groups(docs, id=id, **options).where("not kept").select(F.col("doc_id").alias(name)).distinct())
    return docs.join(gone, F.col(id) == F.col(name), "left_anti")
