"""Document fingerprints by consistent weighted sampling.

A document is a set of weighted terms: its runs of five words, weighted by how often they occur. For each of its samples,
every term draws r and c from Gamma(2, 1) and b from (0, 1), from hashes of the term and the sample alone. A term of weight
w has t = floor(ln w / r + b) and the rank ln c - r (t - b + 1); the term of least rank is the sample, together with
its t. Two documents have the same sample with the chance of their generalised Jaccard similarity, the sum of the lesser
over the sum of the greater weights. A fingerprint is a row of samples, hashed to 16 bits each.

Next to a document's fingerprint stand those of the next document and of an edited text made with it. Documents are sorted
into ranges of ids, and each task reads its range as a stream. The last document of a range meets the first one of the next
range afterwards, a pair per range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.hashing import mixed, word_hashes
from millrace.session import stored

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Draws per term and sample: two for r, two for c, one for b.
_DRAWS = 5


@dataclass(frozen=True)
class Sampling:
    """64 samples tell a similarity to 0.06 (one standard error, at most)."""

    samples: int = 64
    words: int = 5
    seed: int = 13


def weighted_terms(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of ``size`` words, and how often each occurs; all words are one run when there are fewer."""
    words = word_hashes(data)
    if not len(words):
        return words, np.empty(0)
    size = min(size, len(words))
    n = len(words) - size + 1
    h = words[:n].copy()
    for k in range(1, size):
        h = mixed(h * _MIX + words[k : k + n])
    return np.unique(h, return_counts=True)


def _spread(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 32-bit values over all others, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(factor)
    h ^= h >> np.uint32(16)
    return h


def _uniform(h: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1 out of the upper 24 bits."""
    return ((h >> np.uint32(8)).view(np.int32).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)


class Draws:
    """The ranks of weighted terms (distinct pairs of a term and a weight), sample by sample."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, sampling: Sampling):
        own = [mixed(terms + k) for k in np.arange(1, 4, dtype=np.uint64) * _MIX]
        halves = [half for h in own for half in (h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32))]
        self._words, self._names = halves[:_DRAWS], halves[_DRAWS]
        self._high = (self._names >> np.uint32(16)).astype(np.uint64)
        self._seeds = np.random.default_rng(sampling.seed).integers(0, 2**32, (sampling.samples, _DRAWS), dtype=np.uint32)
        # most terms occur once, and then t is 0
        self._heavy = np.flatnonzero(weights != 1)
        self._logs = np.log(weights[self._heavy]).astype(np.float32)

    def gammas(self, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """r, c and b of each term."""
        u = [_uniform(_spread(w ^ s)) for w, s in zip(self._words, self._seeds[sample], strict=True)]
        least = np.float32(1e-7)
        return np.maximum(-np.log(u[0] * u[1]), least), np.maximum(-np.log(u[2] * u[3]), least), u[4]

    def ranked(self, sample: int) -> np.ndarray:
        """The rank of each term above 16 bits that name the term and its t, in one number."""
        r, c, b = self.gammas(sample)
        log_c = np.log(c)
        rank, names, heavy = log_c - r * (np.float32(1) - b), self._high, self._heavy
        if len(heavy):
            t = np.floor(self._logs / r[heavy] + b[heavy])
            rank[heavy] = log_c[heavy] - r[heavy] * (t - b[heavy] + np.float32(1))
            names = names.copy()
            told = _spread(self._names[heavy] + t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
            names[heavy] = np.where(t == 0, names[heavy], told >> np.uint32(16))
        # above zero, where the bits of a float are in the order of its value
        rank += np.float32(128)
        return (np.maximum(rank, np.float32(0)).view(np.uint32).astype(np.uint64) << np.uint64(16)) | names


def signatures(documents: list[tuple[np.ndarray, np.ndarray]], sampling: Sampling) -> np.ndarray:
    """(documents, samples) of 16 bits; documents are (terms, weights) and have a term each."""
    terms, weights = (np.concatenate([d[k] for d in documents]) for k in (0, 1))
    starts = np.cumsum([0, *(len(t) for t, _ in documents[:-1])])
    # what several texts share, as an edited text and its original do, is drawn once
    _, first, place = np.unique(mixed(terms + weights.astype(np.uint64) * _MIX), return_index=True, return_inverse=True)
    draws = Draws(terms[first], weights[first], sampling)
    out = np.empty((len(documents), sampling.samples), "<u2")
    for sample in range(sampling.samples):
        out[:, sample] = np.minimum.reduceat(draws.ranked(sample)[place], starts) & np.uint64(0xFFFF)
    return out


def prints(texts: list[str], sampling: Sampling) -> list[bytes]:
    """The fingerprint of each text: its samples of two bytes; no bytes without words."""
    terms = [weighted_terms(t.encode("utf-8", "surrogatepass"), sampling.words) for t in texts]
    filled = [n for n, (t, _) in enumerate(terms) if len(t)]
    out = [b""] * len(texts)
    if filled:
        for n, row in zip(filled, signatures([terms[n] for n in filled], sampling), strict=True):
            out[n] = row.tobytes()
    return out


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal samples; 1 for two texts without words, 0 for one with and one without."""
    if not a or not b:
        return float(a == b)
    return float(np.mean(np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")))


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as many characters from the start of the following text, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
#: A range's first and last document, with their texts, beside the results; ``place`` is the number of the range.
_ROWS = f"{_RESULT}, place int, edge string, text string"
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
_SCHEMA = pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in _ROWS.split(", "))])
_AT_ONCE = 1 << 18


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def _result(doc_id: int | None, text: str, changed: str, own: bytes, of_changed: bytes, of_next: bytes) -> tuple:
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, own, of_changed, likeness(own, of_changed), likeness(own, of_next)


def _compared(rows: list[tuple[int | None, str]], known: bytes | None, sampling: Sampling) -> tuple[list[tuple], bytes]:
    """Results of all rows but the last, whose fingerprint is returned; ``known`` is that of the first if it was made before."""
    texts = [text for _, text in rows]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    made = prints([*(texts if known is None else texts[1:]), *changed], sampling)
    own, of_changed = (made[: len(texts)], made[len(texts) :]) if known is None else ([known, *made[: len(texts) - 1]], made[len(texts) - 1 :])
    return [
        _result(doc, text, new, own[n], of_changed[n], own[n + 1])
        for n, ((doc, text), new) in enumerate(zip(rows, changed, strict=False))
    ], own[-1]


def _read(docs: DataFrame, sampling: Sampling) -> DataFrame:
    """Results of all rows of sorted partitions but each one's last, then its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, size, known, first = TaskContext.get().partitionId(), [], 0, None, None
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                said = text.as_py() or ""
                held.append((doc.as_py(), said))
                size += len(said)
                first = first or held[0]
                if size >= _AT_ONCE and len(held) > 1:
                    found, known = _compared(held, known, sampling)
                    yield _batch([(*row, place, None, None) for row in found])
                    held, size = held[-1:], len(said)
        if held:
            found, _ = _compared(held, known, sampling)
            ends = [(first[0], *[None] * 6, place, "first", first[1]), (held[-1][0], *[None] * 6, place, "last", held[-1][1])]
            yield _batch([(*row, place, None, None) for row in found] + ends)

    return docs.mapInArrow(run, _ROWS)


def _joined_edges(edges: DataFrame, sampling: Sampling) -> DataFrame:
    """The result of the last document of each range, with the first one of the next range, or of the first after the last."""
    # a narrow row per range
    places = edges.where("edge = 'first'").select("place")
    in_order = Window.orderBy("place")
    after = places.select("place", F.coalesce(F.lead("place").over(in_order), F.min("place").over(Window.partitionBy())).alias("_next"))
    heads = edges.where("edge = 'first'").select(F.col("place").alias("_next"), F.col("text").alias("following"))
    pairs = edges.where("edge = 'last'").join(after, "place").join(heads, "_next").select("doc_id", "text", "following")
    kinds = pa.schema(list(_SCHEMA)[:7])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                doc, text, following = (c[n].as_py() for c in batch.columns)
                changed = edited(text, following)
                row = _result(doc, text, changed, *prints([text, changed, following], sampling))
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, kinds, strict=True)], schema=kinds)

    return pairs.mapInArrow(run, _RESULT)


def fingerprinted(docs: DataFrame, *, id: str = "doc_id", text: str = "text", sampling: Sampling = Sampling()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (binary), near_edited,
    near_next.

    The next document is the one after it in id order, null ids first, and the first one after the last; rows that share an id
    are ordered by their texts, so repeated rows follow each other. A null text counts as empty. Texts without words have
    an empty fingerprint, like each other and unlike all others. A single row is its own next document. Other
    columns aren't read, and an empty table gives an empty result.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    in_order = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    read = stored(_read(in_order, sampling))
    names = [x.split()[0] for x in _RESULT.split(", ")]
    return read.where("edge is null").select(*names).unionByName(_joined_edges(read.where("edge is not null"), sampling))


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.hex(fingerprint))
