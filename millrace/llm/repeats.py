"""Removing repeated passages: every byte covered by a string of ``length`` bytes that also starts earlier.

Sorting all suffixes of a corpus would move each of its bytes a hundred times over. Only suffixes that can repeat are
sorted: the least of the hashed byte runs inside a window of ``length`` bytes is its anchor, which depends on the window's
bytes alone, so equal windows have equal anchors at equal distances. Windows of one anchor form a run of neighbours.

1. Documents are packed into chunks, kept in a table bucketed by chunk, so that later steps bring lists to the text.
2. Anchors that two chunks have in common are found from 8 bytes per chunk and distinct anchor.
3. Runs of shared anchors are compared by digest, each chunk sending a distinct run once: the later of two equal runs goes.
4. Where an anchor has runs of several kinds, the windows of the first run of each kind are sorted deep-shallow as
   suffixes (suffixes.py), and of equal windows the first stays. An anchor with very many kinds of runs is dealt out by
   window instead of by anchor, each distinct window once per chunk, and equal ones are read in order without being held.
5. Each chunk joins its removed intervals and cuts them out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.hashing import Rolling
from millrace.llm.suffixes import classes
from millrace.session import stored

SEGMENT = 1 << 18
_PLACE_BITS = np.uint64(22)
_FIRST = np.iinfo(np.int64).min
CHUNK = "chunk bigint, ids array<bigint>, sizes array<bigint>, blob binary"
RUN = np.dtype([("fp", "<u8"), ("kind", "<u8"), ("doc", "<i8"), ("lo", "<u4"), ("pos", "<u4"), ("n", "<u4")])
SPAN = np.dtype([("start", "<u4"), ("end", "<u4")])
#: What a row of step 4 holds: a run's bytes, one window, spans that are known already.
_RUNS, _LONE, _DONE = range(3)


def _batches(run: Callable[..., Iterator[tuple]], schema: str, rows: int = 64) -> Callable:
    """A function for mapInArrow out of one from an iterator of row tuples to an iterator of row tuples."""
    out = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                yield from zip(*(c.to_pylist() for c in batch.slice(first, rows).columns), strict=True)

    def write(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], f.type) for i, f in enumerate(out)], schema=out)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for row in run(read(batches)):
            waiting.append(row)
            if len(waiting) == rows:
                yield write(waiting)
                waiting = []
        if waiting:
            yield write(waiting)

    return apply


def _chunks(docs: DataFrame, size: int) -> DataFrame:
    """Whole documents packed into rows of about ``size`` bytes, in order of their ids, with a byte between two."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        pack, part, n = zstandard.ZstdCompressor(3), TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, bytes]] = []
        weight = 0

        def out() -> tuple:
            held.sort(key=lambda d: _FIRST if d[0] is None else d[0])
            return (part << 32) + n, [d[0] for d in held], [len(d[1]) for d in held], pack.compress(b"\n".join(d[1] for d in held))

        for doc, text in rows:
            body = (text or "").encode("utf-8")
            if held and weight + len(body) > size:
                yield out()
                held, weight, n = [], 0, n + 1
            held.append((doc, body))
            weight += len(body) + 1
        if held:
            yield out()

    return docs.mapInArrow(_batches(run, CHUNK, 1), CHUNK)


def _unpacked(sizes: list[int], blob: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The chunk's bytes and where its documents begin and end."""
    ends = np.cumsum(np.array(sizes, np.int64) + 1) - 1
    return zstandard.ZstdDecompressor().decompress(blob), ends - np.array(sizes, np.int64), ends


def _anchored(data: bytes, begins: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that lie in one document and share their anchor: anchor hash, anchor, first window, number."""
    buf, window = np.frombuffer(data, np.uint8), length - gram + 1
    found = []
    for s in range(0, len(buf) - length + 1, SEGMENT):
        part = buf[s : s + SEGMENT + length - 1]
        grams = len(part) - gram + 1
        at = np.arange(grams)
        h = Rolling(part).pieces(at, at + gram)
        # the least hash, the later one of equal ones
        key = (h >> _PLACE_BITS << _PLACE_BITS) | (np.uint64((1 << 22) - 1) - at.astype(np.uint64))
        blocks = np.concatenate([key, np.full(-grams % window, 2**64 - 1, np.uint64)]).reshape(-1, window)
        before = np.minimum.accumulate(blocks, 1).ravel()
        after = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        n = grams - window + 1
        least = np.minimum(after[:n], before[window - 1 : window - 1 + n])
        anchor = ((1 << 22) - 1) - (least & np.uint64((1 << 22) - 1)).astype(np.int64)
        p = np.arange(n)
        doc = np.searchsorted(ends, p + s, "right")
        inside = (p + s >= begins[np.minimum(doc, len(ends) - 1)]) & (p + s + length <= ends[np.minimum(doc, len(ends) - 1)])
        p, anchor = p[inside], anchor[inside]
        if not len(p):
            continue
        cuts = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(p) != 1)) + 1
        first = np.concatenate([[0], cuts])
        number = np.diff(np.concatenate([first, [len(p)]]))
        found.append((h[anchor[first]], anchor[first] + s, p[first] + s, number))
    if not found:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _split(values: np.ndarray, number: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Values by their numbers."""
    order = np.argsort(number, kind="stable")
    cuts = np.flatnonzero(np.diff(number[order])) + 1
    for some in np.split(order, cuts):
        if len(some):
            yield int(number[some[0]]), values[some]


def _shared(buckets: int, length: int, gram: int) -> tuple[Callable, Callable]:
    """Steps 2: distinct anchors of each chunk by bucket; per bucket, those of at least two chunks, given back by chunk."""

    def send(rows: Iterator[tuple]) -> Iterator[tuple]:
        for chunk, sizes, blob in rows:
            fps = np.unique(_anchored(*_unpacked(sizes, blob), length, gram)[0])
            for bucket, some in _split(fps, (fps >> np.uint64(40)).astype(np.int64) % buckets):
                yield bucket, chunk, some.tobytes()

    def meet(rows: Iterator[tuple]) -> Iterator[tuple]:
        def out(held: list[tuple[int, np.ndarray]]) -> Iterator[tuple]:
            fps = np.concatenate([f for _, f in held])
            owner = np.repeat(np.arange(len(held)), [len(f) for _, f in held])
            order = np.argsort(fps, kind="stable")
            fps, owner = fps[order], owner[order]
            same = fps[1:] == fps[:-1]
            many = np.zeros(len(fps), bool)
            many[1:] |= same
            many[:-1] |= same
            for k, some in _split(fps[many], owner[many]):
                yield held[k][0], some.tobytes()

        now, held = None, []
        for bucket, chunk, fps in rows:
            if bucket != now and held:
                yield from out(held)
                held = []
            now = bucket
            held.append((chunk, np.frombuffer(fps, np.uint64)))
        if held:
            yield from out(held)

    return send, meet


def _kinds(buckets: int, length: int, gram: int) -> tuple[Callable, Callable]:
    """Step 3: the runs of shared anchors, each kind once per chunk; per bucket, the first run of each kind stays.

    Rows that meet gives: (chunk, spans to remove, null), (null, null, first runs with their chunks).
    """

    def send(rows: Iterator[tuple]) -> Iterator[tuple]:
        for chunk, ids, sizes, blob, lists in rows:
            data, begins, ends = _unpacked(sizes, blob)
            fp, anchor, pos, n = _anchored(data, begins, ends, length, gram)
            values, count = np.unique(fp, return_counts=True)
            elsewhere = np.concatenate([np.frombuffer(x, np.uint64) for x in lists or []] or [np.empty(0, np.uint64)])
            keep = np.isin(fp, np.concatenate([elsewhere, values[count > 1]]))
            if not keep.any():
                continue
            fp, anchor, pos, n = fp[keep], anchor[keep], pos[keep], n[keep]
            kind = Rolling(np.frombuffer(data, np.uint8), 11).pieces(pos, pos + n + length - 1)
            kind ^= (anchor - pos).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            doc = np.searchsorted(ends, pos, "right")
            run = np.empty(len(fp), RUN)
            numbers = np.array([_FIRST if i is None else i for i in ids], np.int64)
            run["fp"], run["kind"], run["doc"], run["lo"], run["pos"], run["n"] = fp, kind, numbers[doc], pos - begins[doc], pos, n
            gone, first = _first_of(run)
            if len(gone):
                yield -1 - chunk % buckets, chunk, _spans(gone, length).tobytes()
            mix = (first["kind"] ^ first["fp"]) >> np.uint64(40)
            for bucket, some in _split(first, mix.astype(np.int64) % buckets):
                yield bucket, chunk, some.tobytes()

    def meet(rows: Iterator[tuple]) -> Iterator[tuple]:
        def out(held: list[tuple[int, np.ndarray]]) -> Iterator[tuple]:
            run = np.concatenate([r for _, r in held])
            owner = np.repeat(np.array([c for c, _ in held]), [len(r) for _, r in held])
            gone, first = _first_of(run, owner)
            for chunk, some in _split(*gone):
                yield chunk, _spans(some, length).tobytes(), None, None, None, None
            for r, chunk in zip(first[0].tolist(), first[1].tolist(), strict=True):
                yield chunk, None, int(np.uint64(r[0]).view(np.int64)), r[4], r[5], r[2]

        now, held = None, []
        for bucket, chunk, body in rows:
            if bucket < 0:
                yield chunk, body, None, None, None, None
                continue
            if bucket != now and held:
                yield from out(held)
                held = []
            now = bucket
            held.append((chunk, np.frombuffer(body, RUN)))
        if held:
            yield from out(held)

    return send, meet


def _first_of(run: np.ndarray, owner: np.ndarray | None = None):
    """(later ones, first ones) of equal runs; runs at the same place of the same id count as the same. With their owners."""
    order = np.lexsort((run["lo"], run["doc"], run["kind"], run["fp"]))
    run = run[order]
    new = np.ones(len(run), bool)
    new[1:] = (run["fp"][1:] != run["fp"][:-1]) | (run["kind"][1:] != run["kind"][:-1])
    head = run[np.flatnonzero(new)[np.cumsum(new) - 1]]
    gone = (run["doc"] != head["doc"]) | (run["lo"] != head["lo"])
    if owner is None:
        return run[gone], run[new]
    owner = owner[order]
    return (run[gone], owner[gone]), (run[new], owner[new])


def _spans(run: np.ndarray, length: int) -> np.ndarray:
    out = np.empty(len(run), SPAN)
    out["start"], out["end"] = run["pos"], run["pos"] + run["n"] + (length - 1)
    return out


def _lone(chunk: int, data: bytes, begins: np.ndarray, ends: np.ndarray, asked: list[tuple[int, int, int]], length: int) -> Iterator[tuple]:
    """The windows of runs (first window, number, doc) of one chunk, equal ones once; the spans of the later ones."""
    number = np.array([n for _, n, _ in asked])
    pos = np.repeat(np.array([at for at, _, _ in asked]) - np.cumsum(number) + number, number) + np.arange(number.sum())
    doc = np.repeat(np.array([d for _, _, d in asked], np.int64), number)
    lo = pos - begins[np.searchsorted(ends, pos, "right")]
    key = Rolling(np.frombuffer(data, np.uint8)).pieces(pos, pos + length)
    order = np.lexsort((lo, doc, key))
    pos, doc, lo, key = pos[order], doc[order], lo[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    gone = (doc != doc[head]) | (lo != lo[head])
    for k in np.flatnonzero(gone).tolist():  # equal hashes are no proof
        at, first = int(pos[k]), int(pos[head[k]])
        gone[k] = data[at : at + length] == data[first : first + length]
    if gone.any():
        at = np.sort(pos[gone])
        first = np.concatenate([[0], np.flatnonzero(np.diff(at) != 1) + 1])
        spans = np.empty(len(first), SPAN)
        spans["start"], spans["end"] = at[first], at[np.concatenate([first[1:], [len(at)]]) - 1] + length
        yield chunk, _DONE, chunk, None, None, None, spans.tobytes()
    stay = ~gone
    for k, d, x, at in zip(key[stay].view(np.int64).tolist(), doc[stay].tolist(), lo[stay].tolist(), pos[stay].tolist(), strict=True):
        yield k, _LONE, chunk, d, x, at, data[at : at + length]


def _windows(length: int, crowd: int) -> tuple[Callable, Callable]:
    """Step 4: the bytes of the runs asked for; the windows of the runs that come together, sorted.

    Runs of one anchor are gathered, at most ``crowd`` of them. Windows of other anchors come one by one, equal ones
    in order of their documents: each is compared with the first, and none but the first is kept in mind.
    """

    def send(rows: Iterator[tuple]) -> Iterator[tuple]:
        for chunk, sizes, blob, asked in rows:
            data, begins, ends = _unpacked(sizes, blob)
            crowded = []
            for a in asked:
                at, n = a["pos"], a["n"]
                if a["kinds"] > crowd:
                    crowded.append((at, n, a["doc"]))
                    continue
                lo = at - int(begins[np.searchsorted(ends, at, "right")])
                yield a["fp"], _RUNS, chunk, a["doc"], lo, at, data[at : at + n + length - 1]
            if crowded:
                yield from _lone(chunk, data, begins, ends, crowded, length)

    def meet(rows: Iterator[tuple]) -> Iterator[tuple]:
        def out(held: list[tuple]) -> Iterator[tuple]:
            bodies = [h[6] for h in held]
            number = np.array([len(b) - length + 1 for b in bodies])
            base = np.cumsum([0, *map(len, bodies[:-1])])
            owner = np.repeat(np.arange(len(held)), number)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            same = classes(b"".join(bodies), base[owner] + step, length)
            many = np.flatnonzero(same >= 0)
            doc = np.array([h[3] for h in held], np.int64)[owner[many]]
            lo = np.array([h[4] for h in held], np.int64)[owner[many]] + step[many]
            order = np.lexsort((lo, doc, same[many]))
            many, doc, lo = many[order], doc[order], lo[order]
            new = np.diff(same[many], prepend=-2) != 0
            head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(many) else many
            gone = np.sort(many[(doc != doc[head]) | (lo != lo[head])])
            chunk, pos = np.array([h[2] for h in held], np.int64), np.array([h[5] for h in held], np.int64)
            cuts = np.flatnonzero((np.diff(gone) != 1) | (np.diff(owner[gone]) != 0)) + 1
            spans = np.empty(len(cuts) + 1 if len(gone) else 0, SPAN)
            if len(gone):
                first, last = gone[np.concatenate([[0], cuts])], gone[np.concatenate([cuts, [len(gone)]]) - 1]
                spans["start"], spans["end"] = pos[owner[first]] + step[first], pos[owner[last]] + step[last] + length
                for c, some in _split(spans, chunk[owner[first]]):
                    yield c, some.tobytes()

        def told(later: list[tuple[int, int]]) -> Iterator[tuple]:
            spans = np.empty(len(later), SPAN)
            spans["start"] = np.array([at for _, at in later])
            spans["end"] = spans["start"] + length
            for c, some in _split(spans, np.array([c for c, _ in later])):
                yield c, some.tobytes()

        now, held, weight = None, [], 0
        head: tuple | None = None
        later: list[tuple[int, int]] = []
        for row in rows:
            key, what, chunk, doc, lo, pos, body = row
            if what == _DONE:
                yield chunk, body
            elif what == _LONE:
                if head is None or head[0] != body:
                    head = body, doc, lo
                elif head[1:] != (doc, lo):
                    later.append((chunk, pos))
                    if len(later) == 4096:
                        yield from told(later)
                        later = []
            else:
                if key != now and weight > 4_000_000:
                    yield from out(held)
                    held, weight = [], 0
                now = key
                held.append(row)
                weight += len(body)
        if held:
            yield from out(held)
        if later:
            yield from told(later)

    return send, meet


def _cut(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Step 5: each document of a chunk without its removed spans."""
    for ids, sizes, blob, lists in rows:
        data, begins, ends = _unpacked(sizes, blob)
        spans = np.concatenate([np.frombuffer(x, SPAN) for x in lists or []] or [np.empty(0, SPAN)])
        spans = spans[np.argsort(spans["start"], kind="stable")]
        start, reach = spans["start"].astype(np.int64), np.maximum.accumulate(spans["end"].astype(np.int64))
        new = np.ones(len(start), bool)
        new[1:] = start[1:] > reach[:-1]
        first = np.flatnonzero(new)
        start, end = start[first], reach[np.concatenate([first[1:], [len(reach)]]) - 1] if len(first) else reach
        at = np.searchsorted(start, begins)
        to = np.searchsorted(start, ends)
        for k, doc in enumerate(ids):
            b, e, own = int(begins[k]), int(ends[k]), []
            here = list(zip(start[at[k] : to[k]].tolist(), end[at[k] : to[k]].tolist(), strict=True))
            for x, y in here:
                own.append(data[b:x])
                b = y
            left = b"".join([*own, data[b:e]])
            yield doc, e - int(begins[k]), e - int(begins[k]) - len(left), len(here), left


def without_repeats(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    length: int = 100,
    gram: int = 36,
    chunk_bytes: int = 1 << 21,
    crowd: int = 2048,
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and left, the bytes that stay (binary).

    Texts are UTF-8 bytes, null is empty; strings don't reach over documents. Documents are ordered by id, one without id
    comes before all others. Rows that share an id are versions of one document: bytes at the same place in them don't
    count as repeated, so repeated rows have equal results. What is left may not be whole UTF-8, hence bytes. Other
    columns aren't read; an empty table gives an empty result. ``finish`` is applied before the result is stored.

    ``chunk_bytes`` is what a task works on at a time (a longer document is a chunk of its own), ``crowd`` the number of
    kinds of runs from which on an anchor's windows are dealt out one by one. Neither changes the result.
    """
    if length - gram < 8 or gram < 8:
        raise ValueError("windows must be 8 bytes longer than the hashed runs, which take 8 bytes at least")
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    name = f"chunks_{uuid.uuid4().hex}"
    texts = docs.select(F.col(id).cast("bigint"), F.col(text))
    _chunks(texts, chunk_bytes).repartition(n, "chunk").write.bucketBy(n, "chunk").option("compression", "none").saveAsTable(name)
    chunks = spark.table(name)

    def with_lists(lists: DataFrame, kind: str = "left") -> DataFrame:
        return chunks.join(lists.hint("shuffle_hash"), "chunk", kind)

    def stepped(rows: DataFrame, send: Callable, sent: str, meet: Callable, met: str, key: str, *order: str | Column) -> DataFrame:
        dealt = rows.mapInArrow(_batches(send, sent), sent).repartition(n, key).sortWithinPartitions(key, *order)
        return stored(dealt.mapInArrow(_batches(meet, met, 1024), met))

    send, meet = _shared(n, length, gram)
    block = "bucket bigint, chunk bigint, body binary"
    shared = stepped(chunks.select("chunk", "sizes", "blob"), send, block, meet, "chunk bigint, body binary", "bucket")
    lists = shared.groupBy("chunk").agg(F.collect_list("body").alias("lists"))

    send, meet = _kinds(n, length, gram)
    asked = with_lists(lists).select("chunk", "ids", "sizes", "blob", "lists")
    run = "chunk bigint, spans binary, fp bigint, pos bigint, n int, doc bigint"
    runs = stepped(asked, send, block, meet, run, "bucket")
    firsts = runs.where("fp is not null").select("fp", "chunk", "pos", "n", "doc")
    kinds = firsts.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = firsts.join(kinds, "fp").groupBy("chunk").agg(F.collect_list(F.struct("fp", "pos", "n", "doc", "kinds")).alias("asked"))

    send, meet = _windows(length, crowd)
    window = "key bigint, what int, chunk bigint, doc bigint, lo bigint, pos bigint, body binary"
    rows = with_lists(wanted, "inner").select("chunk", "sizes", "blob", "asked")
    lone = F.when(F.col("what") == _LONE, F.col("body"))
    sorted_ = stepped(rows, send, window, meet, "chunk bigint, spans binary", "key", "what", lone, "doc", "lo")

    spans = runs.where("spans is not null").select("chunk", "spans").unionByName(sorted_)
    spans = spans.groupBy("chunk").agg(F.collect_list("spans").alias("lists"))
    out = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, left binary"
    result = stored(finish(with_lists(spans).select("ids", "sizes", "blob", "lists").mapInArrow(_batches(_cut, out), out)))
    spark.sql(f"DROP TABLE {name}")
    return result
