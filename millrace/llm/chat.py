"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share them: each distinct prefix of turns is a node, emitted once, in
depth-first order, as token ids with the position of its first token and the intervals of the token stream that its tokens
may attend to besides the node itself (its ancestors). A conversation is the way from a root to its last node.

Conversations sorted by their turns' digests visit the tree depth first, and a node belongs to the first one that has it:
the least rank per node, a sum-like aggregate that a very common first turn doesn't slow down. Turns of a conversation are
read one after another in sorted partitions, and only digests, positions and ancestors are kept in mind: no row and no
list holds a whole conversation, however long it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokens import default_vocabulary, encode, encoding
from millrace.operators.ordered import placed, running_total, with_identity
from millrace.session import stored

TURN, END = "### ", "</turn>\n"
PIECE = 1 << 16
_ESCAPED = re.compile(r"\\|### |</turn>")
_ESCAPED_ROLE = re.compile(r"\\|\n|### |</turn>")
_UNESCAPED = re.compile(r"\\(.)", re.S)
_PARSED = re.compile(r"### ((?:[^\\\n]|\\.)*)\n((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)


def opening(role: str) -> str:
    return TURN + _ESCAPED_ROLE.sub(r"\\\g<0>", role) + "\n"


def escaped(text: str) -> str:
    """A backslash before each backslash and each control string, so that none stands free in a text."""
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn; fails on anything that isn't a whole number of turns."""
    turns, at = [], 0
    while at < len(formatted):
        m = _PARSED.match(formatted, at)
        if not m:
            raise ValueError(f"no turn starts at character {at}")
        turns.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    return turns


def _streamed(df: DataFrame, run: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``run`` over the rows of each partition in their order, giving result rows; neither side is held as a whole."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                yield from zip(*(c.to_pylist() for c in batch.slice(first, 500).columns), strict=True)

    def write(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found, strict=True), out, strict=True)], schema=out)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, weight = [], 0
        for row in run(read(batches)):
            waiting.append(row)
            weight += 200 + sum(len(x) for x in row if isinstance(x, (bytes, str, list)))
            if len(waiting) == 2000 or weight > 1 << 22:
                yield write(waiting)
                waiting, weight = [], 0
        if waiting:
            yield write(waiting)

    return df.mapInArrow(apply, schema)


def _turn_digest(role: str | None, text: str | None) -> bytes:
    said = (role or "").encode("utf-8", "surrogatepass")
    return hashlib.sha256(len(said).to_bytes(8, "little") + said + (text or "").encode("utf-8", "surrogatepass")).digest()


def prefix_tree(
    turns: DataFrame,
    *,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
    vocabulary: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The nodes and the conversations of the tree over a frame with a row per turn.

    Nodes: start (place of the first token in the stream), n_tokens, position (of the first token in its conversation),
    depth, ids (binary, unsigned 32 bit), loss_from and loss_to (tokens of the node to learn from; equal if none), and
    attend (intervals of the stream, the node's own tokens besides). Conversations: conv_id, rank (their number in
    depth-first order), piece and path (starts of their nodes, ``PIECE`` to a row, so that a long one has several).

    Turns are ordered by number, then role and text; a null number comes first, null role and text count as empty, and
    repeated rows are repeated turns. Rows with a null id make up one conversation. Other columns aren't read. An empty
    table gives empty results.
    """
    path = vocabulary or default_vocabulary()
    same = F.col(id).cast("string").alias("same")  # ids that are one number only after the cast stay apart
    rows = turns.select(same, F.col(id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    in_turn = rows.repartition("same").sortWithinPartitions("same", "turn", "role", "text")

    def prefixes(rows: Iterator[tuple]) -> Iterator[tuple]:
        leaf, now = (TaskContext.get().partitionId() << 40) - 1, ()
        for own, conv, _, role, text in rows:
            if now != (own,):
                now, leaf, depth, whole, above = (own,), leaf + 1, 0, hashlib.sha256(), b""
            digest = _turn_digest(role, text)
            whole.update(digest)
            node = whole.digest()[:16]
            yield leaf, conv, depth, above, node, int.from_bytes(digest[:8], "little", signed=True), role or "", text or ""
            depth, above = depth + 1, node

    step = "leaf bigint, conv_id bigint, depth bigint, above binary, node binary, step bigint, role string, text string"
    steps = stored(_streamed(in_turn.select("same", "conv_id", "turn", "role", "text"), prefixes, step))

    # conversations part only after nodes that go on in several ways: a key of the steps taken there orders them like one
    # of all steps, and takes so many turns of others that it is no longer than the root of twice the number of rows
    forks = steps.where("depth > 0").groupBy("above").agg(F.min("node").alias("_l"), F.max("node").alias("_h")).where("_l <> _h").select("above")
    chosen = steps.where("depth > 0").select("leaf", "conv_id", "depth", "above", "step").join(forks, "above").drop("above")
    chosen = chosen.unionByName(steps.where("depth = 0").select("leaf", "conv_id", "depth", "step"))
    key = F.sort_array(F.collect_list(F.struct("depth", "step")))["step"].alias("key")
    ranked = stored(with_identity(chosen.groupBy("leaf").agg(key, F.min("conv_id").alias("conv_id")), ["key", "conv_id", "leaf"], "rank").drop("key"))

    passing = stored(steps.select("leaf", "depth", "node").join(ranked.select("leaf", "rank"), "leaf"))
    owners = passing.groupBy("node").agg(F.min_by("leaf", "rank").alias("leaf"), F.min("rank").alias("rank"))

    def tokenised(rows: Iterator[tuple]) -> Iterator[tuple]:
        for rank, depth, node, said, text in rows:
            parts = [encode(x, path, specials=False) for x in (opening(said), escaped(text), END)]
            ids = np.array(sum(parts, []), "<u4")
            first = len(parts[0]) if said == learn else 0
            yield rank, depth, node, ids.tobytes(), len(ids), first, first + len(parts[1]) if said == learn else 0

    node = "rank bigint, depth int, node binary, ids binary, n_tokens bigint, loss_from int, loss_to int"
    owned = steps.join(owners, ["node", "leaf"]).select("rank", "depth", "node", "role", "text")
    # stored, because dealing out by ranges reads its input twice
    own = placed(stored(_streamed(owned, tokenised, node)), ["rank", "depth"])
    nodes = stored(running_total(own, [], ["rank", "depth"], "n_tokens", "_end").withColumn("start", F.col("_end") - F.col("n_tokens")).drop("_end"))

    passed = passing.select("rank", "depth", "node").join(nodes.select("node", "start", "n_tokens", F.col("rank").alias("owner")), "node")
    passed = passed.select("rank", "depth", "start", "n_tokens", "owner").repartition("rank").sortWithinPartitions("rank", "depth")

    def attention(rows: Iterator[tuple]) -> Iterator[tuple]:
        """Pieces of paths; of nodes that the conversation owns, the first position and their ancestors' merged intervals."""
        now, piece, way = None, 0, []
        for rank, _, start, n, owner in rows:
            if rank != now or len(way) == PIECE:
                if way:
                    yield now, piece, way, None, None, None
                piece, way = (piece + 1 if rank == now else 0), []
            if rank != now:
                now, position, spans = rank, 0, []
            way.append(start)
            if owner == rank:
                yield None, None, None, start, position, list(spans)
            position += n
            if spans and spans[-1]["end"] == start:
                spans[-1] = {"start": spans[-1]["start"], "end": start + n}
            else:
                spans.append({"start": start, "end": start + n})
        if way:
            yield now, piece, way, None, None, None

    found = "rank bigint, piece bigint, path array<bigint>, start bigint, position bigint, attend array<struct<start:bigint,end:bigint>>"
    ways = stored(_streamed(passed, attention, found))
    tree = nodes.drop("node", "rank").join(ways.where("rank is null").select("start", "position", "attend"), "start")
    leaves = ranked.select("conv_id", "rank").join(ways.where("rank is not null").select("rank", "piece", "path"), "rank")
    return stored(tree), stored(leaves.select("conv_id", "rank", "piece", "path"))


def read_back(tree: DataFrame, leaves: DataFrame, vocabulary: str | None = None, learn: str = "assistant") -> DataFrame:
    """Per conversation, from ids, masks and paths alone: turns, their digest, and size and digest of what is learnt."""
    path = vocabulary or default_vocabulary()
    steps = stored(leaves.select("conv_id", "rank", F.explode("path").alias("start")))
    parts = steps.join(tree.select("start", "ids", "loss_from", "loss_to"), "start")
    parts = parts.select("rank", "conv_id", "start", "ids", "loss_from", "loss_to").repartition("rank").sortWithinPartitions("rank", "start")

    def digested(rows: Iterator[tuple]) -> Iterator[tuple]:
        coder, now, told = encoding(path), None, None
        for rank, conv, _, ids, loss_from, loss_to in rows:
            if rank != now:
                if told:
                    yield told()
                now, n, chars, learnt, said, loss = rank, 0, 0, 0, hashlib.sha256(), hashlib.sha256()

                def told(conv=conv):
                    return conv, n, said.hexdigest(), learnt, loss.hexdigest(), chars

            ids = np.frombuffer(ids, "<u4").tolist()
            formatted = coder.decode_bytes(ids).decode("utf-8")
            own = unescaped(coder.decode_bytes(ids[loss_from:loss_to]).decode("utf-8"))
            for r, t in parse(formatted):
                n += 1
                said.update(f"{r}\n{t}\n".encode())
            chars, learnt = chars + len(formatted), learnt + len(own)
            loss.update(own.encode("utf-8"))
        if told:
            yield told()

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return _streamed(parts, digested, schema)
