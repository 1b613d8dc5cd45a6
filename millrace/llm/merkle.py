"""A Merkle manifest of a table: one tree of hashes per group, and one over the groups' roots.

Rows are leaves in id order; every ``arity`` consecutive nodes become one. Only the leaves and every ``every``-th level are
stored. To prove a row, the aligned subtree that it stands in, of at most ``arity ** every`` stored nodes, is built again
in one row: its missing levels are made, each leaf's siblings are read off them, and the levels are dropped. The siblings
above come from the stored level on top, proved the same way first, so a proof is put together from the root down and
each subtree meets what is above it once, not once per leaf.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import placed, running_total
from millrace.session import stored

_PATH = "array<struct<l:string,r:string>>"


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value that can't run into its neighbours: its length in bytes, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return hashed(*[field(v) for v in values])


@dataclass(frozen=True)
class Shape:
    arity: int = 8
    every: int = 3

    @property
    def subtree(self) -> int:
        return self.arity**self.every


@dataclass(frozen=True)
class Forest:
    """Stored levels 0, ``every``, 2 * ``every``, ... as (tree, idx, node, row, left), ``left`` being the levels still above,
    and the root of each tree (tree, node, band), ``band`` telling the stored level below it."""

    levels: list[DataFrame]
    roots: DataFrame


def _parents(nodes: Column, arity: int) -> Column:
    """The next level of an array of nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / F.lit(arity)).cast("int"))
    return F.transform(runs, lambda i: hashed(F.array_join(F.slice(nodes, i * arity + 1, F.lit(arity)), "")))


def _subtrees(level: DataFrame, shape: Shape) -> DataFrame:
    """(tree, piece, left, rows, l0, l1, ...): the stored nodes of each aligned subtree in order, and its levels up to the next
    stored one; a level above the root repeats it."""
    piece = F.floor(F.col("idx") / F.lit(shape.subtree)).cast("bigint").alias("piece")
    nodes = F.array_sort(F.collect_list(F.struct("idx", "node", "row")))
    out = level.groupBy("tree", piece).agg(F.first("left").alias("left"), nodes.alias("_nodes"))
    out = out.select("tree", "piece", "left", F.col("_nodes.row").alias("rows"), F.col("_nodes.node").alias("l0"))
    for k in range(1, shape.every + 1):
        below = F.col(f"l{k - 1}")
        out = out.withColumn(f"l{k}", F.when(F.col("left") >= k, _parents(below, shape.arity)).otherwise(below))
    return out


def _numbered(nodes: DataFrame, order: Sequence[str], shape: Shape) -> DataFrame:
    """``nodes`` (tree, node, row and the columns of ``order``) with their place in their tree and the levels above, stored."""
    one = nodes.select("tree", "node", "row", *[c for c in order if c != "node"], F.lit(1).cast("bigint").alias("_one"))
    ranked = stored(running_total(placed(one, ["tree", *order]), ["tree"], order, "_one", "_upto"))
    powers = F.array(*[F.lit(shape.arity**k).cast("bigint") for k in range(int(log(2**62, shape.arity)))])
    heights = ranked.groupBy("tree").agg(F.max("_upto").alias("_n"))
    heights = heights.select("tree", F.size(F.filter(powers, lambda p: p < F.col("_n"))).alias("left"))
    return ranked.join(heights, "tree").select("tree", (F.col("_upto") - 1).alias("idx"), "node", "row", "left")


def grown(leaves: DataFrame, order: Sequence[str], shape: Shape) -> Forest:
    """The trees over ``leaves`` (tree, node, row and the columns of ``order``)."""
    level = stored(_numbered(leaves, order, shape))
    levels, roots = [], []
    while True:
        levels.append(level)
        # the highest tree only: one number
        highest = level.agg(F.max("left")).first()[0] or 0
        tops = stored(_subtrees(level, shape).select("tree", F.col("piece").alias("idx"), F.col(f"l{shape.every}")[0].alias("node"), "left"))
        roots.append(tops.where(F.col("left") <= shape.every).select("tree", "node", F.lit(len(levels) - 1).alias("band")))
        if highest <= shape.every:
            return Forest(levels, reduce(DataFrame.unionByName, roots))
        level = tops.where(F.col("left") > shape.every).select(
            "tree", "idx", "node", F.lit(None).cast(level.schema["row"].dataType).alias("row"), (F.col("left") - shape.every).alias("left")
        )


def _siblings(i: Column, shape: Shape) -> Column:
    """What stands left and right of the i-th node of a subtree in its run, at each of the subtree's levels."""
    steps = []
    for k in range(shape.every):
        at = F.floor(i / F.lit(shape.arity**k)).cast("int")
        nth = at % shape.arity
        run = at - nth
        before = F.array_join(F.slice(F.col(f"l{k}"), run + 1, nth), "")
        after = F.array_join(F.slice(F.col(f"l{k}"), at + 2, shape.arity - 1 - nth), "")
        steps.append(F.when(F.col("left") > k, F.struct(before.alias("l"), after.alias("r"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def proved(forest: Forest, above: DataFrame, shape: Shape) -> DataFrame:
    """(tree, idx, node, row, path, known) of every leaf; ``above`` (tree, path, known) is what comes after each tree's root.

    ``path`` holds per level the hashes left and right of the node, ``known`` is passed down to every leaf of the tree.
    """
    ends = forest.roots.select("tree", "band").join(above, "tree")
    path: DataFrame | None = None
    for band in range(len(forest.levels) - 1, -1, -1):
        tops = ends.where(F.col("band") == band).select("tree", F.lit(0).cast("bigint").alias("piece"), "path", "known")
        if path is not None:
            tops = tops.unionByName(stored(path.select("tree", F.col("idx").alias("piece"), "path", "known")))
        here = _subtrees(forest.levels[band], shape).join(tops, ["tree", "piece"])
        leaves = F.transform(
            F.sequence(F.lit(0), F.size("l0") - 1),
            lambda i: F.struct(
                (F.col("piece") * shape.subtree + i).alias("idx"),
                F.get("l0", i).alias("node"),
                F.get("rows", i).alias("row"),
                F.concat(_siblings(i, shape), F.col("path")).alias("path"),
                F.col("known").alias("known"),
            ),
        )
        path = here.select("tree", F.inline(leaves))
    return path


def folded(node: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, node, lambda acc, p: hashed(p["l"], acc, p["r"]))


def manifest(
    docs: DataFrame,
    columns: Mapping[str, Column],
    *,
    group: str,
    id: str,
    carried: Mapping[str, Column] | None = None,
    shape: Shape = Shape(),
) -> DataFrame:
    """One row per row of ``docs``: the id, leaf, subroot (of its group), root, path and the ``carried`` columns.

    A leaf hashes the ``columns`` in order. Groups come in byte order, null first; rows of a group by id, null first, and
    rows that share an id by their leaves, so repeated rows are neighbours with equal leaves (which of them is which makes no
    difference). A group of one row is its own subroot, and a single group's subroot is the root. Names of ``docs`` can't
    clash, as only the given expressions are read. An empty table has no rows and no root.
    """
    known = {id: F.col(id)} | dict(carried or {})
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    row = F.struct(*[c.alias(n) for n, c in known.items()])
    leaves = docs.select(tree.alias("tree"), leaf(list(columns.values())).alias("node"), row.alias("row"), F.col(id).alias("_id"))
    trees = grown(leaves, ["_id", "node"], shape)
    subroots = stored(trees.roots)
    top = subroots.select(F.lit("").alias("tree"), "node", F.struct(F.col("tree").alias("name")).alias("row"), F.col("tree").alias("name"))
    whole = grown(top, ["name"], shape)
    root = whole.roots.select("tree", F.array().cast(_PATH).alias("path"), F.struct("node").alias("known"))
    above = proved(whole, root, shape).select(
        F.col("row.name").alias("tree"), "path", F.struct(F.col("node").alias("subroot"), F.col("known.node").alias("root")).alias("known")
    )
    found = proved(trees, stored(above), shape)
    return found.select(
        f"row.{id}", F.col("node").alias("leaf"), "known.subroot", "known.root", "path", *[f"row.{n}" for n in known if n != id]
    )


def audited(found: DataFrame, given: Column) -> DataFrame:
    """The proofs of a ``manifest`` with proof_sha256, and folded_root and verified for the leaves that are ``given`` now."""
    proof = F.array_join(F.transform("path", lambda p: F.concat(p["l"], p["r"])), "")
    checked = found.withColumn("folded_root", folded(given, F.col("path")))
    return checked.withColumn("proof_sha256", F.sha2(proof.cast("binary"), 256)).withColumn("verified", F.col("folded_root") == F.col("root"))
