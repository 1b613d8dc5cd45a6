"""As-of lookup: what was known about a key at the time of each fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import placed


def lookup_as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    at: str,
    columns: Sequence[str],
    *,
    start: str = "start_time",
    end: str | None = "end_time",
    how: str = "left",
) -> DataFrame:
    """Facts with the ``columns`` of the version of their key that holds at time ``at``: ``start <= at < end``.

    ``keys`` are names that both sides have, or fact columns with their version columns. A null end is open, and so is every
    version without ``end``. Intervals of a key shouldn't overlap: the version with the latest start counts, and of several
    with that start always the same one. A fact without a version, with a null key or a null time, keeps nulls, or goes if
    ``how`` is ``inner``.

    Facts and versions are sorted together into ranges of key and time. Inside a range the last version is carried over to
    the facts behind it; the first facts of a range take it from the key's earlier ranges, of which one row each is
    looked at. So a key with most of the rows is spread over many ranges, and no pair of a fact and a version that doesn't
    hold is ever made.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    names = [f"_k{n}" for n in range(len(pairs))]
    clash = set(columns) & set(facts.columns)
    if clash or how not in ("left", "inner"):
        raise ValueError(f"columns on both sides: {sorted(clash)}" if clash else f"how is left or inner, not {how}")
    valid_to = F.col(end) if end is not None else F.lit(None).cast(versions.schema[start].dataType)
    version = F.struct(valid_to.alias("_end"), *[F.col(c) for c in columns])
    known = versions.where(F.col(start).isNotNull()).select(
        *[F.col(c).alias(n) for c, n in zip(pairs.values(), names, strict=True)], F.col(start).alias("_t"), F.lit(0).alias("_kind"), version.alias("_version")
    )
    fact = F.struct(*[F.col(c) for c in facts.columns])
    asked = facts.select(*[F.col(c).alias(n) for c, n in zip(pairs, names, strict=True)], F.col(at).alias("_t"), F.lit(1).alias("_kind"), fact.alias("_fact"))
    rows = known.withColumn("_tie", F.xxhash64("_version")).unionByName(asked.withColumn("_tie", F.xxhash64("_fact")), allowMissingColumns=True)
    order = ["_t", "_kind", "_tie"]
    rows = placed(rows, [*names, *order])

    inside = Window.partitionBy(*names, "_place").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max_by("_version", F.when(F.col("_kind") == 0, F.struct("_t", "_tie")))
    # one row per key and range that it touches
    earlier = Window.partitionBy(*names).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*names, "_place").agg(last.alias("_last")).select(*names, "_place", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    met = rows.withColumn("_seen", F.last("_version", ignorenulls=True).over(inside)).where("_kind = 1")
    met = met.join(carried, [*names, "_place"], "left").withColumn("_held", F.coalesce("_seen", "_carried"))
    keyed = F.lit(True)
    for n in names:
        keyed &= F.col(n).isNotNull()
    holds = keyed & F.col("_t").isNotNull() & F.col("_held").isNotNull() & (F.col("_held._end").isNull() | (F.col("_t") < F.col("_held._end")))
    if how == "inner":
        met = met.where(holds)
    return met.select("_fact.*", *[F.when(holds, F.col("_held")[c]).alias(c) for c in columns])
