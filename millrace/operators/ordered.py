"""Order-based work that never puts a whole group, or the whole table, into one task.

A plain window over a hot key sorts that key's rows in a single task. Here the rows are cut into
pieces first, each piece is handled on its own, and only one small row per piece is combined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order; all columns break ties, so the choice is repeatable.

    The ``= 1`` on the row number makes Spark keep one row per key and task before it shuffles.
    """
    ties = [F.col(c).asc_nulls_first() for c, kind in df.dtypes if c not in keys and not kind.startswith(("map", "variant"))]
    if not order and not ties:
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_n_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int, rank: str = "rn") -> DataFrame:
    """First ``n`` rows per group. Spark trims each task to ``n`` rows per group before the shuffle."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def next_time_in_key(df: DataFrame, keys: Sequence[str], ts: str, name: str, piece: str = "DAY") -> DataFrame:
    """Next later ``ts`` of the same key, null for the last; needs (keys, ts) to be distinct.

    A key's time line is cut into pieces (days by default). The next row is looked for inside the
    piece; the last row of a piece takes the start of the key's next piece that has rows.
    """
    cut = df.withColumn("_piece", F.date_trunc(piece, F.col(ts)))
    inside = Window.partitionBy(*keys, "_piece").orderBy(ts)
    across = Window.partitionBy(*keys).orderBy("_piece")
    heads = cut.groupBy(*keys, "_piece").agg(F.min(ts).alias("_head"))
    after = heads.select(*keys, "_piece", F.lead("_head").over(across).alias("_after"))
    return (
        cut.withColumn("_inside", F.lead(ts).over(inside))
        .join(after, [*keys, "_piece"], "left")
        .withColumn(name, F.coalesce("_inside", "_after"))
        .drop("_piece", "_inside", "_after")
    )


def placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows range-partitioned by ``order`` with their partition number in ``_place``, stored so that it stays fixed."""
    return stored(df.repartitionByRange(*order).withColumn("_place", F.spark_partition_id()))


def running_total(df: DataFrame, groups: Sequence[str], order: Sequence[str], weight: str, name: str) -> DataFrame:
    """Running sum of ``weight`` inside each group in the given (distinct) order, of rows ``placed`` by groups and order."""
    per_place = df.groupBy(*groups, "_place").agg(F.sum(weight).alias("_sum"))
    # one row per range partition and group that touches it
    earlier = Window.partitionBy(*groups).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_place.select(*groups, "_place", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*groups, "_place").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("_inside", F.sum(weight).over(inside))
        .join(offsets, [*groups, "_place"])
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .drop("_place", "_inside", "_offset")
    )


def with_identity(df: DataFrame, order: Sequence[str], name: str = "id", after: Column | int = 0) -> DataFrame:
    """Gap-free ids from ``after + 1`` on, in key order; ``order`` must be distinct.

    ``after`` is the greatest id given out so far, as a number or a scalar subquery over the target table.
    """
    first = after if isinstance(after, Column) else F.lit(after)
    rows = placed(df, order)
    counts = rows.groupBy("_place").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition, so this window stays small
    offsets = counts.select(
        "_place",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )
    inside = F.row_number().over(Window.partitionBy("_place").orderBy(*order))
    return (
        rows.withColumn("_inside", inside)
        .join(offsets, "_place")
        .withColumn(name, (first + F.col("_offset") + F.col("_inside")).cast("bigint"))
        .drop("_place", "_inside", "_offset")
    )
