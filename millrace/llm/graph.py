"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the least node it knows."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    up = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return up.union(least.select("a", F.col("m").alias("b"))).distinct()


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for each id in ``edges`` (a, b) but the roots themselves; a root is the least id of its component."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    sign = _sign(now)
    while True:
        now = stored(_small_star(stored(_large_star(now))))
        last, sign = sign, _sign(now)
        if sign == last:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
