"""Grouped reports. Every one has a map-side partial step, so a hot group shrinks before it is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import Amount, Floating, amount, as_double, floating, in_units


def sum_by(df: DataFrame, keys: Sequence[str], what: Amount | Floating, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(what.sum().alias(name))


def sum_grouping_sets(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], what: Amount, name: str) -> DataFrame:
    """Sums over several key sets, with ``level`` (the grouping id) telling subtotals from real nulls.

    The finest sums are made first: the copy per grouping set then multiplies group rows, not input rows.
    """
    finest = df.groupBy(*keys).agg(what.total().alias("_part"))
    grouped = finest.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys])
    return grouped.agg(in_units(F.sum("_part"), what.digits).alias(name), F.grouping_id().cast("int").alias("level"))


def conditional_sums(df: DataFrame, keys: Sequence[str], what: Amount, cases: Mapping[str, Column]) -> DataFrame:
    """One sum column per case; rows outside a case count as zero, so a group never shows null."""
    sums = [F.coalesce(what.when(test).sum(), F.lit(0.0)).alias(name) for name, test in cases.items()]
    return df.groupBy(*keys).agg(*sums)


def growth(df: DataFrame, key: str, what: Amount, year: Column, first: int, second: int) -> DataFrame:
    """Sums of two years and their difference, per key."""
    sums = {f"sales_{y}": F.coalesce(what.when(year == y).total(), F.lit(0)) for y in (first, second)}
    totals = df.groupBy(key).agg(*[total.alias(name) for name, total in sums.items()])
    before, after = (F.col(name) for name in sums)
    return totals.select(
        key, *[in_units(F.col(name), what.digits).alias(name) for name in sums], in_units(after - before, what.digits).alias("growth")
    )


def price_stats(df: DataFrame, key: str, price: str, digits: int | None = None) -> DataFrame:
    """Count, mean, least and greatest price per key; the same code serves batch and stream.

    Prices may have any digits. Where they are known to have at most ``digits``, the mean is that of the decimal numbers,
    and a price with more raises an error.
    """
    what = floating(price) if digits is None else amount(price, digits)
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        what.mean().alias("avg_price"),
        as_double(F.min(price)).alias("min_price"),
        as_double(F.max(price)).alias("max_price"),
    )


def value_counts(df: DataFrame, column: str, count_name: str = "n") -> DataFrame:
    """Rows per non-null value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count_name))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value and their per cent of all such rows, one decimal.

    The total is a scalar subquery over the counts: no window that would pull every value into one task.
    """
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", F.round(F.col("n") * F.lit(100) / total, 1).cast("double").alias("percent"))


def mean_by(df: DataFrame, key: str, what: Amount | Floating, name: str) -> DataFrame:
    """Mean per non-null key over non-null values."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(what.mean().alias(name))


def occurring_once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n = 1")


def occurring_repeatedly(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
