"""Row-level changes for plain tables: update, delete, merges and change capture.

Spark has no MERGE, UPDATE or DELETE for plain files, so each function returns the new table (or the
rows to append) as a frame; ``sources.versions`` writes it. A staging batch is taken to be much smaller
than its target: the target is only ever the left side of a left or semi join with the batch, so Spark
broadcasts a batch below its own size limit and the target is not shuffled; above the limit it
falls back to a sort-merge join by itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import first_per_key


def update_where(df: DataFrame, test: Column, values: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(test, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in values.items()})


def delete_where(df: DataFrame, test: Column) -> DataFrame:
    """Rows for which the test is false or unknown."""
    return df.where(~F.coalesce(test, F.lit(False)))


def any_changed(pairs: Sequence[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """Whether any pair differs. A change from or to null counts only when ``null_safe``."""
    tests = [~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False)) for old, new in pairs]
    return reduce(lambda a, b: a | b, tests)


def latest_per_key(staging: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One staging row per key, so that a merge has a single answer."""
    return first_per_key(staging, keys, newest_first)


def merge_scd1(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    now: Column | None = None,
    stamp: str = "update_timestamp",
    null_safe: bool = False,
) -> DataFrame:
    """Target with changed rows overwritten and stamped, new rows added, identical rows left alone.

    ``staging`` holds one row per key (see ``latest_per_key``); ``now`` is the query's own time unless given.
    """
    now = F.localtimestamp() if now is None else now
    new = staging.select(*keys, F.struct(*columns).alias("_new"))
    matched = target.join(new, list(keys), "left")
    changed = F.col("_new").isNotNull() & any_changed([(F.col(c), F.col(f"_new.{c}")) for c in columns], null_safe)
    kept = matched.select(
        *keys,
        *[F.when(changed, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns],
        F.when(changed, now).otherwise(F.col(stamp)).alias(stamp),
    )
    added = missing_from(staging, target, keys).select(*keys, *columns, now.alias(stamp))
    return kept.unionByName(added)


def missing_from(staging: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staging rows whose key the target lacks.

    The target's key columns are first cut down to the keys in staging; the anti join then has two small sides.
    """
    known = target.select(*keys).join(staging.select(*keys), list(keys), "left_semi").distinct()
    return staging.join(known, list(keys), "left_anti")


def merge_insert_only(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to append: staging rows with a key the target lacks."""
    return missing_from(staging, target, keys).select(*target.columns)


def merge_changes(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    now: Column,
    stamp: str = "update_timestamp",
    null_safe: bool = False,
) -> DataFrame:
    """The change rows ``merge_scd1`` causes, found from the batch alone instead of comparing two whole snapshots."""
    touched = target.join(staging.select(*keys), list(keys), "left_semi")
    old = touched.select(*keys, F.struct(*columns, stamp).alias("_old"))
    new = staging.select(*keys, F.struct(*columns, now.alias(stamp)).alias("_new"))
    both = new.join(old, list(keys), "left")
    changed = F.col("_old").isNull() | any_changed(
        [(F.col(f"_old.{c}"), F.col(f"_new.{c}")) for c in columns], null_safe
    )
    return _change_rows(both.where(changed), keys, [*columns, stamp])


def diff_snapshots(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows between two states of a table with distinct keys.

    ``action`` is INSERT or DELETE; an update gives a DELETE row with the old values and an INSERT row
    with the new ones, both with ``is_update`` true.
    """
    columns = [c for c in before.columns if c not in keys]
    old = before.select(*keys, F.struct(*columns).alias("_old"))
    new = after.select(*keys, F.struct(*columns).alias("_new"))
    return _change_rows(old.join(new, list(keys), "full_outer"), keys, columns)


def _change_rows(both: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    old, new = F.col("_old"), F.col("_new")
    is_update = old.isNotNull() & new.isNotNull()
    images = F.array(
        F.struct(F.lit("DELETE").alias("action"), old.alias("_row")),
        F.struct(F.lit("INSERT").alias("action"), new.alias("_row")),
    )
    rows = both.where(~old.eqNullSafe(new)).select(*keys, is_update.alias("is_update"), F.inline(images))
    return rows.where("_row is not null").select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns], "action", "is_update")
