"""Full row history (type-2 dimension): classify change rows, apply them, look at the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import open_end
from millrace.operators.ordered import first_per_key, next_time_in_key
from millrace.session import stored


def start_history(df: DataFrame, stamp: str = "update_timestamp") -> DataFrame:
    """History in which every row is open since its stamp."""
    return df.withColumnRenamed(stamp, "start_time").withColumns({"end_time": open_end(), "is_current": F.lit(True)})


def scd2_changes(
    changes: DataFrame, history: DataFrame, keys: Sequence[str], columns: Sequence[str], now: Column, stamp: str = "update_timestamp"
) -> DataFrame:
    """Change rows as history actions: ``I`` adds a version, ``U`` closes one, ``D`` closes one for good.

    Inserted and updated rows get their interval from the key's next start, each kind on its own time line.
    Open versions of updated keys stand on the second line as ``U`` rows without attributes, which gives
    them their end. Only a strictly later start closes an open version, so applying the same change rows
    twice changes nothing.

    The open history is read once, and what the batch touches of it is stored; ``changes`` is read several
    times, so pass rows that are stored.
    """
    keys, columns = list(keys), list(columns)
    point = [*keys, "start_time"]
    nothing = [F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in columns]

    # which open versions the batch touches: one row per key, small before and after the shuffle
    is_delete = F.col("action") == "DELETE"
    touched = changes.groupBy(*keys).agg(
        F.coalesce(F.bool_or(is_delete & F.col("is_update")), F.lit(False)).alias("_updated"),
        F.coalesce(F.bool_or(is_delete & ~F.col("is_update")), F.lit(False)).alias("_deleted"),
    )
    opened = stored(history.where("is_current").select(*point).join(touched.where("_updated or _deleted"), keys))

    images = changes.where("action = 'INSERT'").select(
        *keys, F.col(stamp).alias("start_time"), F.col("is_update").alias("_line"), F.struct(*columns).alias("_image"), F.lit(False).alias("_open")
    )
    marks = opened.where("_updated").select(
        *point, F.lit(True).alias("_line"), F.lit(None).cast(images.schema["_image"].dataType).alias("_image"), F.lit(True).alias("_open")
    )
    # images and an open version with the same start are one point on the key's line; of several images one is
    # chosen by its values, so that the choice is repeatable
    points = images.unionByName(marks).groupBy(*point, "_line").agg(F.min("_image").alias("_image"), F.bool_or("_open").alias("_open"))
    lines = next_time_in_key(points, [*keys, "_line"], "start_time", "_next")
    versions = lines.withColumns({"end_time": F.coalesce("_next", open_end()), "is_current": F.col("_next").isNull()})
    blank = F.struct(*nothing)
    actions = F.array(
        F.when(F.col("_image").isNotNull(), F.struct(F.lit("I").alias("dml_type"), F.col("_image").alias("_row"))),
        F.when(F.col("_open") & ~F.col("is_current"), F.struct(F.lit("U").alias("dml_type"), blank.alias("_row"))),
    )
    rest = ["start_time", "end_time", "is_current"]
    on_lines = versions.select(*keys, *rest, F.inline(F.array_compact(actions))).select(*keys, "_row.*", *rest, "dml_type")
    gone = opened.where("_deleted").select(
        *keys, *nothing, "start_time", now.alias("end_time"), F.lit(None).cast("boolean").alias("is_current"), F.lit("D").alias("dml_type")
    )
    return on_lines.unionByName(gone).distinct()


def apply_scd2(history: DataFrame, classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History after the classified changes, matched on (keys, start_time).

    A row both updated and deleted is closed at the earlier end.
    """
    match = [*keys, "start_time"]
    ends = classified.where("dml_type in ('U','D')").groupBy(*match).agg(F.min("end_time").alias("_end"))
    kept = (
        history.join(ends, match, "left")
        .withColumn("is_current", F.when(F.col("_end").isNotNull(), F.lit(False)).otherwise(F.col("is_current")))
        .withColumn("end_time", F.coalesce("_end", "end_time"))
        .select(*history.columns)
    )
    inserts = classified.where("dml_type = 'I'")
    known = history.select(*match).join(inserts.select(*match), match, "left_semi").distinct()
    added = first_per_key(inserts.join(known, match, "left_anti").select(*history.columns), match, [])
    return kept.unionByName(added)


def unstamped_updates(changes: DataFrame, history: DataFrame, keys: Sequence[str], stamp: str = "update_timestamp") -> DataFrame:
    """Updates that kept their old timestamp: they cannot become a version and need a look.

    Their new image and the open version share one start, so the history keeps the old values.
    """
    images = changes.where("action = 'INSERT' and is_update")
    same_start = history.select(*keys, F.col("start_time").alias(stamp))
    return images.join(same_start, [*keys, stamp], "left_semi")


def current_rows(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def closed_rows(history: DataFrame) -> DataFrame:
    return history.where("not is_current")


def versions_of(history: DataFrame, key: str, values: Sequence) -> DataFrame:
    return history.where(F.col(key).isin(*values))
