"""Date and time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end of a history row that is still open.
OPEN_END = "9999-12-31 00:00:00"


def ntz(text: str) -> Column:
    """Zone-less timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def open_end() -> Column:
    return ntz(OPEN_END)


def from_epoch_seconds(seconds: Column) -> Column:
    """UTC wall-clock time of an epoch second count."""
    return ntz("1970-01-01 00:00:00") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def to_epoch_seconds(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", ntz("1970-01-01 00:00:00"), ts)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Date in the text, or null when it does not follow the pattern."""
    return F.try_to_date(text, pattern)


def hour_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded year, month, day and hour, as landing folders are named."""
    parts = {"year": (F.year(ts), 4), "month": (F.month(ts), 2), "day": (F.dayofmonth(ts), 2), "hour": (F.hour(ts), 2)}
    return {name: F.lpad(part.cast("string"), width, "0") for name, (part, width) in parts.items()}
