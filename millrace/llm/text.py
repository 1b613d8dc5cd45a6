"""Column helpers shared by the operators: words, lower-casing of A-Z, and values computed once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stored

GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def lower_az(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII takes the fast way with the same result."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words between spaces and the control characters 9 to 13; none for null."""
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP)),
    )


def with_place(docs: DataFrame) -> DataFrame:
    """The rows with ``_file`` and ``_row``, the place of their content: a frame that isn't read straight from files is stored first."""
    place = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    try:
        return docs.select("*", *place)
    except AnalysisException:
        return stored(docs).select("*", *place)
