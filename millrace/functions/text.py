"""Text cleaning as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java's \s is ASCII only; (?U) widens it to the Unicode blanks (no-break space included) that scraped text carries.
_EDGE_BLANKS = r"(?U)^\s+|\s+$"
_PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(col: Column) -> Column:
    """Remove blanks, tabs and line breaks from both ends."""
    return F.regexp_replace(col, _EDGE_BLANKS, "")


def lower(col: Column) -> Column:
    return F.lower(col)


def drop_literal(col: Column, *literals: str) -> Column:
    """Remove every occurrence of the given literals (no pattern matching)."""
    for literal in literals:
        col = F.replace(col, F.lit(literal), F.lit(""))
    return col


def first_word(col: Column) -> Column:
    """First run of non-blank characters; null when there is none."""
    return F.nullif(F.regexp_extract(col, r"(?U)(\S+)", 1), F.lit(""))


def split_fields(col: Column, separator: str, names: Sequence[str]) -> list[Column]:
    """One stripped column per name; missing fields are null."""
    parts = F.split(col, f"\\Q{separator}\\E")
    return [strip(F.try_element_at(parts, F.lit(i + 1))).alias(name) for i, name in enumerate(names)]


def equals_ignoring_case(col: Column, value: str) -> Column:
    return F.lower(col) == value.lower()


def to_number(col: Column) -> Column:
    """Number held in the text, or null. The pattern keeps out forms only Java reads, such as ``12d``."""
    return F.when(col.rlike(_PLAIN_NUMBER), F.trim(col).try_cast("double"))


def unit_number(col: Column, unit: str) -> Column:
    """Number written with thousands commas and a unit, such as ``12,000 km``."""
    return to_number(drop_literal(col, unit, ","))


# The money words a listing price may carry, and what each multiplies by.
MONEY_WORDS = {"crore": 10_000_000, "lacs": 100_000, "lac": 100_000}


def money_amount(col: Column, currency: str = "pkr") -> Column:
    """Amount written as ``PKR 1.5 crore``, ``PKR 12.5 lacs`` or ``PKR 1,250,000``; anything else is null."""
    text = F.lower(col)
    amount = to_number(drop_literal(text, currency, *MONEY_WORDS, ","))
    factor = F.lit(1)
    for word, size in reversed(MONEY_WORDS.items()):
        factor = F.when(F.contains(text, F.lit(word)), F.lit(size)).otherwise(factor)
    return amount * factor


def last_path_part(path: Column, suffix: str) -> Column:
    """File name without folder and suffix; null when the suffix differs."""
    return F.nullif(F.regexp_extract(path, rf"([^/]+)\Q{suffix}\E$", 1), F.lit(""))


def path_value(path: Column, key: str) -> Column:
    """Value of a ``key=value`` folder in the path; null when there is none."""
    return F.nullif(F.regexp_extract(path, rf"/\Q{key}\E=([^/]+)/", 1), F.lit(""))


def move_path(path: Column, old_prefix: str, new_prefix: str) -> Column:
    """Path with its leading folder swapped; other paths stay as they are."""
    return F.when(
        path.startswith(old_prefix), F.concat(F.lit(new_prefix), path.substr(F.lit(len(old_prefix) + 1), F.length(path)))
    ).otherwise(path)


def snake_names(df: DataFrame) -> DataFrame:
    """Column names in lower case, blanks as underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def blank_sentinels(df: DataFrame, sentinels: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Null in place of the given marker strings, in the named (by default all) string columns."""
    chosen = columns or [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.when(~F.col(c).isin(*sentinels), F.col(c)) for c in chosen})


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0, list(columns))
