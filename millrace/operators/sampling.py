"""Repeatable samples: the choice depends on the key alone, not on partitions or retries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_hash(keys: Sequence[str], seed: str = "") -> Column:
    """Hex digest of the keys, evenly spread and equal on every engine."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys]))


def sample_fraction(df: DataFrame, keys: Sequence[str], fraction: float, seed: str = "") -> DataFrame:
    """About ``fraction`` of the keys, with all of their rows; all keys for 1."""
    if not 0 <= fraction <= 1:
        raise ValueError("a fraction lies between 0 and 1")
    number = F.conv(F.substring(key_hash(keys, seed), 1, 8), 16, 10).cast("bigint")
    return df.where(number < int(fraction * 16**8))


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: str = "") -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), chosen by key hash; each task keeps only its best ``n``."""
    return df.orderBy(key_hash(keys, seed), *keys).limit(n)
