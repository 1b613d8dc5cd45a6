"""Row checks, load checks and run reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_reason(df: DataFrame, rules: Mapping[str, Column], name: str = "reason") -> DataFrame:
    """Name of the first rule a row breaks, or null. A rule is a condition that holds for good rows; null breaks it."""
    reason = F.lit(None).cast("string")
    for label, holds in reversed(list(rules.items())):
        reason = F.when(F.coalesce(holds, F.lit(False)), reason).otherwise(F.lit(label))
    return df.withColumn(name, reason)


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the reason."""
    judged = with_reason(df, rules)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def watch_load(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills while the frame is written: no second pass over the data."""
    seen = Observation(label)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def expect_count(df: DataFrame, expected: int) -> None:
    found = df.count()
    if found != expected:
        raise ValueError(f"expected {expected} rows, found {found}")


def same_schema(df: DataFrame, schema: T.StructType) -> bool:
    """Equal names and types in order; nullability is not compared."""
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def missing_tables(spark: SparkSession, names: list[str]) -> list[str]:
    return [name for name in names if not spark.catalog.tableExists(name)]


def run_summary(loaded: DataFrame, unit: str, symbol: str) -> DataFrame:
    """Units and records loaded, per symbol and (symbol null) in all.

    One row per symbol instead of a list in one cell, which would grow with the data.
    """
    finest = loaded.groupBy(unit, symbol).agg(F.count(F.lit(1)).alias("_n"))
    per_symbol = finest.groupBy(symbol).agg(F.count(unit).alias("units"), F.sum("_n").alias("records"))
    per_unit = finest.groupBy(unit).agg(F.sum("_n").alias("_n"))
    overall = per_unit.agg(F.count(unit).alias("units"), F.coalesce(F.sum("_n"), F.lit(0)).alias("records"))
    return per_symbol.unionByName(overall.select(F.lit(None).cast(loaded.schema[symbol].dataType).alias(symbol), "units", "records"))


def log_stage(spark: SparkSession, folder: str, stage: str, message: str, n_rows: int | None = None) -> None:
    """Append one line to the audit log."""
    line = spark.range(1).select(
        F.current_timestamp().alias("at"),
        F.lit(stage).alias("stage"),
        F.lit(message).alias("message"),
        F.lit(n_rows).cast("bigint").alias("n_rows"),
    )
    line.coalesce(1).write.mode("append").json(folder)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("at timestamp, stage string, message string, n_rows bigint").json(folder)
