"""Database tables as sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_database(
    spark: SparkSession,
    url: str,
    query: str,
    options: Mapping[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Result of a database query. ``split`` = (column, low, high, parts) reads in parallel ranges of a number column."""
    reader = spark.read.format("jdbc").option("url", url).options(**dict(options or {}))
    if split is None:
        return reader.option("query", query).load()
    column, low, high, parts = split
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", parts)
        .load()
    )


def write_database(df: DataFrame, url: str, table: str, replace: bool, batch_size: int = 10_000, options: Mapping[str, str] | None = None) -> None:
    """Rows into a database table in batches; validate first (``quality.split_valid``) as one bad row fails its batch."""
    (
        df.write.format("jdbc")
        .options(**dict(options or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .mode("overwrite" if replace else "append")
        .save()
    )


def save_table(df: DataFrame, name: str, replace: bool) -> None:
    """Rows into a catalog table."""
    df.write.mode("overwrite" if replace else "append").saveAsTable(name)


def create_database(spark: SparkSession, name: str, folder: str | None = None) -> None:
    """Database, if it is missing; its tables go below ``folder`` when one is given."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}" + (f" LOCATION '{folder}'" if folder else ""))


def create_table(spark: SparkSession, name: str, columns: str) -> None:
    """Typed table; ``columns`` may hold defaults such as ``created_at timestamp DEFAULT current_timestamp()``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def bound_query(spark: SparkSession, text: str, params: Mapping[str, object], **frames: DataFrame) -> DataFrame:
    """SQL with bound parameters (``:name``) over named frames (``{name}``)."""
    return spark.sql(text, args=dict(params), **frames)
