"""File sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.semi import JSON_TIMES, row_json
from millrace.functions.times import hour_parts
from millrace.operators.ordered import with_identity


def write_csv(df: DataFrame, folder: str, index_by: Sequence[str] | None = None, header: bool = True, sep: str = ",") -> None:
    """CSV files, text as it is; with ``index_by`` a leading row number from 0 in that (distinct) order."""
    if index_by is not None:
        numbered = with_identity(df, index_by, "index", after=-1)
        df = numbered.select("index", *df.columns)
    writer = df.write.mode("overwrite").option("header", header).option("sep", sep).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)


def write_parquet(df: DataFrame, folder: str, rows_per_file: int = 5_000_000, compact: bool = False) -> None:
    """Replace the folder's Parquet files. ``compact`` adds a shuffle that evens out the files, for small reports."""
    out = df.hint("rebalance") if compact else df
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(folder)


def write_partitioned(df: DataFrame, folder: str, keys: Sequence[str], rows_per_file: int = 5_000_000) -> None:
    """One folder per key value. AQE gathers a key's rows into few files and splits a hot key over several tasks."""
    balanced = df.hint("rebalance", *keys)
    balanced.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).parquet(folder)


def write_clustered(df: DataFrame, folder: str, cluster: str, sort: str) -> None:
    """Each file holds a range of ``cluster`` (and of ``sort`` within it), so scans can skip files; a hot value spans several."""
    df.repartitionByRange(cluster, sort).sortWithinPartitions(cluster, sort).write.mode("overwrite").parquet(folder)


def interleaved(df: DataFrame, columns: Sequence[str], name: str, bits: int = 6) -> DataFrame:
    """The frame with the key ``name`` that orders rows by all the columns alike: the bits of their ranks, taken in turn from the highest down.

    A rank says between which of ``2 ** bits - 1`` quantiles a value lies; quantiles come from one pass with mergeable
    sketches. Columns are numbers, dates or timestamps; a null (or NaN) ranks with the least. A rank is found by halving,
    a comparison and a projection per bit. The key is a column, not an expression: a sort evaluates expressions at every
    comparison of two rows.
    """

    def number(column: str) -> Column:
        kind = df.schema[column].dataType.typeName()
        whole = F.unix_date(column) if kind == "date" else F.unix_micros(F.col(column).cast("timestamp")) if kind.startswith("timestamp") else F.col(column)
        return F.nanvl(whole.cast("double"), F.lit(None).cast("double"))

    cuts = df.agg(*[F.percentile_approx(number(c), [i / 2**bits for i in range(1, 2**bits)], 10_000).alias(c) for c in columns]).first()
    values, ranks = [f"{name}_value_{place}" for place in range(len(columns))], [f"{name}_rank_{place}" for place in range(len(columns))]
    ranked = df.withColumns(dict(zip(values, map(number, columns)))).withColumns({rank: F.lit(0) for rank in ranks})
    for bit in reversed(range(bits)):
        step = 2**bit

        def above(column: str, value: str, rank: str) -> Column:
            sorted_cuts = F.array(*[F.lit(cut) for cut in cuts[column] or [0.0]])
            return F.col(rank) + F.when(F.get(sorted_cuts, F.col(rank) + step - 1) <= F.col(value), step).otherwise(0)

        ranked = ranked.withColumns({rank: above(column, value, rank) for column, value, rank in zip(columns, values, ranks)})
    key = F.lit(0).cast("bigint")
    for place, rank in enumerate(ranks):
        for bit in range(bits):
            key = key + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(columns) + len(columns) - 1 - place)
    return ranked.withColumn(name, key).drop(*values, *ranks)


def write_interleaved(df: DataFrame, folder: str, columns: Sequence[str], files: int | None = None) -> None:
    """Files that hold a small range of every column, so that scans can skip files by any of them, not by the first only.

    Reads the frame three times (quantiles, Spark's sample for the ranges, then rows) and shuffles it once. ``files`` fixes
    their number; else Spark sizes them. Rows of one hot combination have one place; the hash of their other columns deals
    them to several files.
    """
    # more leading underscores than any column has, so it is a name of its own
    place = "_" * (1 + max(len(c) - len(c.lstrip("_")) for c in df.columns)) + "place"
    others = [f.name for f in df.schema if f.name not in columns and f.dataType.typeName() not in ("map", "variant")]
    by = [place, *columns, *([F.xxhash64(*others)] if others else [])]
    placed = interleaved(df, columns, place)
    ranges = placed.repartitionByRange(*by) if files is None else placed.repartitionByRange(files, *by)
    ranges.sortWithinPartitions(place, *columns).drop(place).write.mode("overwrite").parquet(folder)


def save_distributed(df: DataFrame, table: str, key: str, sort: str, buckets: int) -> None:
    """Catalog table hashed into buckets by ``key`` and sorted inside them: joins and sums on the key need no shuffle.

    A bucket is written by one task, as one file, and read by one, so this is for keys without a hot value; else use
    ``write_clustered``.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(sort).saveAsTable(table)


def narrow(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Columns cast to the table's types before a write; a value that does not fit raises."""
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})


def write_hourly_json(df: DataFrame, folder: str, ts: Column) -> None:
    """JSON lines below year/month/day/hour folders; hours written again are replaced."""
    parts = hour_parts(ts)
    (
        df.withColumns(parts)
        .hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .options(**JSON_TIMES)
        .json(folder)
    )


def keyed_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as ``key`` and JSON ``value``, the layout a topic takes."""
    return df.select(F.col(key).cast("string").alias("key"), row_json(*df.columns).alias("value"))


def publish(df: DataFrame, key: str, sink: str, options: Mapping[str, str]) -> None:
    """Send rows as keyed JSON, appended to what is there; ``sink`` is ``kafka`` on a cluster, or a file format."""
    keyed_messages(df, key).write.format(sink).options(**dict(options)).mode("append").save()
