"""File readers with the load policies of a bulk load: skip bad files, keep good rows, pick by pattern."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import blank_sentinels

CORRUPT = "_corrupt_record"
FILE = "_file"


@dataclass(frozen=True)
class DelimitedFormat:
    """A named file format. With ``lines_in_fields`` quoted fields may hold line breaks; such a file is read by one task
    (``read_quoted_csv`` reads it by many)."""

    separator: str = ","
    header: bool = True
    quote: str = '"'
    escape: str = '"'
    lines_in_fields: bool = False

    def options(self) -> dict[str, str]:
        return {
            "sep": self.separator,
            "header": str(self.header).lower(),
            "quote": self.quote,
            "escape": self.escape,
            "enforceSchema": "true",
            "multiLine": str(self.lines_in_fields).lower(),
        }


COMMA = DelimitedFormat()
PIPE = DelimitedFormat(separator="|")


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: DelimitedFormat = COMMA,
    sentinels: tuple[str, ...] = (),
) -> DataFrame:
    """Typed CSV; a value that doesn't fit its type raises, in columns that the query reads (Spark skips the others).

    With sentinels, text is read first, the markers are blanked, then types are cast. To keep bad rows, use ``read_staged``.
    """
    wanted = _schema(schema)
    reader = spark.read.options(**file_format.options()).option("mode", "FAILFAST")
    if not sentinels:
        return reader.schema(wanted).csv(path)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    text = blank_sentinels(reader.schema(as_text).csv(path), sentinels)
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def read_staged(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: DelimitedFormat = COMMA,
    name_pattern: str | None = None,
) -> DataFrame:
    """Staged delimited files as typed columns plus ``_file``, ``_raw`` and ``_reason`` (null for good rows).

    Fields are taken by position. They are read as text and cast by ``try_cast``, so a bad row neither
    stops the load nor hides, and every later filter on the reason reads the fields it depends on.
    """
    wanted = _schema(schema)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted] + [T.StructField(CORRUPT, T.StringType())])
    raw = (
        spark.read.options(**file_format.options())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")  # else a row's field count is not checked
        .schema(as_text)
        .csv(path)
        .withColumn(FILE, F.col("_metadata.file_path"))
    )
    if name_pattern is not None:
        raw = raw.where(F.col(FILE).rlike(name_pattern))
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in wanted}
    reason = F.lit(None).cast("string")
    for f in reversed(wanted.fields):
        broken = F.col(f.name).isNotNull() & typed[f.name].isNull()
        reason = F.when(broken, F.lit(f"bad value in {f.name}")).otherwise(reason)
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of fields")).otherwise(reason)
    line = F.concat_ws(file_format.separator, *[F.coalesce(F.col(f.name), F.lit("")) for f in wanted])
    return raw.select(
        *[c.alias(n) for n, c in typed.items()], FILE, F.coalesce(F.col(CORRUPT), line).alias("_raw"), reason.alias("_reason")
    )


def keep_good_rows(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Policy "continue": good rows to load, and bad rows with file, text and reason."""
    good = staged.where("_reason is null").drop("_raw", "_reason")
    bad = staged.where("_reason is not null").select(FILE, "_raw", "_reason")
    return good, bad


def skip_bad_files(staged: DataFrame, unit: Column | None = None) -> DataFrame:
    """Policy "skip file": rows of load units without any bad row. A unit is a file unless told otherwise."""
    with_unit = staged.withColumn("_unit", unit if unit is not None else F.col(FILE))
    spoiled = with_unit.where("_reason is not null").select("_unit").distinct()
    return with_unit.join(spoiled, "_unit", "left_anti").drop("_unit", "_raw", "_reason")


def load_report(staged: DataFrame, unit: Column | None = None) -> DataFrame:
    """Rows parsed and errors seen per load unit."""
    with_unit = staged.withColumn("unit", unit if unit is not None else F.col(FILE))
    return with_unit.groupBy("unit").agg(
        F.count(F.lit(1)).alias("rows_parsed"), F.count_if(F.col("_reason").isNotNull()).alias("errors_seen")
    )


def with_batch(df: DataFrame, batch_id: str, name: str = "batch_id") -> DataFrame:
    """The loaded columns behind a constant batch id; slashes of a dated batch path are dropped."""
    return df.select(F.lit(batch_id.replace("/", "")).alias(name), *[c for c in df.columns if not c.startswith("_")])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON document per line; unreadable lines come back in ``_corrupt_record``."""
    wanted = _schema(schema)
    return (
        spark.read.schema(T.StructType([*wanted.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one object or one array of objects, one row per object, plus ``_file``."""
    return spark.read.schema(_schema(schema)).option("multiLine", "true").json(path).withColumn(FILE, F.col("_metadata.file_path"))


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """Parquet in ``key=value`` folders; the schema names the partition columns too, so ``06`` stays text if asked."""
    return spark.read.schema(_schema(schema)).parquet(root)


def register_partitions(spark: SparkSession, table: str, root: str, schema: T.StructType | str, keys: list[str]) -> DataFrame:
    """External table over a partitioned Parquet folder, with its partitions registered."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(schema))
    names = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({names}) LOCATION '{root}'")
    spark.catalog.recoverPartitions(table)
    return spark.table(table)


def list_staged(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Path, size and time of the staged files; file content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", "modificationTime").where(F.col("path").endswith(suffix))
