"""CSV files with line breaks inside quoted fields, each file read by many tasks.

A line break ends a record only where the number of quotes before it in the file is even. Every byte range counts the quotes
of its own lines first; the counts of the ranges before it then tell whether a range starts inside a field. With
that, each task finds the records that start and end in its range, and only the pieces of records that cross a border are
put together: at most one at each end of a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import COMMA, CORRUPT, DelimitedFormat

_LINES = "value string, file string, block bigint"
_PIECES = "file string, block bigint, nth bigint, kind string, text string"
#: Lines that are put together at a time.
_SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("nth", pa.int64()), ("kind", pa.string()), ("text", pa.string())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in file order within each byte range; a range is one file's part in one task."""
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _odd_blocks(lines: DataFrame, quote: str) -> set[tuple[str, int]]:
    """Ranges that start inside a quoted field: at most one entry per range, of which Spark's driver keeps a list anyway."""
    counts = lines.groupBy("file", "block").agg(F.sum(F.regexp_count("value", F.lit(f"\\Q{quote}\\E")) % 2).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("file", "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before"))
    return {(r.file, r.block) for r in before.where("before % 2 = 1").select("file", "block").collect()}


def _pieces(lines: DataFrame, quote: str, odd: set[tuple[str, int]]) -> DataFrame:
    """Whole records, and what is left at the borders: ``head`` continues the record that is open where the range starts (up
    to its end: ``closing``), ``open`` starts one that goes on in the next range."""

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
        """Lines of one range each."""
        files, blocks = batch.column(1), np.asarray(batch.column(2))
        codes = np.asarray(pc.dictionary_encode(files).indices)
        cuts = np.flatnonzero(np.r_[True, (np.diff(blocks) != 0) | (np.diff(codes) != 0)])
        for at, end in zip(cuts, [*cuts[1:], len(blocks)], strict=True):
            yield files[int(at)].as_py(), int(blocks[at]), batch.column(0).slice(at, end - at)

    def rows(file: str, block: int, found: list[tuple[int, str, str]]) -> pa.RecordBatch:
        columns = [[file] * len(found), [block] * len(found), *(list(x) for x in zip(*found, strict=True))]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, inside, nth, kind = None, [], False, 0, "whole"
        for batch in batches:
            for file, block, lines in runs(batch):
                if (file, block) != here:
                    if held:
                        yield rows(*here, [(nth, "head" if kind == "head" else "open", "\n".join(held))])
                    here, held, nth = (file, block), [], 0
                    inside = here in odd
                    kind = "head" if inside else "whole"
                found = []
                quotes = np.asarray(pc.count_substring(lines, quote)) & 1
                for line, one in zip(lines.to_pylist(), quotes, strict=True):
                    held.append(line)
                    inside ^= bool(one)
                    if not inside:
                        found.append((nth, "closing" if kind == "head" else "whole", "\n".join(held)))
                        held, kind, nth = [], "whole", nth + 1
                if found:
                    yield rows(file, block, found)
        if held:
            yield rows(*here, [(nth, "head" if kind == "head" else "open", "\n".join(held))])

    return lines.mapInArrow(run, _PIECES)


def read_quoted_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: DelimitedFormat = COMMA,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Typed CSV whose quoted fields may hold line breaks; one large file is read by as many tasks as it has byte ranges.

    A quote stands around a field or, doubled, inside a quoted one; a quote in an unquoted field isn't allowed. With a
    header, the first record of each file is left out. Lines end with a line feed, with or without a carriage
    return; both are kept inside fields. Bad records raise, or give nulls and their text in ``_corrupt_record`` in mode
    ``PERMISSIVE``. A file that ends inside a quoted field raises.
    """
    if file_format.escape != file_format.quote:
        raise ValueError("quotes inside fields have to be doubled, not escaped otherwise")
    lines = _lines(spark, path)
    pieces = _pieces(lines, file_format.quote, _odd_blocks(lines, file_format.quote))

    whole = pieces.where("kind = 'whole'").select("file", "block", "nth", "text")
    # at most two rows per range: a record's pieces are its open end and the heads up to the closing one
    in_order = Window.partitionBy("file").orderBy("block", "nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = pieces.where("kind <> 'whole'").withColumn("_record", F.sum(F.when(F.col("kind") == "open", 1).otherwise(0)).over(in_order))
    parts = F.array_sort(F.collect_list(F.struct("block", "nth", "text")))
    joined = cut.groupBy("file", "_record").agg(parts.alias("_parts"), F.bool_or(F.col("kind") == "closing").alias("_closed"))
    unclosed = F.raise_error(F.concat(F.lit("a quoted field doesn't end in "), "file")).cast("string")
    text = F.when(F.col("_closed"), F.array_join("_parts.text", "\n")).otherwise(unclosed)
    records = whole.unionByName(joined.select("file", F.col("_parts")[0]["block"].alias("block"), F.col("_parts")[0]["nth"].alias("nth"), text.alias("text")))
    if file_format.header:
        records = records.where("block > 0 or nth > 0")
    record = F.regexp_replace("text", "\r$", "")
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    options = {k: v for k, v in file_format.options().items() if k in ("sep", "quote", "escape")} | {"mode": mode, "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}
    if mode != "FAILFAST":
        wanted = T.StructType([*wanted.fields, T.StructField(CORRUPT, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted)
    # blank lines are no records
    return records.where(record != "").select(F.from_csv(record, ddl, options).alias("_r")).select("_r.*")
