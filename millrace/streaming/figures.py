"""Running figures per key, held as parts that add up: a micro-batch changes the figures of its own keys only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numbers import amount, as_double, in_units
from millrace.session import stored
from millrace.sources.versions import BucketedTable
from millrace.streaming.ingest import BatchWriter, stream_id

_PARTS = "n_rows bigint, n_prices bigint, total decimal(38,0), least double, greatest double"


class RunningStats:
    """Count, mean, least and greatest price per key over everything streamed so far.

    A batch is summed first (hot keys shrink in the map stage), then added to the stored parts of its keys; only the buckets
    of these keys are read and written. The commit line carries the batch, so a repeated one adds nothing. Prices have at
    most ``digits`` digits after the point; a null price counts as a row, a null key is a key, an empty batch changes nothing.
    Choose ``buckets`` for the number of keys: a batch rewrites at least one.
    """

    def __init__(self, spark: SparkSession, folder: str, key: T.StructField, price: str, digits: int = 2, buckets: int = 8):
        self.key, self.price, self.digits = key.name, price, digits
        schema = T.StructType([key, *T.StructType.fromDDL(_PARTS).fields])
        self.table = BucketedTable(spark, folder, schema, [key.name], buckets)
        if not self.table.started():
            self.table.replace(spark.createDataFrame([], schema))

    def _of(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.key).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count(self.price).alias("n_prices"),
            amount(self.price, self.digits).total().cast("decimal(38,0)").alias("total"),
            as_double(F.min(self.price)).alias("least"),
            as_double(F.max(self.price)).alias("greatest"),
        )

    def _added(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(self.key).agg(
            *[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in ("n_rows", "n_prices", "total")],
            F.min("least").alias("least"),
            F.max("greatest").alias("greatest"),
        )

    def add(self, rows: DataFrame, batch: str) -> None:
        if not self.table.has_batch(batch):
            fresh = stored(self._of(rows))
            self.table.change(fresh, lambda old: self._added(old.unionByName(fresh)), batch)

    def writer(self) -> BatchWriter:
        return lambda df, batch_no: self.add(df, f"{stream_id(df)}/{batch_no}")

    def read(self) -> DataFrame:
        mean = F.try_divide(in_units(F.col("total"), self.digits), F.col("n_prices"))
        return self.table.read().select(
            self.key, "n_rows", mean.alias("avg_price"), F.col("least").alias("min_price"), F.col("greatest").alias("max_price")
        )
