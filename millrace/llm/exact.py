"""Exact deduplication by a stateful stream.

A streaming aggregation keeps, per digest of the normalised text, the greatest identifier and the place (file and row) of
its content. The state lies on disk (RocksDB, checkpointed to the shared folder) and never expires, so a text that comes
back in a later batch is a hit. Hits are decided on full bytes: the texts found at the places of a hit are compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import lower_az, with_place
from millrace.session import new_folder, stored

_KEY = "quick bigint, digest binary"
_KEEPER = "keeper struct<doc_id:bigint,file:string,row:bigint>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _normal(text: str) -> Column:
    return lower_az(F.coalesce(F.col(text), F.lit("")))


def content_keys(docs: DataFrame, id: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """(quick, digest, keeper) of each row of a frame with ``_file`` and ``_row``; quick stands for the digest in 8 bytes."""
    keeper = F.struct(F.col(id).cast("bigint").alias("doc_id"), F.col("_file").alias("file"), F.col("_row").alias("row"))
    normal = docs.select(_normal(text).alias("_t"), keeper.alias("keeper"))
    return normal.select(digest(F.col("_t")).alias("digest"), "keeper").select(F.xxhash64("digest").alias("quick"), "digest", "keeper")


def remember(spark: SparkSession, arrivals: str, folder: str, batch_bytes: int = 2**40) -> DataFrame:
    """Feed the key files in ``arrivals`` that were not seen before into the state kept in ``folder``.

    Returns (digest, keeper, group_size) over everything ever fed. A batch that is repeated after a loss replaces its own
    output, and the state is rolled back with it.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    # a store per partition: space reserved ahead would be most of a small one
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    keys = session.readStream.schema(f"{_KEY}, {_KEEPER}").option("maxBytesPerTrigger", str(batch_bytes)).parquet(arrivals)
    state = keys.groupBy("digest").agg(F.max("keeper").alias("keeper"), F.count(F.lit(1)).alias("group_size"))

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/seen/batch={number}")

    writer = state.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", f"{folder}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    seen = spark.read.schema(f"digest binary, {_KEEPER}, group_size bigint, batch bigint").parquet(f"{folder}/seen")
    newest = F.max(F.struct("batch", "keeper", "group_size")).alias("_last")  # group sizes only grow
    return seen.groupBy("digest").agg(newest).select("digest", "_last.keeper", "_last.group_size")


def exact_dedup(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest, file, row.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the greatest
    id stays, a null id counting as smallest; among repeated rows with that id the last in place stays. Other columns
    aren't read, an empty table gives an empty result.

    The digest only proposes: where two texts of one digest differ, the group is formed anew by the texts themselves.
    """
    return _decided(with_place(docs.select(id, text)), id, text, digest)


def _decided(placed: DataFrame, id: str, text: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    spark = placed.sparkSession
    folder = new_folder(spark, "exact")
    keys_at = f"{folder}/keys"
    content_keys(placed, id, text, digest).write.parquet(keys_at)
    keys = spark.read.schema(f"{_KEY}, {_KEEPER}").parquet(keys_at)
    groups = stored(remember(spark, keys_at, folder))

    # eight bytes per group of several rows choose the texts that have to be compared
    hits = stored(keys.join(groups.where("group_size > 1").select("digest"), "digest").select("quick").distinct())
    contents = placed.select(_normal(text).alias("_t")).withColumn("quick", F.xxhash64(digest(F.col("_t")))).join(hits, "quick", "left_semi")
    # by a hash of the key: were it the key itself, Spark would bring all texts of a group together before it compares any
    same = contents.groupBy(F.xxhash64("quick")).agg(F.min("_t").alias("_least"), F.max("_t").alias("_most"), F.first("quick").alias("quick"))
    differ = stored(same.where("_least <> _most").select("quick"))
    clashes = stored(keys.join(differ, "quick").select("digest").distinct())

    found = keys.drop("quick").join(groups.withColumnRenamed("keeper", "_keeper"), "digest")
    if not clashes.isEmpty():
        found = found.join(clashes, "digest", "left_anti").unionByName(_by_text(placed, keys, clashes, id, text))
    return found.select(
        "keeper.doc_id",
        F.col("_keeper.doc_id").alias("keep_id"),
        F.col("group_size").cast("bigint").alias("group_size"),
        ((F.col("keeper.file") == F.col("_keeper.file")) & (F.col("keeper.row") == F.col("_keeper.row"))).alias("kept"),
        "digest",
        "keeper.file",
        "keeper.row",
    )


def _by_text(placed: DataFrame, keys: DataFrame, clashes: DataFrame, id: str, text: str) -> DataFrame:
    """Groups of the rows whose digest stands for several texts."""
    rows = keys.join(clashes, "digest").select("digest", "keeper", F.col("keeper.file").alias("_file"), F.col("keeper.row").alias("_row"))
    texts = rows.join(placed.select("_file", "_row", _normal(text).alias("_t")), ["_file", "_row"]).drop("_file", "_row")
    groups = texts.groupBy("digest", "_t").agg(F.max("keeper").alias("_keeper"), F.count(F.lit(1)).alias("group_size"))
    return texts.join(groups, ["digest", "_t"]).select("digest", "keeper", "_keeper", "group_size")


def without_copies(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns, whatever these are called.

    Of equal texts (null is empty) the row with the greatest id stays, a null id counting as smallest; of repeated rows with that
    id one stays. An empty table stays empty.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    placed = with_place(docs.select(whole, F.col(id).alias("_id"), F.col(text).alias("_text")))
    decided = _decided(placed.select("_id", "_text", "_file", "_row"), "_id", "_text")
    gone = stored(decided.where("not kept").select(F.col("file").alias("_file"), F.col("row").alias("_row")))
    return placed.join(gone, ["_file", "_row"], "left_anti").select("_whole.*")
