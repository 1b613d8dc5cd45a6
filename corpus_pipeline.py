"""A corpus pipeline over ``documents``: each stage is one operator of ``millrace.llm``, written as Parquet and read again.

1. quality: lines that fail the rules go, documents that lose too much text go (``line_quality``).
2. exact_dedup: of equal texts the one with the greatest id stays (``without_copies``).
3. near_dedup: of texts that share 0.8 of their runs of five words the one with the least id stays (``without_near_copies``).
4. mixing: sources get 150 % of all words by weights 3, 1, 2 in turn, a document at most twice (``mix``).
5. packing: token ids in as few sequences of 2048 as possible (``packed``).

A null text fails the quality rules. Null ids, sources and other columns are passed on as the operators say; columns other
than those of ``documents`` aren't carried, so their names can't clash. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.exact import without_copies
from millrace.llm.minhash import without_near_copies
from millrace.llm.mixing import mix
from millrace.llm.packing import packed
from millrace.llm.quality import cleaned
from millrace.session import new_folder

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
COLUMNS = [c.split()[0] for c in DOCUMENTS.split(", ")]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text that the line rules leave; ``n_chars`` is counted anew."""
    return cleaned(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_copies(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs.select(*COLUMNS))


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: Token ids can't be made in SQL; tests/llm/test_pipeline.py compares the rows with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
