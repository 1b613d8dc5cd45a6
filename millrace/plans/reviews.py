"""Product reviews: partitioned Parquet, filtered full refresh, rating report. Order lines stand in for reviews."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import as_double
from millrace.plans.registry import query
from millrace.plans.tables import table
from millrace.session import new_folder
from millrace.sinks.files import narrow, save_distributed, write_clustered, write_interleaved, write_parquet, write_partitioned
from millrace.sources.files import read_partitioned
from millrace.sources.tables import create_database

REVIEW_SCHEMA = (
    "product_id bigint, order_id bigint, star_rating int, helpful_votes int, total_votes int, vine string, "
    "review_date timestamp_ntz, year int, product_category string"
)


def _reviews(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("star_rating"),
        F.col("l_quantity").cast("bigint").alias("helpful_votes"),
        (F.col("l_quantity") + 1).cast("bigint").alias("total_votes"),
        F.col("l_linestatus").alias("vine"),
        F.col("l_shipdate").alias("review_date"),
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.col("l_returnflag").alias("product_category"),
    )


def _stage_reviews(spark, sf_dir) -> DataFrame:
    """Reviews landed as one folder per category, integers narrowed to the table's types, read back by schema."""
    folder = new_folder(spark, "reviews")
    narrowed = narrow(_reviews(spark, sf_dir), {c: "int" for c in ("star_rating", "helpful_votes", "total_votes", "year")})
    write_partitioned(narrowed, folder, ["product_category"])
    return read_partitioned(spark, folder, REVIEW_SCHEMA)


_REVIEWS_SQL = """SELECT l_partkey AS product_id, l_orderkey AS order_id, l_linenumber AS star_rating,
       CAST(l_quantity AS INTEGER) AS helpful_votes, CAST(l_quantity + 1 AS INTEGER) AS total_votes, l_linestatus AS vine,
       l_shipdate AS review_date, CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS product_category FROM lineitem"""


def full_refresh(staged: DataFrame, since: int, folder: str) -> DataFrame:
    """Replace the table with the staged rows since a year; the filter reaches the scan."""
    write_parquet(staged.where(F.col("year") >= since), folder)
    return staged.sparkSession.read.schema(staged.schema).parquet(folder)


@query("reviews_full_refresh", "TBL-18 TBL-04 TBL-05 SRC-15 SRC-16 SNK-05 SNK-06 FLT-02 F-NUM-03", f"{_REVIEWS_SQL} WHERE year(l_shipdate) >= 1997")
def _(spark, sf_dir):
    return full_refresh(_stage_reviews(spark, sf_dir), 1997, new_folder(spark, "reviews-main"))


@query("reviews_one_category", "SRC-15 SRC-16", f"{_REVIEWS_SQL} WHERE l_returnflag = 'R' AND l_linenumber >= 5")
def _(spark, sf_dir):
    return _stage_reviews(spark, sf_dir).where("product_category = 'R' and star_rating >= 5")


@query("clustered_reviews", "TBL-19", f"{_REVIEWS_SQL}")
def _(spark, sf_dir):
    folder = new_folder(spark, "reviews-clustered")
    reviews = narrow(_reviews(spark, sf_dir), {c: "int" for c in ("star_rating", "helpful_votes", "total_votes", "year")})
    write_clustered(reviews, folder, "product_id", "year")
    return spark.read.schema(REVIEW_SCHEMA).parquet(folder)


@query(
    "interleaved_reviews",
    "TBL-19",
    f"SELECT * FROM ({_REVIEWS_SQL}) WHERE year = 1995",
)
def _(spark, sf_dir):
    folder = new_folder(spark, "reviews-interleaved")
    reviews = narrow(_reviews(spark, sf_dir), {c: "int" for c in ("star_rating", "helpful_votes", "total_votes", "year")})
    write_interleaved(reviews, folder, ["product_id", "year"])
    # skips files by the second column
    return spark.read.schema(REVIEW_SCHEMA).parquet(folder).where("year = 1995")


def _bucketed_reviews(spark, sf_dir, database: str) -> DataFrame:
    create_database(spark, database, new_folder(spark, "reviews-db"))
    save_distributed(_reviews(spark, sf_dir), f"{database}.reviews", "product_id", "year", 8)
    return spark.table(f"{database}.reviews")


@query(
    "votes_per_product",
    "TBL-19 AGG-07",
    """SELECT l_partkey AS product_id, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS votes, CAST(max(year(l_shipdate)) AS BIGINT) AS last_year
       FROM lineitem GROUP BY l_partkey""",
)
def _(spark, sf_dir):
    # distributed by product, so this sum runs without a shuffle
    reviews = _bucketed_reviews(spark, sf_dir, f"reviews_{uuid.uuid4().hex[:8]}")
    return reviews.groupBy("product_id").agg(F.sum("helpful_votes").alias("votes"), F.max("year").alias("last_year"))


def review_report(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Average rating, helpful votes and review count per category and title.

    Sums are made per product first, so a much-reviewed product is one row per task before any shuffle.
    """
    per_product = reviews.groupBy("product_id").agg(
        F.sum("star_rating").alias("_stars"), F.count("star_rating").alias("_rated"), F.sum("helpful_votes").alias("_votes"), F.count(F.lit(1)).alias("_n")
    )
    titled = per_product.join(products, "product_id")
    return titled.groupBy("product_category", "product_title").agg(
        F.try_divide(as_double(F.sum("_stars")), F.sum("_rated")).alias("avg_rating"),
        F.sum("_votes").alias("total_helpful_votes"),
        F.sum("_n").alias("review_count"),
    )


_REPORT_SQL = """SELECT p_type AS product_category, p_name AS product_title, CAST(SUM(l_linenumber) AS DOUBLE) / COUNT(*) AS avg_rating,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_helpful_votes, COUNT(*) AS review_count
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, p_name ORDER BY avg_rating DESC"""


def _report(spark, sf_dir):
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category"), F.col("p_name").alias("product_title"))
    return review_report(_reviews(spark, sf_dir).drop("product_category"), products).orderBy(
        F.desc("avg_rating"), "product_category", "product_title"
    )


@query("review_report", "AGG-07 PRJ-08 SRT-02", _REPORT_SQL)
def _(spark, sf_dir):
    return _report(spark, sf_dir)


@query("review_report_export", "SNK-04", _REPORT_SQL)
def _(spark, sf_dir):
    folder = new_folder(spark, "review-report")
    report = _report(spark, sf_dir)
    write_parquet(report, folder)
    return spark.read.schema(report.schema).parquet(folder)
