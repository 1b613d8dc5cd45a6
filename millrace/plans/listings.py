"""Listing cleaning and listing statistics. Parts stand in for used cars: brand, size, price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import amount, rescale, round_half_even, round_half_up
from millrace.functions.text import fill_zero, first_word, money_amount, split_fields, strip, to_number, unit_number
from millrace.operators.aggregate import mean_by, shares, value_counts
from millrace.operators.sampling import sample_fraction, sample_rows
from millrace.plans.registry import query
from millrace.plans.tables import table


def _cars(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").withColumn("brand", first_word(F.col("p_name")))


# ---------------------------------------------------------------- statistics


@query(
    "value_counts_all",
    "AGG-14",
    "SELECT p_type, COUNT(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type ORDER BY n DESC, p_type",
)
def _(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "part"), "p_type").orderBy(F.desc("n"), "p_type")


@query(
    "value_counts_top10",
    "AGG-14 SRT-06 F-STR-05",
    """SELECT split_part(trim(p_name), ' ', 1) AS brand, COUNT(*) AS n FROM part WHERE p_name IS NOT NULL
       GROUP BY 1 ORDER BY n DESC, brand LIMIT 10""",
)
def _(spark, sf_dir):
    return value_counts(_cars(spark, sf_dir), "brand").orderBy(F.desc("n"), "brand").limit(10)


@query(
    "mean_by_brand_top10",
    "AGG-15 SRT-06",
    """SELECT p_brand, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(p_retailprice) AS avg_price
       FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY avg_price DESC, p_brand LIMIT 10""",
)
def _(spark, sf_dir):
    return mean_by(_cars(spark, sf_dir), "p_brand", amount("p_retailprice"), "avg_price").orderBy(F.desc("avg_price"), "p_brand").limit(10)


@query(
    "category_share",
    "AGG-20",
    """SELECT p_type, n, CAST(round(n * 100.0 / total, 1) AS DOUBLE) AS percent FROM (
         SELECT p_type, COUNT(*) AS n, (SELECT COUNT(p_type) FROM part) AS total FROM part WHERE p_type IS NOT NULL GROUP BY p_type)""",
)
def _(spark, sf_dir):
    return shares(table(spark, sf_dir, "part"), "p_type")


@query("distinct_values", "AGG-16", "SELECT DISTINCT o_orderpriority FROM orders")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderpriority").distinct()


@query("min_max", "AGG-17", "SELECT min(p_size) AS min_size, max(p_size) AS max_size FROM part")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").agg(F.min("p_size").alias("min_size"), F.max("p_size").alias("max_size"))


# ---------------------------------------------------------------- filters, projections


def filter_listings(df: DataFrame, picked: dict[str, list], low: int, high: int, year: str) -> DataFrame:
    """Rows whose columns hold one of the picked values and whose year lies in the range; nulls fail."""
    for column, values in picked.items():
        df = df.where(F.col(column).isin(*values))
    return df.where(F.col(year).between(low, high))


@query(
    "listing_filter",
    "FLT-03 FLT-04",
    """SELECT * FROM part WHERE p_brand IN ('Brand#1', 'Brand#7', 'Brand#12') AND p_type IN ('ECONOMY', 'PROMO', 'SMALL')
       AND p_size BETWEEN 10 AND 35""",
)
def _(spark, sf_dir):
    picked = {"p_brand": ["Brand#1", "Brand#7", "Brand#12"], "p_type": ["ECONOMY", "PROMO", "SMALL"]}
    return filter_listings(table(spark, sf_dir, "part"), picked, 10, 35, "p_size")


@query(
    "scatter_points",
    "AGG-21",
    "SELECT p_size AS x, p_retailprice AS y, p_type AS color, p_partkey AS id FROM part",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_size").alias("x"), F.col("p_retailprice").alias("y"), F.col("p_type").alias("color"), F.col("p_partkey").alias("id")
    )


@query(
    "sample_by_hash",
    "FLT-09",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE substr(md5(concat_ws('|', '', l_orderkey, l_linenumber)), 1, 8) < '19999999'""",
)
def _(spark, sf_dir):
    picked = sample_fraction(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 0.1)
    return picked.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("sample_whole", "FLT-09", "SELECT l_orderkey, l_linenumber FROM lineitem")
def _(spark, sf_dir):
    """A sample of everything is everything."""
    return sample_fraction(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 1.0).select("l_orderkey", "l_linenumber")


@query(
    "sample_rows",
    "FLT-09 SRT-05",
    "SELECT event_id, event_type, value FROM events ORDER BY md5(concat_ws('|', '', event_id)), event_id LIMIT 1",
)
def _(spark, sf_dir):
    return sample_rows(table(spark, sf_dir, "events"), ["event_id"], 1).select("event_id", "event_type", "value")


# ---------------------------------------------------------------- cleaning


def clean_details(df: DataFrame, details: str) -> DataFrame:
    """``Year | KM | Fuel | CC | Transmission | Grade`` text as typed columns; unreadable numbers are null."""
    names = ["year", "km", "fuel", "cc", "transmission", "grade"]
    parts = df.select("*", *split_fields(F.col(details), "|", names))
    return parts.withColumns(
        {
            "year": to_number(F.col("year")).cast("int"),
            "km": unit_number(F.col("km"), "km"),
            "cc": unit_number(F.col("cc"), "cc"),
        }
    ).drop(details)


def _thousands(value):
    return F.format_number(value, 0)


@query(
    "split_details",
    "F-STR-04 F-STR-03 F-STR-02 F-NUM-01 UDF-03",
    """SELECT p_partkey, CASE WHEN p_size > 45 THEN NULL ELSE 1970 + p_size END AS year,
       CAST(p_size AS DOUBLE) * 1234 AS km, p_type AS fuel, CAST(p_size AS DOUBLE) * 100 AS cc,
       CASE WHEN p_size <= 40 THEN p_brand END AS transmission, CASE WHEN p_size <= 20 THEN p_name END AS grade FROM part""",
)
def _(spark, sf_dir):
    # small sizes carry all six fields, larger ones lose the last or the last two; the largest have no year
    size = F.col("p_size")
    year = F.when(size > 45, F.lit("unknown")).otherwise((1970 + size).cast("string"))
    head = F.concat(year, F.lit(" |\t"), _thousands(size * 1234), F.lit(" km | "), F.col("p_type"), F.lit(" | "), _thousands(size * 100), F.lit("cc "))
    gear = F.concat(F.lit("| "), F.col("p_brand"), F.lit("  "))
    grade = F.concat(F.lit("|"), F.col("p_name"), F.lit("\n"))
    text = F.when(size <= 20, F.concat(head, gear, grade)).when(size <= 40, F.concat(head, gear)).otherwise(head)
    return clean_details(table(spark, sf_dir, "part").select("p_partkey", text.alias("details")), "details")


@query(
    "number_unit_price",
    "F-STR-11 F-STR-06 F-STR-01 UDF-01",
    """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN CAST(p_retailprice AS DOUBLE) * 100000
         WHEN 'SMALL' THEN CAST(p_size AS DOUBLE) * 10000000 WHEN 'STANDARD' THEN CAST(p_size AS DOUBLE) * 100000
         WHEN 'PROMO' THEN NULL ELSE CAST(p_size * 54321 AS DOUBLE) END AS price FROM part""",
)
def _(spark, sf_dir):
    size = F.col("p_size")
    text = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit(" PKR "), F.col("p_retailprice").cast("string"), F.lit(" lacs ")))
        .when(F.col("p_type") == "SMALL", F.concat(F.lit("PKR "), size, F.lit(" Crore")))
        .when(F.col("p_type") == "STANDARD", F.concat(F.lit("pkr "), size, F.lit(".0 lac")))
        .when(F.col("p_type") == "PROMO", F.lit("Call for price"))
        .otherwise(F.concat(F.lit("PKR "), _thousands(size * 54321)))
    )
    priced = table(spark, sf_dir, "part").select("p_partkey", text.alias("price"))
    return priced.select("p_partkey", money_amount(F.col("price")).alias("price"))


@query(
    "coerce_fill",
    "F-NUM-01 F-NUM-02 F-NUM-03 PRJ-08",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN 0 ELSE p_size END AS size, CASE WHEN p_type = 'PROMO' THEN 0 ELSE p_retailprice END AS price
       FROM part""",
)
def _(spark, sf_dir):
    dirty = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 40, F.concat(F.col("p_size"), F.lit("d"))).otherwise(F.concat(F.lit(" "), F.col("p_size"))).alias("size"),
        F.when(F.col("p_type") == "PROMO", F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string")).alias("price"),
    )
    numbers = dirty.withColumns({"size": to_number(F.col("size")), "price": to_number(F.col("price"))})
    return fill_zero(numbers, ["size", "price"]).withColumn("size", F.col("size").cast("int"))


@query(
    "rescale_round",
    "PRJ-06 F-MATH-02",
    """SELECT p_partkey, CAST(round(CAST(p_size AS DECIMAL(9,1)) / 2, 1) AS DOUBLE) AS half,
       CAST(round(CAST(p_size AS DECIMAL(18,6)) / 4, 1) AS DOUBLE) AS quarter_up,
       CASE WHEN p_size % 4 IN (1, 3) THEN round_even(p_size / 4.0, 1) ELSE p_size / 4.0 END AS quarter_even FROM part""",
)
def _(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        rescale(size, 2.0, 1).alias("half"),
        round_half_up(size / F.lit(4.0), 1).alias("quarter_up"),
        round_half_even(size / F.lit(4.0), 1).alias("quarter_even"),
    )


@query("strip_text", "F-STR-02 F-STR-05 UDF-03", "SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS brand FROM part")
def _(spark, sf_dir):
    padded = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("\t  "), F.col("p_name"), F.lit(" \r\n")).alias("p_name"))
    return padded.select("p_partkey", strip(F.col("p_name")).alias("p_name"), first_word(F.col("p_name")).alias("brand"))
