"""Exchange-rate documents: JSON to key/value rows to an insert-only table. Event types stand in for currencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import amount, as_double
from millrace.functions.semi import at, flatten_members, flatten_object, flatten_variant, items, parse
from millrace.functions.times import from_epoch_seconds, ntz, to_epoch_seconds
from millrace.operators.merge import merge_insert_only
from millrace.plans.registry import query
from millrace.plans.tables import table
from millrace.session import new_folder
from millrace.sinks.files import write_csv
from millrace.sources.files import read_csv

_RATE_KEY = ["timestamp_utc", "base_currency", "target_currency"]


def rate_documents(spark, sf_dir) -> DataFrame:
    """One document per day, with the day's mean value per event type as rate; Sunday's arrive an hour late."""
    day = F.date_trunc("DAY", "ts").cast("timestamp_ntz")
    means = table(spark, sf_dir, "events").groupBy(day.alias("day"), "event_type").agg(amount("value").mean().alias("rate"))
    # whatever types there are; one without a name can't be a key and fails
    priced = means.groupBy("day").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("event_type", "rate")))).alias("rates"))
    doc = F.to_json(F.struct(to_epoch_seconds(F.col("day")).alias("timestamp"), F.lit("USD").alias("base"), F.col("rates")))
    late = F.dayofweek("day") == 1
    return priced.select(F.when(late, F.col("day") + F.expr("interval 1 hour")).otherwise(F.col("day")).alias("load_timestamp"), doc.alias("doc"))


_RATES_SQL = """rates AS (
  SELECT date_trunc('day', ts)::TIMESTAMP AS timestamp_utc, 'USD' AS base_currency, event_type AS target_currency,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS exchange_rate FROM events GROUP BY 1, 2, 3)"""


@query(
    "json_path",
    "F-JSON-01 F-JSON-02 SRC-10",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
       CAST(NULL AS VARCHAR) AS missing FROM events""",
)
def _(spark, sf_dir):
    props = table(spark, sf_dir, "events").select("event_id", parse(F.col("props")).alias("v"))
    return props.select(
        "event_id", at(F.col("v"), "$.k", "bigint").alias("k"), at(F.col("v"), "$.k", "string").alias("k_text"), at(F.col("v"), "$.base", "string").alias("missing")
    )


@query("json_flatten", "JOIN-06 F-JSON-04 UDF-04", f"WITH {_RATES_SQL} SELECT timestamp_utc AS day, target_currency AS key, exchange_rate AS value FROM rates")
def _(spark, sf_dir):
    flat = flatten_object(rate_documents(spark, sf_dir), "doc", "$.rates", "double")
    return flat.select(from_epoch_seconds(F.get_json_object("doc", "$.timestamp").cast("bigint")).alias("day"), "key", "value")


@query(
    "json_flatten_members",
    "UDF-04 JOIN-06 F-JSON-04",
    """WITH c AS (SELECT c_custkey AS customer_id, c_name, c_nationkey AS n, c_mktsegment AS s FROM customer)
       SELECT customer_id, 'name' AS key, 'STRING' AS kind, '"' || c_name || '"' AS text FROM c WHERE s <> 'MACHINERY'
       UNION ALL SELECT customer_id, 'nation', 'BIGINT', n::VARCHAR FROM c WHERE s <> 'MACHINERY'
       UNION ALL SELECT customer_id, 'tags', CASE WHEN n = 0 THEN 'ARRAY<VOID>' ELSE 'ARRAY<VARIANT>' END,
                        CASE WHEN n = 0 THEN '[]' ELSE '["' || s || '",' || n || ']' END FROM c WHERE s <> 'MACHINERY'
       UNION ALL SELECT customer_id, 'more', 'OBJECT<a: OBJECT<>, b: BOOLEAN>', '{"a":{},"b":true}' FROM c WHERE s <> 'MACHINERY'
       UNION ALL SELECT customer_id, 'none', 'VOID', 'null' FROM c WHERE s <> 'MACHINERY'
       UNION ALL SELECT customer_id, NULL, NULL, NULL FROM c WHERE s = 'MACHINERY'""",
)
def _(spark, sf_dir):
    """Members of any type; a document without members stays as a row."""
    tags = F.when(F.col("c_nationkey") == 0, F.lit("[]")).otherwise(F.concat(F.lit('["'), "c_mktsegment", F.lit('",'), F.col("c_nationkey").cast("string"), F.lit("]")))
    parts = ['{"doc":{"name":"', F.col("c_name"), '","nation":', F.col("c_nationkey").cast("string"), ',"tags":', tags, ',"more":{"b":true,"a":{}},"none":null}}']
    whole = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    doc = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit('{"doc":{}}')).otherwise(whole)
    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), parse(doc).alias("v"))
    members = flatten_members(docs, "v", "$.doc", outer=True)
    return members.select("customer_id", "key", F.schema_of_variant("value").alias("kind"), F.to_json("value").alias("text"))


def stage_rates(raw: DataFrame) -> DataFrame:
    """RAW rows whose document time is their load time, as one row per currency."""
    stamped = raw.withColumn("timestamp_utc", from_epoch_seconds(at(F.col("response_raw"), "$.timestamp", "bigint")))
    due = stamped.where(F.col("timestamp_utc") == F.col("load_timestamp"))
    flat = flatten_variant(due, "response_raw", "$.rates", "double", "target_currency", "exchange_rate")
    return flat.select("timestamp_utc", at(F.col("response_raw"), "$.base", "string").alias("base_currency"), "target_currency", "exchange_rate")


def load_rates(documents: DataFrame, main: DataFrame, folder: str) -> DataFrame:
    """RAW and STG are replaced, then what the main table lacks is returned for appending."""
    spark = documents.sparkSession
    raw = documents.select(F.uuid().alias("id"), "load_timestamp", parse(F.col("doc")).alias("response_raw"))
    raw.write.mode("overwrite").parquet(f"{folder}/raw")
    staged = stage_rates(spark.read.schema(raw.schema).parquet(f"{folder}/raw"))
    staged.write.mode("overwrite").parquet(f"{folder}/stg")
    return merge_insert_only(main, spark.read.schema(staged.schema).parquet(f"{folder}/stg"), _RATE_KEY)


@query(
    "rates_chain",
    "TBL-17 TBL-12 TBL-03 FLT-08 F-MISC-01 F-JSON-01 UDF-06",
    f"""WITH {_RATES_SQL} SELECT timestamp_utc, base_currency, target_currency,
        CASE WHEN timestamp_utc < TIMESTAMP '2024-01-10' THEN 1.0::DOUBLE ELSE exchange_rate END AS exchange_rate FROM rates
        WHERE timestamp_utc < TIMESTAMP '2024-01-10' OR dayofweek(timestamp_utc) <> 0""",
)
def _(spark, sf_dir):
    # the main table already holds the first days, at rate 1
    loaded = table(spark, sf_dir, "events").where(F.col("ts") < ntz("2024-01-10 00:00:00"))
    main = loaded.select(
        F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("timestamp_utc"), F.lit("USD").alias("base_currency"),
        F.col("event_type").alias("target_currency"), F.lit(1.0).alias("exchange_rate"),
    ).distinct()
    return main.unionByName(load_rates(rate_documents(spark, sf_dir), main, new_folder(spark, "rates")))


@query(
    "insert_only_merge",
    "TBL-12 JOIN-04",
    """SELECT o_custkey, o_orderdate, CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS DOUBLE) AS total FROM orders a
       WHERE o_orderstatus = 'F' GROUP BY 1, 2
       UNION ALL SELECT o_custkey, o_orderdate, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders a
       WHERE NOT EXISTS (SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F' AND f.o_custkey = a.o_custkey AND f.o_orderdate = a.o_orderdate)
       GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")

    def daily(df):
        return df.groupBy("o_custkey", "o_orderdate").agg(amount("o_totalprice").sum().alias("total"))

    main = daily(orders.where("o_orderstatus = 'F'"))
    return main.unionByName(merge_insert_only(main, daily(orders), ["o_custkey", "o_orderdate"]))


@query(
    "json_list_or_object",
    "SRC-11 F-JSON-03 F-CND-03 F-STR-09",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE c_name END AS symbol, c_acctbal AS price, 0 AS item FROM customer
       UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal * 2, 1 FROM customer WHERE c_nationkey < 10""",
)
def _(spark, sf_dir):
    # some documents are one object, some a list of two; a record without symbol takes its file's name
    first = F.struct(F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("symbol"), F.col("c_acctbal").alias("price"), F.lit(0).alias("item"))
    second = F.struct(F.lit(None).cast("string").alias("symbol"), (F.col("c_acctbal") * 2).alias("price"), F.lit(1).alias("item"))
    doc = F.when(F.col("c_nationkey") < 10, F.to_json(F.array(first, second))).otherwise(F.to_json(first))
    docs = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("file_name"), doc.alias("doc"))
    rows = items(docs, "doc", "symbol: string, price: double, item: int")
    return rows.select("c_custkey", F.coalesce("symbol", "file_name").alias("symbol"), "price", "item")


# ---------------------------------------------------------------- conversion by a lookup of rates


def convert(df: DataFrame, amount: Column, rates: DataFrame, currencies: list[str], digits: int = 2) -> DataFrame:
    """One rounded column per currency. Each rate is a scalar subquery: one value, whatever the table's size."""
    wanted = {
        f"in_{c.lower()}": F.round(amount * rates.where(F.col("currency") == c).select("rate").scalar(), digits).cast("double") for c in currencies
    }
    return df.withColumns(wanted)


def _nation_rates(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey"), F.col("n_name").alias("currency"), ((F.col("n_nationkey") + 3) / 8).cast("decimal(9,3)").alias("rate")
    )


@query(
    "currency_convert",
    "PRJ-07 F-MATH-02",
    "SELECT p_partkey, "
    + ", ".join(
        f"CAST(round(CAST(p_retailprice AS DECIMAL(9,2)) * (SELECT CAST((n_nationkey + 3) / 8.0 AS DECIMAL(9,3)) FROM nation WHERE n_name = 'NATION_{n}'), 2) AS DOUBLE) AS in_nation_{n}"
        for n in (1, 2, 3)
    )
    + " FROM part",
)
def _(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(9,2)").alias("price"))
    return convert(parts, F.col("price"), _nation_rates(spark, sf_dir), ["NATION_1", "NATION_2", "NATION_3"]).drop("price")


@query(
    "lookup_join",
    "JOIN-05",
    """SELECT c_custkey, n_name AS currency, CAST(round(CAST(c_acctbal AS DECIMAL(18,2)) * CAST((n_nationkey + 3) / 8.0 AS DECIMAL(9,3)), 2) AS DOUBLE) AS converted
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _(spark, sf_dir):
    # no hint: Spark broadcasts the lookup while its files stay below the broadcast limit
    rates = _nation_rates(spark, sf_dir).withColumnRenamed("n_nationkey", "c_nationkey")
    joined = table(spark, sf_dir, "customer").join(rates, "c_nationkey")
    return joined.select("c_custkey", "currency", as_double(F.round(F.col("c_acctbal").cast("decimal(18,2)") * F.col("rate"), 2)).alias("converted"))


@query(
    "lookup_from_csv",
    "SRC-05 JOIN-05 SNK-01",
    """SELECT s_suppkey, n_name AS currency, CAST(round(CAST(s_acctbal AS DECIMAL(18,2)) * CAST((n_nationkey + 3) / 8.0 AS DECIMAL(9,3)), 2) AS DOUBLE) AS converted
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def _(spark, sf_dir):
    folder = new_folder(spark, "rates-csv")
    write_csv(_nation_rates(spark, sf_dir), folder)
    rates = read_csv(spark, folder, "n_nationkey int, currency string, rate decimal(9,3)").withColumnRenamed("n_nationkey", "s_nationkey")
    joined = table(spark, sf_dir, "supplier").join(rates, "s_nationkey")
    return joined.select("s_suppkey", "currency", as_double(F.round(F.col("s_acctbal").cast("decimal(18,2)") * F.col("rate"), 2)).alias("converted"))
