"""Bulk loads with their policies, file round trips, row checks and run reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.semi import row_json
from millrace.functions.text import path_value
from millrace.functions.times import hour_parts
from millrace.operators.quality import (
    expect_count,
    log_stage,
    missing_tables,
    read_log,
    run_summary,
    same_schema,
    split_valid,
    watch_load,
)
from millrace.plans.registry import query
from millrace.plans.tables import table
from millrace.session import new_folder
from millrace.sinks.files import keyed_messages, narrow, publish, write_csv, write_hourly_json, write_partitioned
from millrace.sources.files import (
    COMMA,
    CORRUPT,
    FILE,
    PIPE,
    DelimitedFormat,
    keep_good_rows,
    list_staged,
    load_report,
    read_csv,
    read_json_documents,
    read_json_lines,
    read_staged,
    register_partitions,
    skip_bad_files,
    with_batch,
)
from millrace.sources.quoted import read_quoted_csv
from millrace.sources.tables import bound_query, create_database, create_table, save_table

_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
_HEADLESS_PIPE = DelimitedFormat(separator="|", header=False)
# damaged rows: debtors of the Asian nations
_DAMAGED_SQL = "c_acctbal < 0 AND c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')"


def _damage(spark, sf_dir) -> DataFrame:
    """Customers with ``damaged`` set for debtors of the Asian nations."""
    asia = table(spark, sf_dir, "region").where("r_name = 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey"))
    there = table(spark, sf_dir, "nation").join(asia, "n_regionkey").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(True).alias("_asia"))
    marked = table(spark, sf_dir, "customer").join(there, "c_nationkey", "left")
    return marked.withColumn("damaged", F.col("_asia").isNotNull() & (F.col("c_acctbal") < 0)).drop("_asia")


def _stage_text(spark, sf_dir) -> str:
    """Headerless pipe files, one folder per nation; damaged rows have a bad balance or one field too many."""
    balance = F.when(F.col("damaged"), F.lit("oops")).otherwise(F.col("c_acctbal").cast("string"))
    extra = F.when(F.col("damaged") & (F.col("c_acctbal") < -500), F.lit("|spilled")).otherwise(F.lit(""))
    line = F.concat(F.concat_ws("|", "c_custkey", "c_name", "c_nationkey", balance, "c_mktsegment"), extra)
    folder = new_folder(spark, "customer-text")
    lines = _damage(spark, sf_dir).select(line.alias("value"), F.col("c_nationkey").alias("nation"))
    lines.hint("rebalance", "nation").write.partitionBy("nation").text(folder)
    return folder


def _stage_csv(spark, sf_dir, by: str) -> str:
    """Pipe files with header, one folder per value of a column; damaged rows have a bad balance."""
    folder = new_folder(spark, "customer-csv")
    balance = F.when(F.col("damaged"), F.lit("oops")).otherwise(F.col("c_acctbal").cast("string"))
    rows = _damage(spark, sf_dir).withColumn("c_acctbal", balance).withColumn("part", F.col(by))
    columns = [c.split()[0] for c in _CUSTOMER.split(", ")]
    out = rows.select(*columns, "part").hint("rebalance", "part")
    out.write.partitionBy("part").option("header", True).option("sep", "|").csv(folder)
    return folder


@query(
    "load_continue",
    "SRC-07 SRC-03 DQ-05",
    f"SELECT * FROM customer WHERE NOT ({_DAMAGED_SQL})",
)
def _(spark, sf_dir):
    good, _ = keep_good_rows(read_staged(spark, _stage_text(spark, sf_dir), _CUSTOMER, _HEADLESS_PIPE))
    return good.drop(FILE)


@query(
    "load_rejects",
    "SRC-07 DQ-05",
    f"""SELECT CASE WHEN c_acctbal < -500 THEN 'wrong number of fields' ELSE 'bad value in c_acctbal' END AS reason, c_nationkey AS nation,
        COUNT(*) AS n FROM customer WHERE {_DAMAGED_SQL} GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    _, bad = keep_good_rows(read_staged(spark, _stage_text(spark, sf_dir), _CUSTOMER, _HEADLESS_PIPE))
    nation = path_value(F.col(FILE), "nation").cast("int")
    return bad.groupBy(F.col("_reason").alias("reason"), nation.alias("nation")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "load_skip_file",
    "SRC-06 SRC-03 JOIN-04",
    f"SELECT * FROM customer WHERE c_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE {_DAMAGED_SQL})",
)
def _(spark, sf_dir):
    # a nation may fill several files here, so the folder is the unit that is skipped
    staged = read_staged(spark, _stage_csv(spark, sf_dir, "c_nationkey"), _CUSTOMER, PIPE)
    return skip_bad_files(staged, path_value(F.col(FILE), "part")).drop(FILE)


@query(
    "load_report",
    "SRC-06 DQ-03",
    f"SELECT CAST(c_nationkey AS VARCHAR) AS unit, COUNT(*) AS rows_parsed, COUNT(*) FILTER ({_DAMAGED_SQL}) AS errors_seen FROM customer GROUP BY 1",
)
def _(spark, sf_dir):
    staged = read_staged(spark, _stage_csv(spark, sf_dir, "c_nationkey"), _CUSTOMER, PIPE)
    return load_report(staged, path_value(F.col(FILE), "part"))


@query(
    "load_pattern",
    "SRC-08 SRC-03",
    f"SELECT * FROM customer WHERE regexp_matches(c_mktsegment, '^(BUILD|MACH)') AND NOT ({_DAMAGED_SQL})",
)
def _(spark, sf_dir):
    staged = read_staged(spark, _stage_csv(spark, sf_dir, "c_mktsegment"), _CUSTOMER, PIPE, name_pattern="/part=(BUILD|MACH)[^/]*/")
    return keep_good_rows(staged)[0].drop(FILE)


@query(
    "load_positional_batch",
    "SRC-09 PRJ-09",
    f"SELECT '20240105' AS batch_id, c_custkey AS id, c_name AS full_name, c_nationkey AS home, c_acctbal AS funds, c_mktsegment AS kind FROM customer WHERE NOT ({_DAMAGED_SQL})",
)
def _(spark, sf_dir):
    staged = read_staged(spark, _stage_text(spark, sf_dir), "id bigint, full_name string, home int, funds double, kind string", _HEADLESS_PIPE)
    return with_batch(keep_good_rows(staged)[0], "2024/01/05")


@query("staged_files", "SRC-17 F-STR-07", "SELECT DISTINCT c_mktsegment AS part FROM customer")
def _(spark, sf_dir):
    files = list_staged(spark, _stage_csv(spark, sf_dir, "c_mktsegment"), ".csv")
    return files.where("length > 0").select(path_value(F.col("path"), "part").alias("part")).distinct()


@query(
    "csv_round_trip",
    "SNK-01 SRC-01 SRC-04",
    """SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS index, p_partkey, 'a "' || p_name || '", b' AS label, p_retailprice FROM part""",
)
def _(spark, sf_dir):
    folder = new_folder(spark, "part-csv")
    label = F.concat(F.lit('a "'), "p_name", F.lit('", b')).alias("label")
    rows = table(spark, sf_dir, "part").select("p_partkey", label, "p_retailprice")
    write_csv(rows, folder, index_by=["p_partkey"])
    return read_csv(spark, folder, "index bigint, p_partkey bigint, label string, p_retailprice double", COMMA)


@query("csv_line_breaks", "SRC-04 SNK-01", """SELECT p_partkey, p_name || chr(10) || '"' || p_type || '",' || chr(10) AS label, p_retailprice FROM part""")
def _(spark, sf_dir):
    folder = new_folder(spark, "part-lines")
    label = F.concat("p_name", F.lit('\n"'), "p_type", F.lit('",\n')).alias("label")
    write_csv(table(spark, sf_dir, "part").select("p_partkey", label, "p_retailprice"), folder)
    return read_csv(spark, folder, "p_partkey bigint, label string, p_retailprice double", DelimitedFormat(lines_in_fields=True))


@query("csv_one_large_file", "SRC-04", """SELECT p_partkey, p_name || chr(10) || '"' || p_type || '",' || chr(10) AS label, p_retailprice FROM part""")
def _(spark, sf_dir):
    """One file, cut into byte ranges wherever they fall; the ranges are small here, so that small tables have several."""
    folder = new_folder(spark, "part-file")
    label = F.concat("p_name", F.lit('\n"'), "p_type", F.lit('",\n')).alias("label")
    write_csv(table(spark, sf_dir, "part").select("p_partkey", label, "p_retailprice").coalesce(1), folder)
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    return read_quoted_csv(session, folder, "p_partkey bigint, label string, p_retailprice double")


@query(
    "csv_sentinels",
    "SRC-02 SRC-01",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS priority,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders""",
)
def _(spark, sf_dir):
    folder = new_folder(spark, "orders-csv")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(F.col("o_totalprice").cast("string"))
    priority = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("Not Available")).otherwise(F.col("o_orderpriority"))
    write_csv(table(spark, sf_dir, "orders").select("o_orderkey", priority.alias("priority"), price.alias("price")), folder)
    return read_csv(spark, folder, "o_orderkey bigint, priority string, price double", sentinels=("Not Available", "unknown"))


_TICK = "tick_id bigint, symbol string, price double, timestamp timestamp_ntz"


def _ticks(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("tick_id"), F.col("event_type").alias("symbol"), F.col("value").alias("price"), F.col("ts").alias("timestamp")
    )


def stage_ticks(spark, sf_dir, broken_below: float = 1.0) -> str:
    """Ticks as JSON lines; lines of ticks priced below the bound are cut short."""
    folder = new_folder(spark, "ticks")
    doc = row_json("tick_id", "symbol", "price", "timestamp")
    line = F.when(F.col("price") < broken_below, F.substring(doc, 1, 20)).otherwise(doc)
    _ticks(spark, sf_dir).select(line.alias("value")).write.text(folder)
    return folder


TICKS_SQL = "SELECT event_id AS tick_id, event_type AS symbol, value AS price, ts AS timestamp FROM events"


@query("load_json_lines", "SRC-10 SRC-11 F-JSON-03 PRJ-08", f"{TICKS_SQL} WHERE value >= 1")
def _(spark, sf_dir):
    return read_json_lines(spark, stage_ticks(spark, sf_dir), _TICK).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


@query(
    "json_documents",
    "SRC-12 SRC-14 F-STR-09",
    """SELECT CAST(CASE WHEN c_custkey % 100 = 0 THEN 'one' ELSE 'many' END || (c_custkey // 100) AS VARCHAR) AS document, c_custkey AS id,
       c_name AS name, c_acctbal AS average FROM customer""",
)
def _(spark, sf_dir):
    """Files that hold one object, or an array of up to 99; a record takes its key from the path of its file."""
    folder = new_folder(spark, "documents")
    many = F.col("c_custkey") % 100 != 0
    document = F.concat(F.when(many, F.lit("many")).otherwise(F.lit("one")), F.floor(F.col("c_custkey") / 100))
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.struct(F.col("c_acctbal").alias("average")).alias("rating"))
    files = table(spark, sf_dir, "customer").groupBy(document.alias("document")).agg(F.collect_list(record).alias("all"))
    text = F.when(F.col("document").startswith("many"), F.to_json("all")).otherwise(F.to_json(F.col("all")[0]))
    files.select("document", text.alias("value")).write.partitionBy("document").text(folder)
    found = read_json_documents(spark, folder, "id bigint, name string, rating struct<average: double>")
    return found.select(path_value(F.col(FILE), "document").alias("document"), "id", "name", F.col("rating.average").alias("average"))


@query(
    "hourly_json",
    "SNK-07 F-DT-05",
    f"SELECT *, strftime(timestamp, '%Y') AS year, strftime(timestamp, '%m') AS month, strftime(timestamp, '%d') AS day, strftime(timestamp, '%H') AS hour FROM ({TICKS_SQL})",
)
def _(spark, sf_dir):
    folder = new_folder(spark, "hourly")
    write_hourly_json(_ticks(spark, sf_dir), folder, F.col("timestamp"))
    parts = ", ".join(f"{p} string" for p in hour_parts(F.col("timestamp")))
    return spark.read.schema(f"{_TICK}, {parts}").json(folder)


@query("published_rows", "SNK-10 UDF-07", f"SELECT symbol AS key, * FROM ({TICKS_SQL})")
def _(spark, sf_dir):
    topic = new_folder(spark, "topic")
    publish(_ticks(spark, sf_dir), "symbol", "json", {"path": topic})
    sent = spark.read.schema("key string, value string").json(topic)
    return sent.select("key", F.from_json(F.col("value"), _TICK, {"mode": "FAILFAST"}).alias("r")).select("key", "r.*")


@query("keyed_messages", "STM-06 UDF-07 F-JSON-03", f"SELECT symbol AS key, * FROM ({TICKS_SQL})")
def _(spark, sf_dir):
    messages = keyed_messages(_ticks(spark, sf_dir), "symbol")
    sent = messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    record = F.from_json(F.col("value").cast("string"), _TICK)
    return sent.select(F.col("key").cast("string").alias("key"), record.alias("r")).select("key", "r.*")


@query(
    "narrow_types",
    "SNK-06 F-NUM-03",
    "SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity FROM lineitem",
)
def _(spark, sf_dir):
    return narrow(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), {"l_orderkey": "int", "l_quantity": "int"})


@query("registered_partitions", "SRC-16 SRC-15 DQ-02", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(spark, sf_dir):
    folder, name = new_folder(spark, "customer-parts"), f"customer_{uuid.uuid4().hex[:8]}"
    write_partitioned(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), folder, ["c_mktsegment"])
    external = register_partitions(spark, name, folder, "c_custkey bigint, c_acctbal double, c_mktsegment string", ["c_mktsegment"])
    return external.where("c_mktsegment = 'BUILDING'")


@query("catalog_table", "SRC-21 SNK-02 SNK-11 DQ-02 TBL-01", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT -s_suppkey, s_name FROM supplier")
def _(spark, sf_dir):
    database = f"shop_{uuid.uuid4().hex[:8]}"
    create_database(spark, database, new_folder(spark, "database"))
    name = f"{database}.people"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for _attempt in range(2):
        save_table(customers, name, replace=True)
    suppliers = table(spark, sf_dir, "supplier").select((-F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"))
    save_table(suppliers, name, replace=False)
    if missing_tables(spark, [name]) or not same_schema(spark.table(name), customers.schema):
        raise LookupError(f"{name} was not made as asked")
    return spark.table(name)


# ---------------------------------------------------------------- checks and reports


@query(
    "split_valid_rows",
    "DQ-05",
    """SELECT CASE WHEN o_totalprice < 100000 THEN 'too small' WHEN o_orderstatus = 'P' THEN 'pending' END AS reason, COUNT(*) AS n,
       CAST(SUM(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""",
)
def _(spark, sf_dir):
    rules = {"too small": F.col("o_totalprice") >= 100000, "pending": F.col("o_orderstatus") != "P"}
    good, bad = split_valid(table(spark, sf_dir, "orders"), rules)
    both = good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query(
    "checked_insert",
    "SNK-03 DQ-05",
    """SELECT CASE WHEN c_acctbal < 0 THEN 'in debt' WHEN c_nationkey > 20 THEN 'far away' END AS reason, COUNT(*) AS n,
       CAST(SUM(c_custkey) AS BIGINT) AS key_sum FROM customer GROUP BY 1""",
)
def _(spark, sf_dir):
    """Good rows go into a table, bad rows with their reason into a reject table."""
    database = f"checked_{uuid.uuid4().hex[:8]}"
    create_database(spark, database, new_folder(spark, "database"))
    good, bad = split_valid(table(spark, sf_dir, "customer"), {"in debt": F.col("c_acctbal") >= 0, "far away": F.col("c_nationkey") <= 20})
    save_table(good, f"{database}.customer", replace=False)
    save_table(bad, f"{database}.customer_rejects", replace=False)
    both = spark.table(f"{database}.customer").withColumn("reason", F.lit(None).cast("string")).unionByName(spark.table(f"{database}.customer_rejects"))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("key_sum"))


@query(
    "default_values",
    "SNK-12 TBL-02 TBL-03 F-DT-06 F-MISC-01",
    "SELECT COUNT(*) AS n, COUNT(DISTINCT p_partkey) AS row_ids, COUNT(*) AS ids_set, COUNT(*) AS made_since_start, CAST(SUM(p_partkey) AS BIGINT) AS key_sum FROM part",
)
def _(spark, sf_dir):
    """Rows get a random id on the way in and the table's default time of creation."""
    database = f"made_{uuid.uuid4().hex[:8]}"
    create_database(spark, database, new_folder(spark, "database"))
    name = f"{database}.part"
    create_table(spark, name, "row_id string, p_partkey bigint, created_at timestamp DEFAULT current_timestamp()")
    start = spark.range(1).select(F.current_timestamp()).first()[0]
    rows = table(spark, sf_dir, "part").select(F.uuid().alias("row_id"), "p_partkey")
    bound_query(spark, f"INSERT INTO {name} (row_id, p_partkey) SELECT row_id, p_partkey FROM {{rows}}", {}, rows=rows)
    return spark.table(name).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("row_id").alias("row_ids"),
        F.count("row_id").alias("ids_set"),
        F.count_if(F.col("created_at") >= F.lit(start)).alias("made_since_start"),
        F.sum("p_partkey").alias("key_sum"),
    )


@query("load_audit", "DQ-01 DQ-04", "SELECT 'load' AS stage, 'orders written' AS message, COUNT(*) AS n_rows FROM orders")
def _(spark, sf_dir):
    folder, log = new_folder(spark, "orders-main"), new_folder(spark, "audit")
    watched, seen = watch_load(table(spark, sf_dir, "orders"), "orders")
    watched.write.parquet(folder)
    n_rows = seen.get["n_rows"]
    expect_count(spark.read.schema(watched.schema).parquet(folder), n_rows)
    log_stage(spark, log, "load", "orders written", n_rows)
    return read_log(spark, log).select("stage", "message", "n_rows")


@query(
    "run_summary",
    "DQ-03 F-STR-09",
    """SELECT event_type AS symbol, COUNT(DISTINCT CAST(ts AS DATE)) AS units, COUNT(*) AS records FROM events GROUP BY event_type
       UNION ALL SELECT NULL, COUNT(DISTINCT CAST(ts AS DATE)), COUNT(*) FROM events""",
)
def _(spark, sf_dir):
    loaded = _ticks(spark, sf_dir).select(F.to_date("timestamp").alias("unit"), "symbol")
    return run_summary(loaded, "unit", "symbol")
