"""Projections, scalar functions and whole-table figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import amount, as_double
from millrace.functions.semi import items
from millrace.functions.text import (
    blank_sentinels,
    drop_literal,
    last_path_part,
    lower,
    move_path,
    path_value,
    snake_names,
    strip_names,
)
from millrace.functions.times import from_epoch_seconds, ntz, parse_date, seconds_between, to_epoch_seconds
from millrace.operators.aggregate import occurring_once, occurring_repeatedly
from millrace.operators.ordered import with_identity
from millrace.operators.profile import QUARTILES, column_profile, non_null_counts
from millrace.operators.sketches import add_profile, merged_profile
from millrace.plans.registry import query
from millrace.plans.tables import table
from millrace.session import new_folder
from millrace.sources.tables import bound_query

# ---------------------------------------------------------------- whole-table figures


@query("row_count", "AGG-10 DQ-01", "SELECT COUNT(*) AS n_rows FROM orders")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "global_avg",
    "AGG-11",
    "SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS avg_price FROM orders",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(amount("o_totalprice").mean().alias("avg_price"))


@query(
    "single_occurrence_keys",
    "AGG-13 DQ-06",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) = 1",
)
def _(spark, sf_dir):
    return occurring_once(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_keys",
    "AGG-13 DQ-06",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1",
)
def _(spark, sf_dir):
    return occurring_repeatedly(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_PROFILED = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(column: str) -> str:
    def rounded(x: str) -> str:
        return f"CAST(round(CAST({x} AS DECIMAL(28,10)), 4) AS DOUBLE)"

    picks = ", ".join(f"{rounded(f'quantile_cont(CAST({column} AS DOUBLE), {p})')} AS {n}" for n, p in QUARTILES.items())
    return f"""SELECT '{column}' AS column_name, COUNT(*) AS n_rows, COUNT({column}) AS n_values, {rounded(f'avg(CAST({column} AS DOUBLE))')} AS mean,
        {rounded(f'stddev_samp(CAST({column} AS DOUBLE))')} AS stddev, {rounded(f'min({column})')} AS min, {picks},
        {rounded(f'max({column})')} AS max FROM lineitem"""


@query("column_profile", "AGG-19 DQ-07", " UNION ALL ".join(_profile_sql(c) for c in _PROFILED))
def _(spark, sf_dir):
    return column_profile(table(spark, sf_dir, "lineitem"), _PROFILED)


@query(
    "load_profiles",
    "AGG-19 DQ-07",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT({c}) AS n_values,
            CAST(min({c}) AS DOUBLE) + CAST(0 AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) + CAST(0 AS DOUBLE) AS max FROM lineitem"""
        for c in _PROFILED
    ),
)
def _(spark, sf_dir):
    # a load per line status, added up; the estimates beside these exact figures are tested apart
    folder = new_folder(spark, "profiles")
    lines = table(spark, sf_dir, "lineitem")
    shipped = F.col("l_linestatus").eqNullSafe("F")
    for load, part in (("shipped", lines.where(shipped)), ("open", lines.where(~shipped))):
        add_profile(part, _PROFILED, load, folder)
    return merged_profile(spark, folder).select("column_name", "n_rows", "n_values", "min", "max")


@query(
    "non_null_profile",
    "DQ-07 AGG-19",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS column_type, COUNT({c}) AS n_values, COUNT(*) AS n_rows FROM orders"
        for c, k in (
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
            ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
        )
    ),
)
def _(spark, sf_dir):
    return non_null_counts(table(spark, sf_dir, "orders"))


# ---------------------------------------------------------------- projections and limits


@query("projection", "PRJ-01", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query("select_all", "PRJ-02", "SELECT * FROM customer")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer")


@query(
    "add_constants",
    "PRJ-09 F-DT-06",
    "SELECT c_custkey, 'b-2024' AS batch_id, 'I' AS dml_type, TIMESTAMP '2024-01-02 00:00:00' AS run_at FROM customer",
)
def _(spark, sf_dir):
    constants = {"batch_id": F.lit("b-2024"), "dml_type": F.lit("I"), "run_at": ntz("2024-01-02 00:00:00")}
    return table(spark, sf_dir, "customer").select("c_custkey").withColumns(constants)


@query(
    "rename_columns",
    "PRJ-03 PRJ-04",
    'SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS "Market Segment" FROM customer',
)
def _(spark, sf_dir):
    snake = snake_names(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Customer ID"), F.col("c_name").alias("Full Name"), "c_mktsegment"))
    return strip_names(snake.withColumnRenamed("c_mktsegment", "  Market Segment "))


@query(
    "lateral_alias",
    "PRJ-10 F-CND-01",
    """SELECT o_orderkey, o_totalprice * 2 AS doubled, CASE WHEN o_totalprice * 2 > 300000 THEN 'big' ELSE 'small' END AS size FROM orders""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice * 2 AS doubled", "CASE WHEN doubled > 300000 THEN 'big' ELSE 'small' END AS size"
    )


@query(
    "first_rows",
    "SRT-05 SRT-02",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10",
)
def _(spark, sf_dir):
    recent = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return recent.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(10)


@query(
    "bound_parameters",
    "F-MISC-02 FLT-02 FLT-06",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 100000 AND o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def _(spark, sf_dir):
    flagged = table(spark, sf_dir, "orders").withColumn("active_flag", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return bound_query(
        spark,
        "SELECT o_orderkey, o_totalprice FROM {flagged} WHERE o_orderstatus = :status AND o_totalprice >= :least AND active_flag = TRUE",
        {"status": "O", "least": 100000.0},
        flagged=flagged,
    )


@query(
    "view_over_query",
    "TBL-20",
    "SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_totalprice > 200000 GROUP BY o_orderstatus",
)
def _(spark, sf_dir):
    table(spark, sf_dir, "orders").where("o_totalprice > 200000").createOrReplaceTempView("v_large_orders")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM v_large_orders GROUP BY o_orderstatus")


@query(
    "union_distinct",
    "SET-01",
    "SELECT n_name AS place, n_regionkey AS region FROM nation JOIN customer ON c_nationkey = n_nationkey UNION SELECT n_name, n_regionkey FROM nation JOIN supplier ON s_nationkey = n_nationkey",
)
def _(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("place"), F.col("n_regionkey").alias("region"))
    homes = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey"))
    sites = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"))
    # a union of distinct rows is the distinct nation keys of both sides, looked up once
    return nation.join(homes.unionByName(sites).distinct(), "n_nationkey").select("place", "region").distinct()


@query("union_all", "SET-02", "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return customers.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")))


@query(
    "identity_keys",
    "SNK-12",
    "SELECT row_number() OVER (ORDER BY p_partkey) + (SELECT max(s_suppkey) FROM supplier) AS id, p_partkey, p_name FROM part",
)
def _(spark, sf_dir):
    last = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).scalar()
    return with_identity(table(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_partkey"], "id", after=last)


# ---------------------------------------------------------------- text, dates, conditions


@query(
    "clean_sentinels",
    "SRC-02",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
       CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', 'P') THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def _(spark, sf_dir):
    return blank_sentinels(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["4-NOT SPECIFIED", "P"])


@query(
    "text_functions",
    "F-STR-01 F-STR-03 F-STR-06 F-STR-07 F-STR-08 F-STR-09 F-STR-10",
    """SELECT c_custkey, lower(c_name) AS low, replace(replace(c_name, '#', ''), 'Customer', '') AS digits,
       contains(c_mktsegment, 'HOLD') AS has_hold, suffix(c_name, '7') AS ends_in_7,
       c_name || ' | ' || c_mktsegment AS joined, lower(c_mktsegment) AS stem, 'done/' || c_mktsegment || '/a.json' AS moved,
       c_mktsegment AS segment_folder FROM customer""",
)
def _(spark, sf_dir):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        lower(name).alias("low"),
        drop_literal(name, "#", "Customer").alias("digits"),
        F.contains(segment, F.lit("HOLD")).alias("has_hold"),
        F.endswith(name, F.lit("7")).alias("ends_in_7"),
        F.array_join(F.array(name, segment), " | ").alias("joined"),
        last_path_part(F.concat(F.lit("s3/profiles/"), F.lower(segment), F.lit(".json")), ".json").alias("stem"),
        move_path(F.concat(F.lit("landing/"), segment, F.lit("/a.json")), "landing/", "done/").alias("moved"),
        path_value(F.concat(F.lit("x/segment="), segment, F.lit("/a.json")), "segment").alias("segment_folder"),
    )


@query(
    "date_functions",
    "F-DT-01 F-DT-02 F-DT-03 F-DT-05 F-DT-07 F-DT-08",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       strftime(o_orderdate, '%Y/%m/%d/%H') AS folder, date_diff('second', TIMESTAMP '1995-01-01 00:00:00', o_orderdate) AS secs,
       CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS due, CAST(o_orderdate AS DATE) AS parsed, CAST(NULL AS DATE) AS unparsed FROM orders""",
)
def _(spark, sf_dir):
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date(d).alias("day"),
        F.year(d).alias("y"),
        F.month(d).alias("m"),
        F.date_format(d, "yyyy/MM/dd/HH").alias("folder"),
        seconds_between(ntz("1995-01-01 00:00:00"), d).alias("secs"),
        F.date_add(F.to_date(d), 30).alias("due"),
        parse_date(F.date_format(d, "yyyy-MM-dd")).alias("parsed"),
        parse_date(F.date_format(d, "dd.MM.yyyy")).alias("unparsed"),
    )


@query(
    "epoch_to_ts",
    "F-DT-04",
    "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, date_trunc('second', ts) AS at FROM events",
)
def _(spark, sf_dir):
    seconds = table(spark, sf_dir, "events").select("event_id", to_epoch_seconds(F.col("ts")).alias("seconds"))
    return seconds.withColumn("at", from_epoch_seconds(F.col("seconds")))


@query(
    "conditional",
    "F-CND-01 F-CND-03",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band,
       coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status, o_orderstatus <> 'F' AS still_open FROM orders""",
)
def _(spark, sf_dir):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(price > 400000, "high").when(price > 100000, "mid").otherwise("low").alias("band"),
        F.coalesce(F.nullif(status, F.lit("P")), F.lit("pending")).alias("status"),
        (status != "F").alias("still_open"),
    )


# ---------------------------------------------------------------- nested records


@query(
    "show_ratings",
    "PRJ-06 F-ARR-02 FLT-02",
    """SELECT p_partkey AS id, p_name AS name, p_type || ',' || p_brand AS genres, CAST(p_size AS DOUBLE) / 5 AS rating,
       CAST(round(CAST(p_size AS DECIMAL(18,6)) / 10, 1) AS DOUBLE) AS rating_5 FROM part WHERE p_size >= 45""",
)
def _(spark, sf_dir):
    # records as the show service sends them: nested rating, array of genres; kept from 4.5 of 5 on
    record = F.to_json(
        F.struct(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.array("p_type", "p_brand").alias("genres"),
            F.struct((F.col("p_size") / 5).alias("average")).alias("rating"),
        )
    )
    shows = items(table(spark, sf_dir, "part").select(record.alias("doc")), "doc", "id: bigint, name: string, genres: array<string>, rating: struct<average: double>")
    flat = shows.select("id", "name", F.array_join("genres", ",").alias("genres"), as_double(F.col("rating.average")).alias("rating"))
    return flat.withColumn("rating_5", F.round(F.col("rating") / 2, 1)).where("rating_5 >= 4.5")
