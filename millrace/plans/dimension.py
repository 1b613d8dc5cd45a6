"""Customer dimension: type-1 merge, change rows, type-2 history, row changes and table versions.

The staged batch is made from the whole customer table by its own columns: one segment changes, one loses a
value, one is delivered twice, the others arrive unchanged, and the suppliers are new customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import amount
from millrace.functions.times import ntz
from millrace.operators.asof import lookup_as_of
from millrace.operators.history import (
    apply_scd2,
    closed_rows,
    current_rows,
    scd2_changes,
    start_history,
    unstamped_updates,
    versions_of,
)
from millrace.operators.merge import (
    delete_where,
    diff_snapshots,
    latest_per_key,
    merge_changes,
    merge_scd1,
    update_where,
)
from millrace.plans.registry import query
from millrace.plans.tables import table
from millrace.session import new_folder, stored
from millrace.sources.versions import BucketedTable, VersionedTable

KEY = ["customer_id"]
FIELDS = ["name", "nation_id", "balance", "segment"]
LOADED, MERGED, REMOVED = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), ntz(LOADED).alias("update_timestamp"),
    )


def staged_customers(spark, sf_dir) -> DataFrame:
    """The batch as delivered, with ``load_seq`` (later deliveries are greater)."""
    same = customers(spark, sf_dir).drop("update_timestamp")
    newest = same.withColumns(
        {
            "balance": F.when(F.col("segment") == "BUILDING", F.col("balance") + 100).otherwise(F.col("balance")),
            "segment": F.when(F.col("segment") != "MACHINERY", F.col("segment")),
            "load_seq": F.lit(2),
        }
    )
    stale = same.where("segment = 'FURNITURE'").withColumns({"balance": F.lit(0.0), "segment": F.lit("OLD"), "load_seq": F.lit(1)})
    fresh = table(spark, sf_dir, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("customer_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation_id"),
        F.col("s_acctbal").alias("balance"), F.lit(None).cast("string").alias("segment"), F.lit(2).alias("load_seq"),
    )
    return newest.unionByName(stale).unionByName(fresh)


def staging(spark, sf_dir) -> DataFrame:
    """One row per customer, stored as a staging table is: the merge reads it more than once."""
    return stored(latest_per_key(staged_customers(spark, sf_dir), KEY, [F.desc("load_seq")]).drop("load_seq"))


def merged(spark, sf_dir, null_safe: bool = False) -> DataFrame:
    return merge_scd1(customers(spark, sf_dir), staging(spark, sf_dir), KEY, FIELDS, ntz(MERGED), null_safe=null_safe)


def after_removal(spark, sf_dir) -> DataFrame:
    """The merged table without the customers that then left."""
    return delete_where(merged(spark, sf_dir), (F.col("segment") == "AUTOMOBILE") & (F.col("balance") < 0))


def changes(spark, sf_dir) -> DataFrame:
    """The change rows, stored as a change stream is: the history reads them more than once."""
    return stored(diff_snapshots(customers(spark, sf_dir), after_removal(spark, sf_dir), KEY))


def history(spark, sf_dir) -> DataFrame:
    """Open rows for all customers, and an earlier closed version for one segment."""
    now = customers(spark, sf_dir)
    earlier = now.where("segment = 'HOUSEHOLD'").select(
        "customer_id", F.concat("name", F.lit(" old")).alias("name"), "nation_id", "balance", "segment",
        ntz("2023-06-01 00:00:00").alias("start_time"), ntz(LOADED).alias("end_time"), F.lit(False).alias("is_current"),
    )
    return start_history(now).unionByName(earlier)


def classified(spark, sf_dir) -> DataFrame:
    return scd2_changes(changes(spark, sf_dir), history(spark, sf_dir), KEY, FIELDS, ntz(REMOVED))


def history_after(spark, sf_dir) -> DataFrame:
    return apply_scd2(history(spark, sf_dir), stored(classified(spark, sf_dir)), KEY)


def _shown(df: DataFrame) -> DataFrame:
    """The open end lies beyond what nanosecond clocks hold, so ends are shown as text."""
    return df.withColumn("end_time", F.date_format("end_time", "yyyy-MM-dd HH:mm:ss"))


_CUST = f"""cust AS (SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id, c_acctbal AS balance,
  c_mktsegment AS segment, TIMESTAMP '{LOADED}' AS update_timestamp FROM customer)"""
_STAGED = f"""{_CUST},
staged_all AS (
  SELECT customer_id, name, nation_id, CASE WHEN segment = 'BUILDING' THEN balance + 100 ELSE balance END AS balance,
         nullif(segment, 'MACHINERY') AS segment, 2 AS load_seq FROM cust
  UNION ALL SELECT customer_id, name, nation_id, 0.0, 'OLD', 1 FROM cust WHERE segment = 'FURNITURE'
  UNION ALL SELECT -s_suppkey - 1, s_name, s_nationkey, s_acctbal, NULL, 2 FROM supplier),
staged AS (SELECT * EXCLUDE (rn, load_seq) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY load_seq DESC) AS rn FROM staged_all) WHERE rn = 1)"""


def _merged_sql(null_safe: bool) -> str:
    op = "IS DISTINCT FROM" if null_safe else "<>"
    diff = " OR ".join(f"coalesce(t.{c} {op} s.{c}, FALSE)" for c in FIELDS)
    picks = ", ".join(f"CASE WHEN take THEN s_{c} ELSE t_{c} END AS {c}" for c in FIELDS)
    both = ", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in FIELDS)
    return f"""{_STAGED},
merged AS (
  SELECT customer_id, {picks}, CASE WHEN take THEN TIMESTAMP '{MERGED}' ELSE t_stamp END AS update_timestamp FROM (
    SELECT coalesce(t.customer_id, s.customer_id) AS customer_id, {both}, t.update_timestamp AS t_stamp,
           t.customer_id IS NULL OR (s.customer_id IS NOT NULL AND ({diff})) AS take
    FROM cust t FULL JOIN staged s ON t.customer_id = s.customer_id))"""


_COLS = ", ".join(FIELDS)
_CHANGES = f"""{_merged_sql(False)},
aft AS (SELECT * FROM merged WHERE NOT coalesce(segment = 'AUTOMOBILE' AND balance < 0, FALSE)),
changes AS (
  SELECT a.*, 'INSERT' AS action, b.customer_id IS NOT NULL AS is_update FROM aft a LEFT JOIN cust b USING (customer_id)
  WHERE b.customer_id IS NULL OR a.update_timestamp <> b.update_timestamp
  UNION ALL SELECT b.*, 'DELETE', a.customer_id IS NOT NULL FROM cust b LEFT JOIN aft a USING (customer_id)
  WHERE a.customer_id IS NULL OR a.update_timestamp <> b.update_timestamp)"""
_HISTORY = f"""{_CHANGES},
hist AS (
  SELECT customer_id, {_COLS}, update_timestamp AS start_time, TIMESTAMP '9999-12-31' AS end_time, TRUE AS is_current FROM cust
  UNION ALL SELECT customer_id, name || ' old', nation_id, balance, segment, TIMESTAMP '2023-06-01', TIMESTAMP '{LOADED}', FALSE
  FROM cust WHERE segment = 'HOUSEHOLD')"""
_NULLS = "NULL, NULL, NULL, NULL"
_CLASSIFIED = f"""{_HISTORY},
line AS (
  SELECT *, lead(start_time) OVER (PARTITION BY grp, customer_id ORDER BY start_time) AS nxt FROM (
    SELECT 'new' AS grp, customer_id, {_COLS}, update_timestamp AS start_time, 'I' AS dml_type FROM changes WHERE action = 'INSERT' AND NOT is_update
    UNION SELECT 'upd', customer_id, {_COLS}, update_timestamp, 'I' FROM changes WHERE action = 'INSERT' AND is_update
    UNION SELECT 'upd', customer_id, {_NULLS}, start_time, 'U' FROM hist WHERE is_current AND customer_id IN (
      SELECT customer_id FROM changes WHERE action = 'DELETE' AND is_update))),
classified AS (
  SELECT customer_id, {_COLS}, start_time, coalesce(nxt, TIMESTAMP '9999-12-31') AS end_time, nxt IS NULL AS is_current, dml_type
  FROM line WHERE dml_type = 'I' OR nxt IS NOT NULL
  UNION SELECT h.customer_id, {_NULLS}, h.start_time, TIMESTAMP '{REMOVED}', NULL, 'D' FROM hist h JOIN changes c USING (customer_id)
  WHERE c.action = 'DELETE' AND NOT c.is_update AND h.is_current)"""
_AFTER = f"""{_CLASSIFIED},
hist_after AS (
  SELECT h.customer_id, {', '.join('h.' + c for c in FIELDS)}, h.start_time, coalesce(c.end_time, h.end_time) AS end_time,
         CASE WHEN c.customer_id IS NULL THEN h.is_current ELSE FALSE END AS is_current
  FROM hist h LEFT JOIN classified c ON c.dml_type IN ('U', 'D') AND c.customer_id = h.customer_id AND c.start_time = h.start_time
  UNION ALL SELECT customer_id, {_COLS}, start_time, end_time, is_current FROM classified c WHERE dml_type = 'I' AND NOT EXISTS (
    SELECT 1 FROM hist h WHERE h.customer_id = c.customer_id AND h.start_time = c.start_time))"""
_END = "strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time"

# ---------------------------------------------------------------- type 1


@query("staging_latest", "DQ-05", f"WITH {_STAGED} SELECT * FROM staged")
def _(spark, sf_dir):
    return staging(spark, sf_dir)


@query("scd1_merge", "TBL-11 FLT-05 JOIN-04 F-DT-06", f"WITH {_merged_sql(False)} SELECT * FROM merged")
def _(spark, sf_dir):
    return merged(spark, sf_dir)


@query("scd1_merge_null_safe", "TBL-11 FLT-05", f"WITH {_merged_sql(True)} SELECT * FROM merged")
def _(spark, sf_dir):
    return merged(spark, sf_dir, null_safe=True)


def run_scd1_batch(target: VersionedTable, staged: VersionedTable, keys, columns, now) -> None:
    """Merge what is staged, commit, then empty the staging table.

    The batch is the version of the staging table: after a crash between the two, a retry finds that version merged and
    only empties it. Rows that were staged meanwhile make a new version, which is merged (again, which changes nothing).
    """
    version = staged.version()
    batch = f"staged-{version}"
    if staged.read(version).isEmpty():
        return
    if not target.has_batch(batch):
        target.commit(merge_scd1(target.read(), staged.read(version), keys, columns, now), "merge", batch)
    staged.commit(staged.read(version).limit(0), "truncate", batch)


@query("scd1_batch", "TBL-13 UDF-06 TBL-04", f"WITH {_merged_sql(False)} SELECT *, CAST(0 AS BIGINT) AS left_in_staging FROM merged")
def _(spark, sf_dir):
    target, staged = (VersionedTable(spark, new_folder(spark, n)) for n in ("dim", "dim-staging"))
    target.commit(customers(spark, sf_dir))
    staged.commit(staging(spark, sf_dir))
    for _attempt in range(2):  # the second run stands for a retry
        run_scd1_batch(target, staged, KEY, FIELDS, ntz(MERGED))
    left = staged.read().agg(F.count(F.lit(1))).scalar()
    return target.read().withColumn("left_in_staging", left)


@query("scd1_merge_buckets", "TBL-11 TBL-19", f"WITH {_merged_sql(False)} SELECT * FROM merged")
def _(spark, sf_dir):
    # only the buckets that staged keys fall into are read and rewritten
    target, staged = customers(spark, sf_dir), staging(spark, sf_dir)
    dim = BucketedTable(spark, new_folder(spark, "dim-buckets"), target.schema, KEY, buckets=16)
    dim.replace(target)
    dim.change(staged, lambda rows: merge_scd1(rows, staged, KEY, FIELDS, ntz(MERGED)))
    return dim.read()


# ---------------------------------------------------------------- change rows


@query("snapshot_diff", "TBL-14", f"WITH {_CHANGES} SELECT * FROM changes")
def _(spark, sf_dir):
    return changes(spark, sf_dir)


@query("merge_change_rows", "TBL-14 STM-11", f"WITH {_CHANGES.replace('AND balance < 0', 'AND FALSE')} SELECT * FROM changes")
def _(spark, sf_dir):
    return merge_changes(customers(spark, sf_dir), staging(spark, sf_dir), KEY, FIELDS, ntz(MERGED))


@query(
    "semi_join_changed",
    "JOIN-03 FLT-06",
    f"""WITH {_HISTORY} SELECT customer_id, start_time FROM hist WHERE is_current AND customer_id IN (
        SELECT DISTINCT customer_id FROM changes WHERE action = 'DELETE' AND is_update)""",
)
def _(spark, sf_dir):
    updated = changes(spark, sf_dir).where("action = 'DELETE' and is_update").select(*KEY).distinct()
    return current_rows(history(spark, sf_dir)).join(updated, KEY, "left_semi").select("customer_id", "start_time")


@query(
    "join_history_deletes",
    "JOIN-02 FLT-06",
    f"""WITH {_HISTORY} SELECT h.customer_id, h.start_time, c.update_timestamp AS last_stamp FROM hist h JOIN changes c USING (customer_id)
        WHERE c.action = 'DELETE' AND NOT c.is_update AND h.is_current""",
)
def _(spark, sf_dir):
    gone = changes(spark, sf_dir).where("action = 'DELETE' and not is_update").select("customer_id", F.col("update_timestamp").alias("last_stamp"))
    return current_rows(history(spark, sf_dir)).select("customer_id", "start_time").join(gone, KEY)


# ---------------------------------------------------------------- type 2


@query("scd2_changes", "TBL-15 WIN-03 WIN-04 SET-01 PRJ-10", f"WITH {_CLASSIFIED} SELECT * REPLACE ({_END}) FROM classified")
def _(spark, sf_dir):
    return _shown(classified(spark, sf_dir))


@query("scd2_history", "TBL-16 JOIN-04", f"WITH {_AFTER} SELECT * REPLACE ({_END}) FROM hist_after")
def _(spark, sf_dir):
    return _shown(history_after(spark, sf_dir))


@query("history_current", "TBL-21 FLT-06", f"WITH {_AFTER} SELECT * REPLACE ({_END}) FROM hist_after WHERE is_current = TRUE")
def _(spark, sf_dir):
    return _shown(current_rows(history_after(spark, sf_dir)))


@query("history_closed", "TBL-21 FLT-06", f"WITH {_AFTER} SELECT * REPLACE ({_END}) FROM hist_after WHERE is_current = FALSE")
def _(spark, sf_dir):
    return _shown(closed_rows(history_after(spark, sf_dir)))


@query("history_of_segments", "TBL-21 FLT-04", f"WITH {_AFTER} SELECT * REPLACE ({_END}) FROM hist_after WHERE segment IN ('BUILDING', 'HOUSEHOLD')")
def _(spark, sf_dir):
    return _shown(versions_of(history_after(spark, sf_dir), "segment", ["BUILDING", "HOUSEHOLD"]))


@query(
    "lookup_as_of",
    "TBL-16 TBL-21",
    f"""WITH {_AFTER} SELECT e.event_id, e.user_id, e.ts, h.name, h.segment, h.balance, h.start_time
        FROM events e LEFT JOIN hist_after h ON h.customer_id = e.user_id AND h.start_time <= e.ts AND e.ts < h.end_time""",
)
def _(spark, sf_dir):
    facts = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    versions = history_after(spark, sf_dir)
    return lookup_as_of(facts, versions, {"user_id": "customer_id"}, "ts", ["name", "segment", "balance", "start_time"])


@query(
    "unstamped_updates",
    "TBL-15 DQ-05",
    f"WITH {_CUST} SELECT customer_id, name || '!' AS name, nation_id, balance, segment, update_timestamp, 'INSERT' AS action, TRUE AS is_update FROM cust WHERE segment = 'BUILDING'",
)
def _(spark, sf_dir):
    before = customers(spark, sf_dir)
    after = update_where(before, F.col("segment") == "BUILDING", {"name": F.concat("name", F.lit("!"))})
    return unstamped_updates(diff_snapshots(before, after, KEY), history(spark, sf_dir), KEY)


# ---------------------------------------------------------------- row changes and versions

_UPDATED = f"""{_CUST}, upd AS (SELECT customer_id, name, nation_id,
  CASE WHEN balance < 0 THEN 0 ELSE balance END AS balance, segment,
  CASE WHEN balance < 0 THEN TIMESTAMP '{MERGED}' ELSE update_timestamp END AS update_timestamp FROM cust)"""


def _updated(df: DataFrame) -> DataFrame:
    return update_where(df, F.col("balance") < 0, {"balance": F.lit(0.0), "update_timestamp": ntz(MERGED)})


@query("update_where", "TBL-07", f"WITH {_UPDATED} SELECT * FROM upd")
def _(spark, sf_dir):
    return _updated(customers(spark, sf_dir))


@query("delete_where", "TBL-08", f"WITH {_CUST} SELECT * FROM cust WHERE NOT (segment = 'FURNITURE' AND balance > 5000)")
def _(spark, sf_dir):
    return delete_where(customers(spark, sf_dir), (F.col("segment") == "FURNITURE") & (F.col("balance") > 5000))


def _versions(spark, sf_dir) -> VersionedTable:
    """Version 0 as loaded, 1 updated, 2 with a segment deleted."""
    dim = VersionedTable(spark, new_folder(spark, "versions"))
    dim.commit(customers(spark, sf_dir))
    dim.commit(_updated(dim.read()), "update")
    dim.commit(delete_where(dim.read(), F.col("segment") == "FURNITURE"), "delete")
    return dim


@query("read_version", "TBL-10 TBL-07", f"WITH {_UPDATED} SELECT * FROM upd ORDER BY balance DESC")
def _(spark, sf_dir):
    return _versions(spark, sf_dir).read(1).orderBy(F.desc("balance"), "customer_id")


@query("restore_version", "TBL-09 TBL-10", f"WITH {_CUST} SELECT * FROM cust")
def _(spark, sf_dir):
    dim = _versions(spark, sf_dir)
    dim.restore(0)
    return dim.read()


@query("undrop_table", "TBL-09 TBL-08", f"WITH {_UPDATED} SELECT * FROM upd WHERE segment <> 'FURNITURE'")
def _(spark, sf_dir):
    dim = _versions(spark, sf_dir)
    dim.drop()
    dim.undrop()
    return dim.read()


@query(
    "insert_rows",
    "TBL-05 TBL-06 TBL-01",
    f"""WITH {_CUST} SELECT customer_id, name, CAST(CAST(balance AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM cust
        UNION ALL SELECT 900001, 'Sample Row', NULL""",
)
def _(spark, sf_dir):
    folder = new_folder(spark, "inserted")
    rows = customers(spark, sf_dir).select("customer_id", "name", amount("balance").value().alias("balance"))
    rows.write.mode("append").parquet(folder)
    spark.createDataFrame([(900001, "Sample Row", None)], rows.schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
