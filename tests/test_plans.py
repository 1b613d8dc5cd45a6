"""Physical plans: what is pushed down, pruned, broadcast and shuffled."""

import re
from bisect import bisect_right
from math import inf, isnan, nan

import pyarrow.dataset as ds
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from millrace.plans.catalog import QUERIES
from millrace.plans.retail import retail
from millrace.sinks.files import interleaved, save_distributed, write_interleaved
from millrace.sources.html import table_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sized_joins(spark):
    """No table is small enough to broadcast by itself, as at scale."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# queries that neither write files nor run jobs while they are put together
LAZY = [
    "order_customer_date_price", "retail_derive", "cost_by_state_category", "cost_grouping_sets", "sales_per_product",
    "top10_products_by_region", "top5_products_by_region", "feb_march_by_year", "top_growth_subcategory", "review_report",
    "value_counts_top10", "category_share", "daily_summary", "weather_report", "daily_summary_from_json", "json_flatten",
    "currency_convert", "lookup_join", "insert_only_merge", "run_summary", "union_distinct", "single_occurrence_keys",
]
BY_NAME = {"cost_by_state_category", "cost_grouping_sets", "top10_products_by_region", "top5_products_by_region"}


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_hidden_broadcasts(spark, sized_joins, name):
    text = plan(QUERIES[name].plan(spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text and "Python" not in text
    assert ("BroadcastExchange" in text) == (name in BY_NAME)


def test_only_wanted_columns_are_read(spark):
    text = plan(QUERIES["sales_per_product"].plan(spark, SF_DIR))
    assert "Join" not in text
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {"l_partkey:bigint,l_extendedprice:double,l_discount:double"}
    text = plan(retail(spark, SF_DIR, "order_date", "list_price"))
    assert text.count("FileScan") == 2 and "customer" not in text


def test_filters_reach_the_scan(spark):
    assert re.search(r"PushedFilters: \[[^\]]*In\(p_brand", plan(QUERIES["listing_filter"].plan(spark, SF_DIR)))
    staged = plan(QUERIES["reviews_one_category"].plan(spark, SF_DIR))
    assert "PartitionFilters: [isnotnull(product_category" in staged and "GreaterThanOrEqual(star_rating,5)" in staged


def test_top_n_plans(spark):
    for name in ("top10_products_by_region", "top5_products_by_region"):
        assert "WindowGroupLimit" in plan(QUERIES[name].plan(spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan(QUERIES["top_growth_subcategory"].plan(spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan(QUERIES["sample_rows"].plan(spark, SF_DIR))


def test_grouping_sets_expand_groups_not_rows(spark):
    text = plan(QUERIES["cost_grouping_sets"].plan(spark, SF_DIR))
    below = text[text.index("Expand") :]
    assert below.count("HashAggregate") >= 2


def test_buckets_join_without_a_shuffle(spark, sized_joins):
    for name in ("left_side", "right_side"):
        save_distributed(spark.range(100).select("id", (F.col("id") % 7).alias("v")), name, "id", "v", 4)
    joined = spark.table("left_side").join(spark.table("right_side"), "id")
    assert "Exchange" not in plan(joined) and joined.count() == 100


def test_many_files_of_pages_are_not_shuffled(spark, folder):
    cores = spark.sparkContext.defaultParallelism
    spark.range(cores * 2).select("id", F.lit("<table><tr><td>1</td></tr></table>").alias("html")).repartition(cores).write.parquet(folder("p"))
    many = spark.read.parquet(folder("p"))
    assert "Exchange" not in plan(table_rows(many, "html"))


def test_pages_are_parsed_in_arrow_batches(spark):
    text = plan(table_rows(spark.read.parquet(f"{SF_DIR}/pages.parquet"), "html"))
    assert "MapInArrow" in text and "UDTF" not in text


def test_bucketed_table_has_one_file_per_bucket(spark):
    save_distributed(spark.range(4000).repartition(20).withColumn("k", F.col("id") % 100), "few_files", "k", "id", 8)
    assert len(spark.table("few_files").inputFiles()) <= 8


def test_files_can_be_skipped_by_either_column(spark, folder):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    reviews = lines.select(F.col("l_partkey").alias("product_id"), F.year("l_shipdate").alias("year"), F.col("l_shipdate").alias("day"), "l_orderkey", "l_linenumber")
    write_interleaved(reviews, folder("z"), ["product_id", "year"], files=16)
    bounds = []
    for file in ds.dataset(folder("z")).files:
        group = pq.read_metadata(file).row_group(0)
        by_name = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        bounds.append(by_name)
    most, first, last = reviews.agg(F.max("product_id"), F.min("year"), F.max("year")).first()
    assert len(bounds) == 16 and spark.read.parquet(folder("z")).exceptAll(reviews).isEmpty()
    for column, value in (("year", first), ("year", last), ("year", 1995), ("product_id", most // 2), ("product_id", most // 5)):
        opened = sum(b[column].min <= value <= b[column].max for b in bounds)
        assert 1 <= opened < 8, (column, value, opened)


def test_interleaving_takes_dates_nulls_and_one_hot_value(spark, folder):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 7).alias("k"), F.expr("if(id % 5 = 0, double('NaN'), double(id))").alias("x"),
        F.expr("date_add(date'2024-01-01', cast(id % 50 as int))").alias("d"), "id", F.expr("map(1, id)").alias("m"),
    )
    write_interleaved(rows, folder("z"), ["k", "d", "x"], files=8)
    back = spark.read.parquet(folder("z"))
    assert back.count() == 4000 and back.select(F.countDistinct("id")).first()[0] == 4000
    assert max(r["count"] for r in back.groupBy(F.input_file_name()).count().collect()) < 1200
    write_interleaved(rows.where("false"), folder("none"), ["k", "d"])
    assert spark.read.schema(rows.schema).parquet(folder("none")).isEmpty()


def test_interleaving_sorts_by_a_column_made_once_per_row(spark, folder, monkeypatch):
    frame, made = type(spark.range(0)), []
    sort = frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda self, *by: made.append(sort(self, *by)) or made[-1])
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("k"), (F.col("id") % 50).alias("_place"))
    write_interleaved(rows, folder("z"), ["id", "k"], files=4)
    text = plan(made[0])
    keys = re.search(r"Sort \[(.*?)\], false", text)[1]
    assert all(re.fullmatch(r"\w+#\d+L? ASC NULLS FIRST", key) for key in keys.split(", ")), keys
    assert "lambda" not in text
    back = spark.read.parquet(folder("z"))
    assert back.columns == rows.columns and back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_interleaved_key_is_made_of_the_bits_of_the_ranks(spark):
    values = [None, nan, -inf, inf, -1.5, 0.0, *[2.5] * 40, *map(float, range(3, 120))]
    rows = spark.createDataFrame([(x, None if i % 9 == 0 else i * i % 31, None) for i, x in enumerate(values)], "x double, n int, e date")
    shares = [i / 64 for i in range(1, 64)]
    cuts = rows.agg(*[F.percentile_approx(F.expr(c), shares, 10_000) for c in ("nanvl(x, null)", "double(n)")]).first()

    def rank(sorted_cuts, value):
        return 0 if value is None or isnan(value) else bisect_right(sorted_cuts, value)

    for r in interleaved(rows, ["x", "n", "e"], "key").collect():
        x, n = rank(cuts[0], r.x), rank(cuts[1], r.n)
        assert r.key == int("".join(a + b + "0" for a, b in zip(f"{x:06b}", f"{n:06b}")), 2), r
