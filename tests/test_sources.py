"""Readers, writers and pages."""

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from millrace.functions.semi import at, flatten_object, flatten_variant, hourly_rows, items, parse
from millrace.functions.text import last_path_part, snake_names, strip_names
from millrace.plans.pages import CAR_CARD, CAR_FIELDS
from millrace.sinks.files import narrow, publish, write_clustered, write_csv, write_hourly_json, write_parquet, write_partitioned
from millrace.sources.files import (
    FILE,
    PIPE,
    DelimitedFormat,
    keep_good_rows,
    list_staged,
    load_report,
    read_csv,
    read_json_documents,
    read_json_lines,
    read_partitioned,
    read_staged,
    skip_bad_files,
    with_batch,
)
from millrace.sources.html import cards, grid_rows, table_rows
from millrace.sources.tables import create_table, save_table, truncate_table

PEOPLE = "id int, name string, born date, score double"


@pytest.fixture
def stage(tmp_path):
    """Three pipe files: a good one, one with bad rows, one quoted."""
    place = tmp_path / "stage"
    place.mkdir()
    (place / "good.csv").write_text("id|name|born|score\n1|Ann|2000-01-31|1.5\n2|Bob||\n")
    (place / "bad.csv").write_text("id|name|born|score\n3|Cid|2000-02-30|1\nx|Dan|2000-01-01|2\n5|Eve|2000-01-01|3|extra\n6|Flo|2000-01-01|4\n7|Gus\n")
    (place / "quoted.csv").write_text('id|name|born|score\n8|"Hal|Ivy ""J"""|2000-01-01|5\n')
    return str(place)


def test_continue_keeps_good_rows(spark, stage):
    good, bad = keep_good_rows(read_staged(spark, stage, PEOPLE, PIPE))
    assert {r.id for r in good.collect()} == {1, 2, 6, 8}
    assert {r.name for r in good.where("id = 8").collect()} == {'Hal|Ivy "J"'}
    assert sorted((r._raw.split("|")[1], r._reason) for r in bad.collect()) == [
        ("Cid", "bad value in born"), ("Dan", "bad value in id"), ("Eve", "wrong number of fields"), ("Gus", "wrong number of fields"),
    ]


def test_skip_file_drops_the_whole_file(spark, stage):
    kept = skip_bad_files(read_staged(spark, stage, PEOPLE, PIPE))
    assert {r.id for r in kept.collect()} == {1, 2, 8}
    report = {r.unit.rsplit("/", 1)[1]: (r.rows_parsed, r.errors_seen) for r in load_report(read_staged(spark, stage, PEOPLE, PIPE)).collect()}
    assert report == {"good.csv": (2, 0), "bad.csv": (5, 4), "quoted.csv": (1, 0)}


def test_count_of_bad_rows_does_not_depend_on_read_columns(spark, stage):
    staged = read_staged(spark, stage, PEOPLE, PIPE)
    assert staged.where("_reason is not null").count() == staged.select("id", "_reason").where("_reason is not null").count() == 4


def test_pattern_batch_and_listing(spark, stage):
    staged = read_staged(spark, stage, PEOPLE, PIPE, name_pattern=r"/(good|quoted)[.]csv$")
    batch = with_batch(keep_good_rows(staged)[0], "2024/01/05")
    assert batch.columns[0] == "batch_id" and rows(batch.select("batch_id").distinct()) == [("20240105",)] and batch.count() == 3
    files = list_staged(spark, stage, "d.csv").select(last_path_part(F.col("path"), ".csv").alias("n"))
    assert rows(files) == [("bad",), ("good",), ("quoted",)]


def test_csv_with_index_and_sentinels(spark, folder):
    df = spark.createDataFrame([(3, "Not Available", 1.0), (1, 'say "x", y', None), (2, "unknown", 2.0)], "id int, t string, v double")
    write_csv(df, folder("c"), index_by=["id"])
    back = read_csv(spark, folder("c"), "index bigint, id int, t string, v double", sentinels=("Not Available", "unknown"))
    assert [tuple(r) for r in back.orderBy("index").collect()] == [(0, 1, 'say "x", y', None), (1, 2, None, 2.0), (2, 3, None, 1.0)]


def test_json_documents_and_lines(spark, tmp_path):
    place = tmp_path / "profiles"
    place.mkdir()
    (place / "AAPL.json").write_text('[{"symbol": "AAPL", "price": 1.5},\n {"price": 2}]')
    (place / "MSFT.json").write_text('{"price": 3,\n "symbol": null}')
    docs = read_json_documents(spark, str(place), "symbol string, price double")
    named = docs.select(F.coalesce("symbol", last_path_part(F.col(FILE), ".json")).alias("symbol"), "price")
    assert rows(named) == [(1.5, "AAPL"), (2.0, "AAPL"), (3.0, "MSFT")]
    (tmp_path / "lines.json").write_text('{"a": 1}\n{"a": "x"}\nnot json\n')
    lines = read_json_lines(spark, str(tmp_path / "lines.json"), "a int")
    assert sorted((r.a, r._corrupt_record) for r in lines.where("a is null or a is not null").collect() if r.a) == [(1, None)]
    assert lines.where("a is null").count() == 2


def test_semi_structured(spark):
    docs = spark.createDataFrame([('{"base": "USD", "rates": {"EUR": 0.9, "BTC": 1e-5}}',), ('{"base": "X"}',), ("[]",)], "d string")
    flat = flatten_object(docs, "d", "$.rates", "double").select("key", "value")
    assert rows(flat) == [("BTC", 1e-05), ("EUR", 0.9)]
    variants = docs.select(parse(F.col("d")).alias("v"))
    assert rows(flatten_variant(variants, "v", "$.rates", "double").select("key", "value")) == rows(flat)
    assert spark.range(1).select(parse(F.lit("{bad"), tolerant=True).alias("v")).where("v is null").count() == 1
    assert [r[0] for r in variants.select(at(F.col("v"), "$.base", "string")).collect()] == ["USD", "X", None]
    lists = spark.createDataFrame([('[{"a": 1}, {"a": 2}]',), ('{"a": 3}',), (None,)], "d string")
    assert rows(items(lists, "d", "a: int").select("a")) == [(1,), (2,), (3,)]
    hourly = '{"Oslo": {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.0, null], "precipitation": [0.0, 1.0], "windspeed_10m": [2.0, 3.0], "relativehumidity_2m": [50.0]}}}'
    got = hourly_rows(spark.createDataFrame([(hourly,)], "d string"), "d").orderBy("datetime").collect()
    assert [(r.city, r.temperature, r.humidity) for r in got] == [("Oslo", 1.0, 50.0), ("Oslo", None, None)]


def test_writers(spark, folder):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), (F.col("id") % 7).cast("int").alias("y"))
    write_partitioned(df, folder("p"), ["k"], rows_per_file=100)
    back = read_partitioned(spark, folder("p"), "v bigint, y int, k bigint")
    assert rows(back) == rows(df)
    assert "PartitionFilters: [isnotnull(k" in back.where("k = 1")._jdf.queryExecution().toString()
    sizes = back.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
    assert sizes <= 100
    write_clustered(df, folder("c"), "k", "y")
    assert rows(spark.read.parquet(folder("c"))) == rows(df)
    write_parquet(df, folder("w"), compact=True)
    write_parquet(df.where("k = 1"), folder("w"))
    assert spark.read.parquet(folder("w")).count() == df.where("k = 1").count()
    assert narrow(df, {"v": "int"}).dtypes[1] == ("v", "int")
    with pytest.raises(Exception, match="OVERFLOW"):
        narrow(spark.createDataFrame([(2**40,)], "v bigint"), {"v": "int"}).collect()
    publish(df, "k", "json", {"path": folder("topic")})
    assert spark.read.json(folder("topic")).count() == 1000


def test_hourly_json_replaces_only_its_hours(spark, folder):
    def hour(day, h, v):
        return spark.sql(f"SELECT timestamp_ntz'2024-01-{day:02d} {h:02d}:30:00.123456' AS at, {v} AS v")

    write_hourly_json(hour(1, 6, 1).union(hour(2, 7, 2)), folder("h"), F.col("at"))
    write_hourly_json(hour(2, 7, 3), folder("h"), F.col("at"))
    back = spark.read.schema("at timestamp_ntz, v int, year string, month string, day string, hour string").json(folder("h"))
    assert [(r.v, r.day, r.hour, r.at.microsecond) for r in back.orderBy("v").collect()] == [(1, "01", "06", 123456), (3, "02", "07", 123456)]


def test_catalog_table_with_defaults(spark):
    create_table(spark, "people", "id bigint, created_at timestamp DEFAULT current_timestamp()")
    spark.sql("INSERT INTO people (id) VALUES (1)")
    assert spark.table("people").where("created_at is not null").count() == 1
    truncate_table(spark, "people")
    assert spark.table("people").count() == 0
    save_table(spark.range(3), "numbers", replace=True)
    save_table(spark.range(2), "numbers", replace=False)
    assert spark.table("numbers").count() == 5


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Order Id", " City "])
    assert snake_names(df).columns == ["order_id", "_city_"] and strip_names(df).columns == ["Order Id", "City"]


def test_bad_values_and_documents_raise_or_come_back(spark, folder):
    spark.createDataFrame([("1,a",), ("x,b",)], "value string").coalesce(1).write.text(folder("csv"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        read_csv(spark, folder("csv"), "id bigint, name string", DelimitedFormat(header=False)).collect()
    docs = spark.createDataFrame([(1, '{"a": 1}'), (2, '[{"a": 2}, {"a": 3}]'), (3, "junk"), (4, None)], "id int, doc string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        items(docs, "doc", "a: int").collect()
    assert sorted((r.id, r.a) for r in items(docs.where("id <> 3"), "doc", "a: int").collect()) == [(1, 1), (2, 2), (2, 3)]
    assert rows(items(docs.where("id = 3"), "doc", "a: int", tolerant=True)) == [(None, "junk", 3)]


def test_clustered_files_hold_ranges(spark, folder):
    df = spark.range(5000).select((F.col("id") % 5).alias("k"), "id")
    write_clustered(df, folder("c"), "k", "id")
    assert spark.read.parquet(folder("c")).count() == 5000


# ---------------------------------------------------------------- pages

GRID = (
    "<p>open<table><thead><tr><th>#</th></tr></thead><tr><td>*<td> 1 <td>Bit<b>coin</b>\n<td>a<td>b<td>c<td>d<td>e<td>f<td>g &amp; h"
    "<tr><td>short</tr></table><table><tr><td>other</td></tr></table>"
)


def test_grid_with_unclosed_cells(spark):
    names = ["rank", "name", "p", "h1", "h24", "d7", "cap", "vol", "supply"]
    pages = spark.createDataFrame([(7, GRID), (8, "<p>no table"), (9, None)], "page int, html string")
    got = grid_rows(pages, "html", names).collect()
    assert [tuple(r) for r in got] == [(7, "1", "Bitcoin", "a", "b", "c", "d", "e", "f", "g & h")]


def test_table_after_label(spark):
    html = "<table><tr><td>no</td></tr></table><div><span>By <i>cap</i></span></div><p><table><tr><th>Bank</th></tr><tr><td>X<table><tr><td>inner</td></tr></table></td></tr></table>"
    pages = spark.createDataFrame([(1, html), (2, "<span>By cap</span>")], "page int, html string")
    got = table_rows(pages, "html", "By cap", data_cells_only=False).collect()
    assert [(r.page, r.row_no, r.cells[0]) for r in got][:2] == [(1, 0, "Bank"), (1, 1, "Xinner")]


def test_cards_drop_only_the_broken_one(spark):
    def card(price):
        return (
            "<div class='search-list well x ad-container'><a class='car-name y'><h3> Honda City </h3></a>"
            "<ul class='search-vehicle-info'><li>Lahore</li></ul><ul class='search-vehicle-info-2'><li>2010<li>5 km</ul>" + price + "</div>"
        )

    page = card("<div class='price-details'> PKR 1 crore</div>") + card("") + "<div class='well'>no</div>"
    good, bad = cards(spark.createDataFrame([(1, page)], "page int, html string"), "html", CAR_CARD, CAR_FIELDS)
    assert [tuple(r) for r in good.collect()] == [(1, 0, "Honda City", "Lahore", "2010 | 5 km", "PKR 1 crore")]
    assert [tuple(r) for r in bad.collect()] == [(1, 1, "no price")]


def test_real_pages_keep_every_menu_item(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html")
    good, bad = cards(pages, "html", "li", {"label": "a"})
    assert good.count() + bad.count() == pages.select(F.sum(F.size(F.expr("regexp_extract_all(html, '<li>', 0)")))).first()[0]
