"""Stored HTML pages to rows. Listing pages are built row by row from the part table; real pages come from ``pages``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.plans.tables import table
from millrace.sources.html import cards, grid_rows, table_rows

# The columns of a coin listing, after its first (unnamed) cell.
GRID_COLUMNS = [
    "rank_no", "name", "price", "one_hour_change", "twenty_four_hour_change",
    "seven_day_change", "market_cap", "volume_24h", "circulating_supply",
]


def _spread(df: DataFrame) -> DataFrame:
    """Parsing is what costs time: rows in fewer splits than there are cores are dealt out, before pages are made of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _cell(value: Column | str) -> Column:
    return F.concat(F.lit("<td> "), F.col(value).cast("string") if isinstance(value, str) else value, F.lit("\n</td>"))


def _grid_pages(spark, sf_dir) -> DataFrame:
    """One page per part: a menu table, then a listing with a header row, a full row and a row with nine cells."""
    part = _spread(table(spark, sf_dir, "part"))
    full = [F.lit("*"), F.col("p_partkey").cast("string"), F.concat(F.col("p_name"), F.lit(" &amp; co"))]
    full += [F.col("p_size").cast("string"), F.lit("1"), F.lit("2"), F.lit("3"), F.col("p_type"), F.col("p_brand"), F.lit("")]
    row = F.concat(F.lit("<tr>"), *[_cell(c) for c in full], F.lit("</tr>"))
    short = F.concat(F.lit("<tr>"), *[_cell(c) for c in full[:9]], F.lit("</tr>"))
    html = F.concat(F.lit("<html><body><table><tr><td>menu</td></tr></table><p>x<table class='wide coins'><tr><th>#</th></tr>"), row, short, F.lit("</table></body>"))
    return part.select(F.col("p_partkey").alias("page_no"), html.alias("html"))


@query(
    "html_grid",
    "SRC-19 UDF-05 F-STR-02",
    """SELECT p_partkey AS page_no, CAST(p_partkey AS VARCHAR) AS rank_no, p_name || ' & co' AS name, CAST(p_size AS VARCHAR) AS price,
       '1' AS one_hour_change, '2' AS twenty_four_hour_change, '3' AS seven_day_change, p_type AS market_cap, p_brand AS volume_24h,
       '' AS circulating_supply FROM part""",
)
def _(spark, sf_dir):
    return grid_rows(_grid_pages(spark, sf_dir), "html", GRID_COLUMNS, table="table.coins")


@query(
    "html_table_after_label",
    "SRC-18 UDF-05",
    """SELECT c_custkey AS page_id, c_name AS bank, c_acctbal AS market_cap FROM customer""",
)
def _(spark, sf_dir):
    other = F.lit("<table><tr><th>Rank</th></tr><tr><td>other</td></tr></table>")
    mine = F.concat(
        F.lit("<span id='s'>By market capitalization</span><div><table><tr><th>Bank name</th><th>Market cap</th></tr><tr><td>"),
        F.col("c_name"), F.lit("</td><td>"), F.col("c_acctbal").cast("string"), F.lit("</td></tr></table></div>"),
    )
    pages = _spread(table(spark, sf_dir, "customer")).select(F.col("c_custkey").alias("page_id"), F.concat(other, mine, other).alias("html"))
    rows = table_rows(pages, "html", "By market capitalization").where("row_no > 0")
    return rows.select("page_id", F.col("cells")[0].alias("bank"), F.col("cells")[1].cast("double").alias("market_cap"))


# Where a used-car card holds its fields.
CAR_CARD = "div.well.search-list.ad-container"
CAR_FIELDS = {
    "car_name": "a.car-name h3",
    "city": "ul.search-vehicle-info li",
    "details": "ul.search-vehicle-info-2 li[]",
    "price": "div.price-details",
}


def _car_pages(spark, sf_dir) -> DataFrame:
    """One page per part with two cards; cards of one type lack the price."""
    price = F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(
        F.concat(F.lit("<div class='price-details generic'>PKR "), F.col("p_retailprice").cast("string"), F.lit(" lacs</div>"))
    )

    def card(number: int) -> Column:
        return F.concat(
            F.lit("<div class='classified well search-list  ad-container'><a class='car-name ad-detail' href='#'><h3> "),
            F.col("p_name"), F.lit(f" {number}\n</h3></a><ul class='list-unstyled search-vehicle-info'><li>"), F.col("p_brand"),
            F.lit("<li>more</ul><ul class='search-vehicle-info-2'><li> "), F.col("p_size").cast("string"), F.lit(" </li><li>"), F.col("p_type"),
            F.lit("</ul>"), price, F.lit("</div>"),
        )

    html = F.concat(F.lit("<body><div class='well'>no card</div>"), card(1), card(2), F.lit("</body>"))
    return _spread(table(spark, sf_dir, "part")).select(F.col("p_partkey").alias("page_id"), html.alias("html"))


@query(
    "html_cards",
    "SRC-20 UDF-05 F-STR-08",
    """SELECT p_partkey AS page_id, i AS card_no, p_name || ' ' || (i + 1) AS car_name, p_brand AS city, p_size || ' | ' || p_type AS details,
       'PKR ' || p_retailprice || ' lacs' AS price FROM part, (SELECT unnest([0, 1]) AS i) WHERE p_type <> 'PROMO'""",
)
def _(spark, sf_dir):
    return cards(_car_pages(spark, sf_dir), "html", CAR_CARD, CAR_FIELDS)[0]


@query(
    "html_broken_cards",
    "SRC-20 DQ-05",
    "SELECT p_partkey AS page_id, i AS card_no, 'no price' AS error FROM part, (SELECT unnest([0, 1]) AS i) WHERE p_type = 'PROMO'",
)
def _(spark, sf_dir):
    return cards(_car_pages(spark, sf_dir), "html", CAR_CARD, CAR_FIELDS)[1]


@query(
    "page_menu_items",
    "SRC-20 UDF-05",
    """SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INTEGER) AS card_no,
       replace(regexp_extract(item, '>([^<>]*)</a></li>$', 1), '&amp;', '&') AS label
       FROM (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS pos FROM (
         SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav>.*?</nav>'), '<li><a[^>]*>[^<]*</a></li>') AS items FROM pages))""",
)
def _(spark, sf_dir):
    pages = _spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return cards(pages, "html", "nav li", {"label": "a"})[0]
