"""Retail reports over a star of order lines, and the customer spend rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.numbers import Amount, amount, in_units
from millrace.functions.text import equals_ignoring_case
from millrace.operators.aggregate import conditional_sums, growth, sum_by, sum_grouping_sets
from millrace.operators.ordered import top_n_per_group
from millrace.plans.registry import query
from millrace.plans.tables import table

# ---------------------------------------------------------------- star

# where each retail column comes from, and how it is made
_COLUMNS: dict[str, tuple[str, Column | str]] = {
    "order_id": ("lineitem", "l_orderkey"),
    "line_no": ("lineitem", "l_linenumber"),
    "product_id": ("lineitem", "l_partkey"),
    "quantity": ("lineitem", "l_quantity"),
    "list_price": ("lineitem", "l_extendedprice"),
    "discount_percent": ("lineitem", "cast(rint(l_discount * 100) as int)"),
    "order_date": ("orders", "o_orderdate"),
    "state": ("nation", "n_name"),
    "region": ("region", "r_name"),
    "category": ("part", "p_type"),
    "sub_category": ("part", "p_brand"),
    "unit_cost": ("part", "p_retailprice"),
}
_ORDER_SIDE = {"orders": 0, "nation": 1, "region": 2}


def retail(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The wanted retail columns, joining only the tables these columns come from (all keys resolve).

    The order side is joined up first, narrow, so the order lines are shuffled once on the order key and
    once on the part key at most. Only nation and region are broadcast by name: they hold 25 and 5 rows at
    every scale. Everything else is left to Spark's size checks, and AQE splits a hot part or order.
    """
    needed = {_COLUMNS[c][0] for c in columns}
    df = table(spark, sf_dir, "lineitem")
    depth = max((_ORDER_SIDE[t] for t in needed if t in _ORDER_SIDE), default=-1)
    if depth >= 0:
        side = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if depth >= 1:
            places = table(spark, sf_dir, "nation")
            if depth >= 2:
                places = places.join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
            homes = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            homes = homes.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
            side = side.join(homes, F.col("o_custkey") == F.col("c_custkey"))
        df = df.join(side, F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in needed:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return df.select(*[F.expr(_COLUMNS[c][1]).alias(c) for c in columns])


def part_costs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cost (``_units``, in 1e-4) by the wanted columns and product. Quantities are summed before the part table is joined,
    so that sums and not order lines are shuffled by part."""
    own = [c for c in columns if _COLUMNS[c][0] != "part"]
    sold = retail(spark, sf_dir, *own, "product_id", "quantity").groupBy(*own, "product_id").agg(amount("quantity").total().alias("_sold"))
    of_part = [F.col(_COLUMNS[c][1]).alias(c) for c in columns if c not in own]
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), *of_part, amount("p_retailprice").units.alias("_unit"))
    cost = F.col("_sold").cast("decimal(18,0)") * F.col("_unit").cast("decimal(18,0)")
    return sold.join(part, "product_id").select(*columns, cost.cast("bigint").alias("_units"))


def part_cost() -> Amount:
    return Amount(F.col("_units"), 4)


def discount() -> Amount:
    return amount("list_price").times(Amount(F.col("discount_percent"), 2))


def sale_price() -> Amount:
    return amount("list_price").times(Amount(100 - F.col("discount_percent"), 2))


def cost_price() -> Amount:
    return amount("unit_cost").times(amount("quantity"))


_STAR = """
retail AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, n_name AS state, r_name AS region,
         p_type AS category, p_brand AS sub_category, o_orderdate AS order_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS list_price,
         CAST(round(l_discount * 100) AS INTEGER) AS discount_percent,
         CAST(p_retailprice AS DECIMAL(9,2)) * CAST(l_quantity AS DECIMAL(9,2)) AS cost_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
),
priced AS (
  SELECT *, list_price * CAST(discount_percent AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2)) AS discount,
         list_price * CAST(100 - discount_percent AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2)) AS sale_price
  FROM retail
)
"""


# ---------------------------------------------------------------- order and customer rollup


def order_customer_totals(orders: DataFrame, customers: DataFrame, batch_id: str | None = None, status: str = "F") -> DataFrame:
    """Total price per customer name and order date, of orders in one status (and one load batch).

    Both sides carry ``batch_id`` and join on it too, so a batch never meets the customers of another.
    Prices are summed per customer key first: a customer with very many orders shrinks before the join.
    """
    if batch_id is not None:
        orders, customers = (df.where(F.col("batch_id") == batch_id) for df in (orders, customers))
    wanted = orders.where(F.col("o_orderstatus") == status)
    per_key = wanted.groupBy("batch_id", "o_custkey", "o_orderdate").agg(amount("o_totalprice").total().alias("_part"))
    named = customers.select("batch_id", F.col("c_custkey").alias("o_custkey"), "c_name")
    return (
        per_key.join(named, ["batch_id", "o_custkey"])
        .groupBy("c_name", "o_orderdate", "batch_id")
        .agg(in_units(F.sum("_part"), 2).alias("total_price"))
    )


def batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders with their year as batch id, and the customers each batch delivers (those who ordered in it)."""
    orders = table(spark, sf_dir, "orders").withColumn("batch_id", F.date_format("o_orderdate", "yyyy"))
    seen = orders.select("batch_id", F.col("o_custkey").alias("c_custkey")).distinct()
    return orders, table(spark, sf_dir, "customer").join(seen, "c_custkey")


@query(
    "order_customer_date_price",
    "JOIN-01 FLT-02 TBL-05",
    """SELECT c_name, o_orderdate, strftime(o_orderdate, '%Y') AS batch_id,
              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
       GROUP BY c_name, o_orderdate, strftime(o_orderdate, '%Y')""",
)
def _(spark, sf_dir):
    return order_customer_totals(*batches(spark, sf_dir))


@query(
    "order_customer_one_batch",
    "FLT-07 JOIN-01",
    """SELECT c_name, o_orderdate, '1997' AS batch_id, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997
       GROUP BY c_name, o_orderdate""",
)
def _(spark, sf_dir):
    return order_customer_totals(*batches(spark, sf_dir), batch_id="1997")


# ---------------------------------------------------------------- derived columns, filters


@query(
    "retail_derive",
    "PRJ-05 F-MATH-01",
    f"""WITH {_STAR} SELECT order_id, line_no, product_id, CAST(list_price AS DOUBLE) AS list_price, discount_percent,
        CAST(discount AS DOUBLE) AS discount, CAST(sale_price AS DOUBLE) AS sale_price,
        CAST(sale_price - cost_price AS DOUBLE) AS profit
        FROM priced""",
)
def _(spark, sf_dir):
    df = retail(spark, sf_dir, "order_id", "line_no", "product_id", "list_price", "discount_percent", "unit_cost", "quantity")
    derived = {"discount": discount(), "sale_price": sale_price(), "profit": sale_price().minus(cost_price())}
    return df.select("order_id", "line_no", "product_id", "discount_percent", "list_price", *[a.value().alias(n) for n, a in derived.items()])


@query(
    "filter_case_insensitive",
    "FLT-01 PRJ-01",
    f"WITH {_STAR} SELECT order_id, line_no, product_id FROM retail WHERE lower(state) = 'nation_1'",
)
def _(spark, sf_dir):
    df = retail(spark, sf_dir, "order_id", "line_no", "product_id", "state")
    return df.where(equals_ignoring_case(F.col("state"), "nation_1")).drop("state")


# ---------------------------------------------------------------- sums


@query(
    "cost_by_state_category",
    "AGG-01 SRT-01",
    f"""WITH {_STAR} SELECT state, category, CAST(SUM(cost_price) AS DOUBLE) AS total_cost FROM retail
        GROUP BY state, category ORDER BY state""",
)
def _(spark, sf_dir):
    df = part_costs(spark, sf_dir, "state", "category")
    return sum_by(df, ["state", "category"], part_cost(), "total_cost").orderBy("state", "category")


@query(
    "cost_by_state_region",
    "AGG-01 SRT-01",
    f"""WITH {_STAR} SELECT state, region, CAST(SUM(cost_price) AS DOUBLE) AS total_cost FROM retail
        GROUP BY state, region ORDER BY state""",
)
def _(spark, sf_dir):
    df = part_costs(spark, sf_dir, "state", "region")
    return sum_by(df, ["state", "region"], part_cost(), "total_cost").orderBy("state", "region")


@query(
    "cost_grouping_sets",
    "AGG-02",
    f"""WITH {_STAR} SELECT state, category, CAST(SUM(cost_price) AS DOUBLE) AS total_cost,
        CAST(2 * grouping(state) + grouping(category) AS INTEGER) AS level
        FROM retail GROUP BY GROUPING SETS ((state, category), (state), (category), ()) ORDER BY state""",
)
def _(spark, sf_dir):
    df = part_costs(spark, sf_dir, "state", "category")
    sets = [["state", "category"], ["state"], ["category"], []]
    return sum_grouping_sets(df, ["state", "category"], sets, part_cost(), "total_cost").orderBy("state", "category", "level")


@query(
    "sales_per_product",
    "AGG-03 SRT-02",
    f"""WITH {_STAR} SELECT product_id, CAST(SUM(sale_price) AS DOUBLE) AS total_sales FROM priced
        GROUP BY product_id ORDER BY total_sales DESC""",
)
def _(spark, sf_dir):
    df = retail(spark, sf_dir, "product_id", "list_price", "discount_percent")
    return sum_by(df, ["product_id"], sale_price(), "total_sales").orderBy(F.desc("total_sales"), "product_id")


def _region_products(spark, sf_dir, what: Amount, *columns: str) -> DataFrame:
    df = retail(spark, sf_dir, "region", "product_id", *columns)
    return df.groupBy("region", "product_id").agg(what.total().alias("total"))


@query(
    "top10_products_by_region",
    "WIN-01",
    f"""WITH {_STAR} SELECT region, product_id, CAST(SUM(cost_price) AS DOUBLE) AS cost,
          CAST(row_number() OVER (PARTITION BY region ORDER BY SUM(cost_price) DESC, product_id) AS INTEGER) AS rn
        FROM retail GROUP BY region, product_id QUALIFY rn <= 10""",
)
def _(spark, sf_dir):
    # quantities are summed per region and product before the unit cost is joined: far fewer rows meet the part table
    sold = _region_products(spark, sf_dir, amount("quantity"), "quantity")
    unit = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), amount("p_retailprice").units.alias("unit_cost"))
    costs = sold.join(unit, "product_id").select("region", "product_id", (F.col("total").cast("decimal(18,0)") * F.col("unit_cost").cast("decimal(18,0)")).alias("cost"))
    top = top_n_per_group(costs, "region", [F.desc("cost"), F.asc("product_id")], 10)
    return top.withColumn("cost", in_units(F.col("cost").cast("decimal(34,0)"), 4))


@query(
    "top5_products_by_region",
    "WIN-02 SRT-03",
    f"""WITH {_STAR} SELECT region, product_id, CAST(SUM(sale_price) AS DOUBLE) AS total_sales FROM priced
        GROUP BY region, product_id
        QUALIFY row_number() OVER (PARTITION BY region ORDER BY SUM(sale_price) DESC, product_id) <= 5
        ORDER BY region, total_sales DESC""",
)
def _(spark, sf_dir):
    sales = _region_products(spark, sf_dir, sale_price(), "list_price", "discount_percent")
    top = top_n_per_group(sales, "region", [F.desc("total"), F.asc("product_id")], 5)
    return top.select("region", "product_id", in_units(F.col("total"), 4).alias("total_sales")).orderBy("region", F.desc("total_sales"), "product_id")


@query(
    "sales_by_month",
    "AGG-04 F-DT-03",
    f"""WITH {_STAR} SELECT CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
        CAST(SUM(sale_price) AS DOUBLE) AS sales FROM priced GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    df = retail(spark, sf_dir, "order_date", "list_price", "discount_percent")
    return df.groupBy(F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month")).agg(
        sale_price().sum().alias("sales")
    )


@query(
    "feb_march_by_year",
    "AGG-05 AGG-04 F-CND-01 SRT-01",
    f"""WITH {_STAR} SELECT CAST(year(order_date) AS INTEGER) AS order_year,
        CAST(SUM(CASE WHEN month(order_date) = 2 THEN sale_price ELSE 0 END) AS DOUBLE) AS feb_sales,
        CAST(SUM(CASE WHEN month(order_date) = 3 THEN sale_price ELSE 0 END) AS DOUBLE) AS march_sales
        FROM priced GROUP BY 1 ORDER BY 1""",
)
def _(spark, sf_dir):
    df = retail(spark, sf_dir, "order_date", "list_price", "discount_percent").withColumns(
        {"order_year": F.year("order_date"), "_month": F.month("order_date")}
    )
    months = {"feb_sales": F.col("_month") == 2, "march_sales": F.col("_month") == 3}
    return conditional_sums(df, ["order_year"], sale_price(), months).orderBy("order_year")


_GROWTH = f"""WITH {_STAR} SELECT sub_category,
        CAST(s97 AS DOUBLE) AS sales_1997, CAST(s98 AS DOUBLE) AS sales_1998, CAST(s98 - s97 AS DOUBLE) AS growth FROM (
          SELECT sub_category, SUM(CASE WHEN year(order_date) = 1997 THEN sale_price ELSE 0 END) AS s97,
                 SUM(CASE WHEN year(order_date) = 1998 THEN sale_price ELSE 0 END) AS s98 FROM priced GROUP BY sub_category)"""


def _growth(spark, sf_dir):
    # as for costs: sums per product and year meet the part table
    lines = retail(spark, sf_dir, "product_id", "order_date", "list_price", "discount_percent")
    sold = lines.groupBy("product_id", F.year("order_date").alias("_year")).agg(sale_price().total().cast("bigint").alias("_units"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("sub_category"))
    return growth(sold.join(part, "product_id"), "sub_category", part_cost(), F.col("_year"), 1997, 1998)


@query("growth_by_subcategory", "AGG-06 F-CND-01", _GROWTH)
def _(spark, sf_dir):
    return _growth(spark, sf_dir)


@query("top_growth_subcategory", "AGG-06 SRT-04", _GROWTH + " ORDER BY growth DESC, sub_category LIMIT 1")
def _(spark, sf_dir):
    return _growth(spark, sf_dir).orderBy(F.desc("growth"), "sub_category").limit(1)
