"""Profiles merged from stored parts against exact figures."""

from conftest import SF_DIR
from pyspark.sql import functions as F

from millrace.operators.sketches import add_profile, merged_profile

COLUMNS = ["l_extendedprice", "l_quantity"]


def test_merged_profile_is_near_the_exact_one(spark, folder):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    for load, part in enumerate((F.col("l_linenumber") == 1, F.col("l_linenumber").isin(2, 3), F.col("l_linenumber") > 3)):
        add_profile(lines.where(part), COLUMNS, f"load{load}", folder("parts"))
    add_profile(lines.where("l_linenumber = 1"), COLUMNS, "load0", folder("parts"))  # a repeated load
    found = {r.column_name: r for r in merged_profile(spark, folder("parts")).collect()}
    assert spark.read.parquet(folder("parts")).count() == 6
    n = lines.count()
    for c in COLUMNS:
        least, most, distinct = lines.agg(F.min(c), F.max(c), F.countDistinct(c)).first()
        assert (found[c].n_rows, found[c].n_values, found[c].min, found[c].max) == (n, n, least, most)
        assert abs(found[c].n_distinct - distinct) <= 0.04 * distinct
        for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            below, upto = (lines.where(test).count() for test in (F.col(c) < found[c][name], F.col(c) <= found[c][name]))
            assert below <= (p + 0.01) * n and upto >= (p - 0.01) * n


def test_nulls_nan_and_empty_loads(spark, folder):
    schema = "x double, y int"
    add_profile(spark.createDataFrame([], schema), ["x", "y"], "none", folder("p"))
    assert [(r.n_rows, r.n_values, r.min, r.p50) for r in merged_profile(spark, folder("p")).collect()] == [(0, 0, None, None)] * 2
    add_profile(spark.createDataFrame([(1.5, None), (float("nan"), None), (None, None), (0.0, None), (-0.0, None)], schema), ["x", "y"], "one", folder("p"))
    x, y = sorted(merged_profile(spark, folder("p")).collect())
    assert (x.n_rows, x.n_values, x.n_distinct, x.min, x.p25, x.max) == (5, 3, 2, 0.0, 0.0, 1.5)
    assert (y.n_rows, y.n_values, y.n_distinct, y.p75) == (5, 0, 0, None)
