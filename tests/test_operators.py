"""Operators against brute force, hot keys included."""

import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.numbers import Amount, amount, rescale
from millrace.functions.text import first_word, fill_zero, money_amount, split_fields, strip, to_number, unit_number
from millrace.functions.times import from_epoch_seconds, parse_date, to_epoch_seconds
from millrace.operators.aggregate import conditional_sums, mean_by, occurring_once, shares, sum_grouping_sets, value_counts
from millrace.operators.ordered import first_per_key, placed, running_total, top_n_per_group, with_identity
from millrace.operators.profile import column_profile
from millrace.operators.quality import expect_count, same_schema, split_valid, watch_load
from millrace.operators.sampling import sample_fraction, sample_rows
from millrace.plans.weather import weather_label


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows under one key, some of them copies."""
    base = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500 + 2).cast("int").alias("k"), (F.col("id") * 7919 % 1009).cast("int").alias("v"))
    return base.unionByName(base.where("v < 100"))


def test_identity_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 31 % 1009).alias("key"))
    numbered = with_identity(df, ["key"], after=500).orderBy("key").collect()
    assert [r.id for r in numbered] == list(range(501, 1501))
    last = spark.range(7).agg(F.max("id")).scalar()
    assert min(r.id for r in with_identity(df, ["key"], after=last).collect()) == 7


def test_running_total_with_a_hot_group(hot):
    counted = hot.groupBy("k", "v").count()
    found = {(r.k, r.v): r.upto for r in running_total(placed(counted, ["k", "v"]), ["k"], ["v"], "count", "upto").collect()}
    pdf = counted.toPandas().sort_values(["k", "v"])
    pdf["upto"] = pdf.groupby("k")["count"].cumsum()
    assert found == {(r.k, r.v): r.upto for r in pdf.itertuples()}


def test_top_n_and_first_are_repeatable(hot):
    pdf = hot.toPandas()
    top = top_n_per_group(hot, "k", [F.desc("v")], 3).groupBy("k").agg(F.sum("v").alias("s"))
    expected = pdf.sort_values("v", ascending=False).groupby("k").head(3).groupby("k")["v"].sum()
    assert {r.k: r.s for r in top.collect()} == expected.to_dict()
    first = first_per_key(hot, ["k"], [F.desc("v")])
    assert {r.k: r.v for r in first.collect()} == pdf.groupby("k")["v"].max().to_dict()
    keys = hot.select("k")
    assert first_per_key(keys, ["k"], []).count() == keys.distinct().count()


def test_top_n_is_trimmed_before_the_shuffle(hot):
    plan = top_n_per_group(hot, "k", [F.desc("v")], 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_profile_matches_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": np.where(rng.random(999) < 0.4, 7.0, rng.normal(0, 50, 999).round(3)), "b": rng.integers(0, 4, 999).astype(float)})
    pdf.loc[rng.random(999) < 0.1, "a"] = np.nan
    df = spark.createDataFrame(pdf).select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in pdf], F.lit(None).cast("double").alias("none"))
    found = {r.column_name: r for r in column_profile(df, ["a", "b", "none"]).collect()}
    for name in ("a", "b"):
        d = pdf[name].describe()
        assert found[name].n_rows == 999 and found[name].n_values == d["count"]
        for ours, theirs in (("mean", "mean"), ("stddev", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert math.isclose(found[name][ours], d[theirs], abs_tol=1e-3)
    assert found["none"].n_rows == 999 and found["none"].n_values == 0 and found["none"].mean is None


def test_grouping_sets_tell_nulls_from_totals(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "x", 4)], "s string, c string, v int")
    found = {(r.s, r.c, r.level): r.t for r in sum_grouping_sets(df, ["s", "c"], [["s", "c"], ["s"], ["c"], []], Amount(F.col("v"), 0), "t").collect()}
    assert found[(None, "x", 0)] == 4 and found[(None, None, 1)] == 4 and found[(None, None, 2)] == 2 and found[(None, None, 3)] == 7


def test_counts_shares_means_skip_nulls(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", None), ("b", 2.0), (None, 9.0)], "k string, v double")
    assert rows(value_counts(df, "k")) == [("a", 2), ("b", 1)]
    assert {r.k: r.percent for r in shares(df, "k").collect()} == {"a": 66.7, "b": 33.3}
    assert {r.k: r.m for r in mean_by(df, "k", amount("v"), "m").collect()} == {"a": 1.5, "b": 2.0}
    assert rows(occurring_once(df, ["k"]).select("k")) == [("b",), (None,)]
    cases = conditional_sums(df, ["k"], amount("v"), {"big": F.col("v") > 100})
    assert {r.k: r.big for r in cases.collect()} == {"a": 0.0, "b": 0.0, None: 0.0}


def test_sums_do_not_depend_on_order(spark):
    df = spark.range(10000).select(F.round(F.col("id") / 7, 2).alias("x"))
    found = {df.repartition(n).agg(amount("x").sum().alias("s"), amount("x").mean().alias("m")).first() for n in (1, 3, 8)}
    assert len(found) == 1
    empty = df.where("false").agg(amount("x").sum().alias("s"), amount("x").mean().alias("m")).first()
    assert (empty.s, empty.m) == (None, None)


def test_sums_are_exact_for_any_sign_and_size(spark):
    values = [0.01, -0.01, 123456.78, -987654.32, 9999999.99, -0.0, 52428.80, 10485.75, 10485.76, -10485.77]
    df = spark.createDataFrame([(v,) for v in values * 3], "x double")
    exact = sum(Decimal(str(v)) for v in values) * 3
    assert df.agg(amount("x").sum()).first()[0] == float(exact)
    # far beyond what one long holds
    huge = spark.range(40).select(Amount(F.lit(2**62) + F.col("id"), 4).units.alias("u"))
    assert huge.agg(Amount(F.col("u"), 4).total()).first()[0] == Decimal(2**62 * 40 + 780)
    assert [r[0] for r in df.limit(3).select(amount("x").times(amount("x")).minus(Amount(F.lit(1), 4)).value()).collect()] == [0.0, 0.0, 15241576527.9683]


def test_rounded_means_decide_ties_exactly(spark):
    cases = {"a": [53.40, 53.41], "b": [-53.40, -53.41], "c": [0.01] * 199 + [0.0], "d": [None], "e": [48.57, 48.58, None]}
    df = spark.createDataFrame([(k, v) for k, vs in cases.items() for v in vs], "k string, x double")
    found = {r.k: (r.m, r.s) for r in df.groupBy("k").agg(amount("x", 4).rounded_mean(2).alias("m"), amount("x", 4).rounded_sum(1).alias("s")).collect()}
    assert found == {"a": (53.41, 106.8), "b": (-53.41, -106.8), "c": (0.01, 2.0), "d": (None, None), "e": (48.58, 97.2)}


PRICES = {
    "PKR 1.5 crore": 15_000_000.0, "PKR 12.5 lacs": 1_250_000.0, "1 LAC": 100_000.0, " pkr 1,250,000 ": 1_250_000.0,
    "1,2.5 Crore": 125_000_000.0, "Call for price": None, "": None, None: None, "12d": None, "crore": None,
}


def test_money_text(spark):
    df = spark.createDataFrame([(p,) for p in PRICES], "p string").select("p", money_amount(F.col("p")).alias("v"))
    assert {r.p: r.v for r in df.collect()} == PRICES


def test_numbers_and_text(spark):
    texts = ["1", " 2.5 ", "-3e2", ".5", "5.", "1d", "0x1", "NaN", "Infinity", "", None, "1,000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.n for r in df.select("t", to_number(F.col("t")).alias("n")).collect()}
    assert {k: v for k, v in found.items() if v is not None} == {"1": 1.0, " 2.5 ": 2.5, "-3e2": -300.0, ".5": 0.5, "5.": 5.0}
    one = spark.createDataFrame([(" \t A  b \r\n", " 1,234 km")], "a string, k string")
    r = one.select(strip(F.col("a")).alias("s"), first_word(F.col("a")).alias("w"), unit_number(F.col("k"), "km").alias("km"), first_word(F.lit(" ")).alias("none"))
    assert tuple(r.first()) == ("A  b", "A", 1234.0, None)
    parts = spark.createDataFrame([("2010 | 5 km |Petrol",), (None,)], "d string").select(*split_fields(F.col("d"), "|", ["y", "k", "f", "c"]))
    assert [tuple(r) for r in parts.collect()] == [("2010", "5 km", "Petrol", None), (None, None, None, None)]
    filled = fill_zero(spark.createDataFrame([(None, 1.0)], "a double, b double"), ["a"])
    assert tuple(filled.first()) == (0.0, 1.0)


def test_rounding_modes(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,)], "x double").select(rescale(F.col("x"), 1.0, 0).alias("up"), rescale(F.col("x"), 1.0, 0, half_even=True).alias("even"))
    assert [tuple(r) for r in df.collect()] == [(3.0, 2.0), (4.0, 4.0), (-3.0, -2.0)]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Karachi"])
def test_epoch_is_zone_free(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1704423845,)], "s bigint").select(F.col("s"), from_epoch_seconds(F.col("s")).alias("t"))
        r = df.select("t", to_epoch_seconds(F.col("t")).alias("back")).first()
        assert str(r.t) == "2024-01-05 03:04:05" and r.back == 1704423845
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("x",), (None,)], "t string").select(parse_date(F.col("t")).alias("d"))
    assert [str(r.d) for r in df.collect()] == ["2024-02-29", "None", "None", "None"]


def test_weather_labels(spark):
    days = [(6.0, 35.0), (5.0, 30.01), (0.0, 4.99), (0.0, 5.0), (None, None), (None, 31.0)]
    df = spark.createDataFrame(days, "rain double, t double").select(weather_label(F.col("rain"), F.col("t")).alias("l"))
    assert [r.l for r in df.collect()] == ["Rainy", "Hot", "Cold", "Mild", "Mild", "Hot"]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    picked = [rows(sample_fraction(df.repartition(n), ["k"], 0.1)) for n in (2, 7)]
    assert picked[0] == picked[1] and 1800 < len(picked[0]) < 2200
    assert [rows(sample_rows(df.repartition(n), ["k"], 5)) for n in (2, 7)][0] == rows(sample_rows(df, ["k"], 5))
    assert len({tuple(rows(sample_rows(df, ["k"], 5, seed=s))) for s in "ab"}) == 2


def test_split_and_checks(spark, folder):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, -1.0)], "id int, v double")
    good, bad = split_valid(df, {"positive": F.col("v") > 0, "small": F.col("v") < 10})
    assert rows(good) == [(1, 2.0)]
    assert {r.id: r.reason for r in bad.collect()} == {2: "positive", 3: "positive"}
    watched, seen = watch_load(df, "n")
    watched.write.parquet(folder("w"))
    assert seen.get["n_rows"] == 3
    expect_count(df, 3)
    with pytest.raises(ValueError):
        expect_count(df, 4)
    assert same_schema(df, good.schema) and not same_schema(df, bad.schema)



def test_fractions_up_to_the_whole(spark):
    from millrace.operators.sampling import sample_fraction

    df = spark.range(1000)
    assert [sample_fraction(df, ["id"], f).count() for f in (0.0, 1.0)] == [0, 1000]
    assert 900 < sample_fraction(df, ["id"], 0.95).count() < 1000
    with pytest.raises(ValueError):
        sample_fraction(df, ["id"], 1.1)


def test_means_are_of_what_is_in_the_column(spark):
    from pyspark.errors import SparkRuntimeException

    from millrace.operators.aggregate import price_stats

    df = spark.createDataFrame([("a", 0.004), ("a", 0.004), ("b", 0.125), ("b", 1.23456)], "symbol string, price double")
    found = {r.symbol: r.avg_price for r in price_stats(df, "symbol", "price", digits=5).collect()}
    assert found == {"a": 0.004, "b": 0.67978}
    with pytest.raises(SparkRuntimeException, match="more than 2 digits"):
        price_stats(df, "symbol", "price", digits=2).collect()
    assert {r.symbol: r.avg_price for r in price_stats(df, "symbol", "price").collect()} == {"a": 0.004, "b": 0.67978}


def test_sums_of_any_double_do_not_depend_on_the_order(spark):
    import math
    import random

    from millrace.functions.numbers import amount, floating

    rng = random.Random(2)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 15) for _ in range(5000)] + [0.1] * 100 + [None, -0.0]
    sums = set()
    for parts in (1, 7, 40):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        sums.add(tuple(df.agg(floating("x").sum(), floating("x").mean()).first()))
    exact = math.fsum(v for v in values if v is not None)
    assert len(sums) == 1 and abs(next(iter(sums))[0] - exact) <= 2 * math.ulp(exact)
    one = lambda *vs: spark.createDataFrame([(v,) for v in vs], "x double").agg(floating("x").sum()).first()[0]
    assert one(None, None) is None and one(-0.0) == 0.0 and one(1e300, 1e300) == 2e300 and one(1.0, math.inf) == math.inf and math.isnan(one(1.0, math.nan))
    # cents of coin market caps: a double near 1e13 is up to a tenth of a cent away from them
    caps = [round(rng.uniform(5e11, 5e13), 2) for _ in range(2000)]
    total = spark.createDataFrame([(v,) for v in caps], "x double").agg(amount("x", 2).total()).first()[0]
    assert total == sum(round(v * 100) for v in caps)


def test_hours_do_not_depend_on_the_session_zone(spark):
    from millrace.functions.times import hour_parts, ntz

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(ntz("2024-03-10 02:30:00").alias("t")).select(*[c.alias(n) for n, c in hour_parts(F.col("t")).items()]).first()
        assert tuple(row) == ("2024", "03", "10", "02")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
