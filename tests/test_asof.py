"""As-of lookup against a plain loop: gaps, open ends, ties, nulls, one hot key."""

import random

import pytest
from conftest import SF_DIR, rows
from test_plans import plan

from millrace.operators.asof import lookup_as_of
from millrace.plans.catalog import QUERIES

RANDOM = random.Random(4)


def sides(n_facts, n_keys, hot=0):
    """Versions with gaps and open ends, and facts of which ``hot`` in three belong to one key."""
    versions = []
    for key in range(n_keys):
        at = 0
        for n in range(RANDOM.randint(0, 6) if key else 40):
            at += RANDOM.randint(1, 9)
            end = at + RANDOM.randint(1, 9)
            versions.append((key, at, end, f"{key}-{n}"))
            at = end
        if key % 3 == 0:
            versions.append((key, at + 3, None, f"{key}-open"))
    facts = [(0 if RANDOM.randint(1, 3) <= hot else RANDOM.randrange(n_keys + 2), RANDOM.randint(-2, 400 if n % 5 == 0 else 60), n) for n in range(n_facts)]
    return versions, [*facts, (None, 5, -1), (0, None, -2), (0, 5, -3), (0, 5, -3)]


def plain(versions, facts):
    out = []
    for key, at, n in facts:
        fits = [v for v in versions if key is not None and at is not None and v[0] == key and v[1] <= at and (v[2] is None or at < v[2])]
        out.append((key, n, at, fits[0][3] if fits else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [0, 1])
def test_lookup(spark, hot):
    versions, facts = sides(3000, 40, hot)
    known = spark.createDataFrame([*versions, (None, 1, None, "no key"), (1, None, None, "no start")], "customer long, start_time long, end_time long, name string")
    asked = spark.createDataFrame(facts, "key long, t long, n long")
    found = lookup_as_of(asked.repartition(5), known, {"key": "customer"}, "t", ["name"])
    expected = plain(versions, facts)
    assert rows(found.select("key", "n", "t", "name")) == sorted([(k, n, v, t) for k, n, t, v in expected], key=repr)
    inner = lookup_as_of(asked, known, {"key": "customer"}, "t", ["name"], how="inner")
    assert inner.count() == sum(v is not None for *_, v in expected)
    assert lookup_as_of(asked.where("false"), known, {"key": "customer"}, "t", ["name"]).isEmpty()
    assert lookup_as_of(asked, known.where("false"), {"key": "customer"}, "t", ["name"]).where("name is null").count() == len(facts)


def test_later_start_wins(spark):
    known = spark.createDataFrame([(1, 0, None, "old"), (1, 5, 8, "new")], "k long, start_time long, end_time long, v string")
    asked = spark.createDataFrame([(1, 4), (1, 5), (1, 8)], "k long, t long")
    assert rows(lookup_as_of(asked, known, ["k"], "t", ["v"])) == [(1, 4, "old"), (1, 5, "new"), (1, 8, None)]
    assert rows(lookup_as_of(asked, known, ["k"], "t", ["v"], end=None)) == [(1, 4, "old"), (1, 5, "new"), (1, 8, "new")]
    with pytest.raises(ValueError, match="both sides"):
        lookup_as_of(asked, known.withColumnRenamed("v", "t"), ["k"], "t", ["t"])


def test_plan_has_no_range_join_and_splits_a_hot_key(spark):
    text = plan(QUERIES["lookup_as_of"].plan(spark, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text
    # the rows are dealt by key and range, never by the key alone (so few rows would be put together again)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    known = spark.createDataFrame([(1, 0, None, "v")], "k long, start_time long, end_time long, v string")
    hot = spark.range(20_000).selectExpr("1L as k", "id as t")
    try:
        found = lookup_as_of(hot, known, ["k"], "t", ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in spark.read.parquet(*{f.rsplit("/", 1)[0] for f in found.inputFiles()}).groupBy("_place").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20_000 / 2 and found.where("v = 'v'").count() == 20_000
