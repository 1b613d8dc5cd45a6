"""Hard negatives against all pairs in plain Python, and lookups against products."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm.negatives import Grid, bits_of, hard_negatives, planes, scores, tables

RNG = np.random.default_rng(3)
TINY = Grid(least_rows=40, most_rows=50, least_anchors=3, most_anchors=4, tasks=2)


def vectors(n, dims=11):
    """Some vectors many times, some alike, some unlike."""
    base = RNG.normal(size=(12, dims))
    return [[float(np.float32(x)) for x in base[i % 12] + (0 if i % 5 == 0 else 0.3) * RNG.normal(size=dims)] for i in range(n)]


ROWS = [(i, v, i % 3) for i, v in enumerate(vectors(230))]
ODD = [
    (None, ROWS[0][1], 1),
    (300, None, 1),
    (301, ROWS[1][1], None),
    (302, [0.1, None], 1),
    (303, [0.1, math.nan], 1),
    (304, [0.1, math.inf], 1),
    (305, [], 2),
    (20, ROWS[20][1], 1),
    (20, ROWS[20][1], 1),
    (40, ROWS[41][1], 0),
    (306, [9.5, -3.25], 0),
    (307, [float(x) for x in range(20)], 0),
]


def plain(rows, every):
    usable = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q, lab in (r for r in usable if r[0] % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(q, w, strict=False)), j, m) for j, w, m in usable)
        for s, j, _ in [x for x in scored if x[2] == lab and x[1] != i][:5]:
            fits = [x for x in scored if x[2] != lab and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, n, k, -s, -t) for n, (t, k, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("grid", [Grid(), TINY])
def test_against_all_pairs(spark, grid):
    df = spark.createDataFrame(ROWS + ODD, "vec_id bigint, embedding array<float>, label int")
    df = df.select("*", *[F.lit(1).alias(c) for c in ("id", "q", "no", "key", "cell", "part", "score", "rank", "anchor", "goal")])
    found = hard_negatives(df, anchors=F.col("vec_id") % 20 == 0, grid=grid)
    expected = plain(ROWS + ODD, 20)
    assert len(expected) > 100 and sorted(tuple(r) for r in found.collect()) == expected


def test_small_tables(spark):
    df = spark.createDataFrame(ROWS[:30], "vec_id bigint, embedding array<float>, label int")
    anchors = F.col("vec_id") % 20 == 0
    assert hard_negatives(df.where("false"), anchors=anchors).isEmpty()
    assert hard_negatives(df.where("vec_id % 20 <> 0"), anchors=anchors).isEmpty()
    # no other row of its label, none of another label
    assert hard_negatives(df.where("vec_id in (0, 1)"), anchors=anchors).isEmpty()
    assert hard_negatives(df.where("label = 0"), anchors=anchors).isEmpty()


def test_large_components_are_refused(spark):
    df = spark.createDataFrame([(0, [1e9], 1), (1, [1.0], 1)], "vec_id bigint, embedding array<double>, label int")
    with pytest.raises(Exception, match="more than 31 bits"):
        hard_negatives(df, anchors=F.col("vec_id") == 0).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.integers(1, 20), st.integers(0, 2**31 - 1), st.integers(0, 2**32 - 1))
def test_lookups_give_products(dims, other, most, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-most - 1, most + 1, (4, d)) // 2 ** rng.integers(0, 25) for d in (dims, other))
    both = min(dims, other)
    assert (scores(tables(a), planes(b, bits_of(b))) == b[:, :both] @ a[:, :both].T).all()
