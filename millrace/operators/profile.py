"""Column profile: counts, mean, deviation, extremes and exact quartiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import as_double
from millrace.operators.ordered import placed, running_total

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
_ACCURACY = 10_000  # a sketched quantile is off by at most 1 / accuracy of the rows
_MARGIN = 4 / _ACCURACY


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column. Quartiles interpolate linearly between the two nearest rows, and are exact.

    A sketch first gives values just below and above each quartile. A second pass counts what lies below and up to them,
    next to the plain figures. Only rows between the two, a few in ten thousand, are then counted by
    value and ranked. A quartile that its sketch missed is ranked over all rows. What comes to
    the driver is a fixed number of figures per column.
    """
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    edges = [e for p in QUARTILES.values() for e in (max(p - _MARGIN, 0.0), min(p + _MARGIN, 1.0))]
    sketch = values.agg(*[F.percentile_approx(c, edges, _ACCURACY).alias(c) for c in columns]).first()

    slots = []  # column, quartile, lower and upper value; none for a column without values
    for c in columns:
        for i, name in enumerate(QUARTILES if sketch[c] else ()):
            slots.append((c, name, sketch[c][2 * i], sketch[c][2 * i + 1]))
    figures = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        plain = {"n": F.count(c), "mean": F.avg(c), "stddev": F.stddev_samp(c), "min": F.min(c), "max": F.max(c)}
        figures += [f.alias(f"{c}.{label}") for label, f in plain.items()]
    for k, (c, _, low, high) in enumerate(slots):
        figures += [F.count_if(F.col(c) < low).alias(f"below.{k}"), F.count_if(F.col(c) <= high).alias(f"upto.{k}")]
    seen = values.agg(*figures).first().asDict()

    picked, ranks, between = {}, {}, []
    for k, (c, name, low, high) in enumerate(slots):
        at = QUARTILES[name] * (seen[f"{c}.n"] - 1)
        first, last, below = math.floor(at), math.ceil(at), seen[f"below.{k}"]
        inside = F.col(c).isNotNull()
        if below <= first and last < seen[f"upto.{k}"]:
            if low == high:  # one value covers both ranks
                picked[k] = low
                continue
            inside = F.col(c).between(low, high)
        else:
            below = 0
        ranks[k] = (first - below, last - below, at - first)
        between.append(F.when(inside, F.struct(F.lit(k).alias("slot"), F.col(c).alias("value"))))
    if ranks:
        picked |= _at_ranks(values, between, ranks)

    quartiles = {(c, name): picked[k] for k, (c, name, _, _) in enumerate(slots)}
    rows = [
        (c, seen["n_rows"], seen[f"{c}.n"], seen[f"{c}.mean"], seen[f"{c}.stddev"], seen[f"{c}.min"])
        + tuple(quartiles.get((c, name)) for name in QUARTILES)
        + (seen[f"{c}.max"],)
        for c in columns
    ]
    numbers = ["mean", "stddev", "min", *QUARTILES, "max"]
    schema = "column_name string, n_rows bigint, n_values bigint, " + ", ".join(f"{n} double" for n in numbers)
    out = df.sparkSession.createDataFrame(rows, schema)
    return out.withColumns({n: F.round(as_double(F.col(n)), 4) for n in numbers})


def _at_ranks(values: DataFrame, between: list[Column], ranks: dict[int, tuple[int, int, float]]) -> dict[int, float]:
    """Interpolated value per slot, from the values that lie between the slot's edges."""
    near = values.select(F.inline(F.array_compact(F.array(*between))))
    counted = near.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_total(placed(counted, ["slot", "value"]), ["slot"], ["value"], "n", "upto")

    def value_at(which: int) -> Column:
        rank = F.create_map(*[F.lit(x) for slot, r in ranks.items() for x in (slot, r[which])])
        return F.min(F.when(F.col("upto") > rank[F.col("slot")], F.col("value")))

    ends = ranked.groupBy("slot").agg(value_at(0).alias("low"), value_at(1).alias("high")).collect()
    return {r.slot: r.low + (r.high - r.low) * ranks[r.slot][2] for r in ends}


def non_null_counts(df: DataFrame) -> DataFrame:
    """Type and number of non-null values per column, in one pass."""
    counted = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns], F.count(F.lit(1)).alias("_all"))
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("column_type"), F.col(c).alias("n_values"), F.col("_all").alias("n_rows"))
            for c, kind in df.dtypes
        ]
    )
    return counted.select(F.inline(entries))
