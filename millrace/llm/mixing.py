"""Mixing sources to target weights by Pareto order sampling.

A source's target is a share of the whole by weight, at most ``most_copies`` times its size; what is over goes to the
others by weight. A document's expected copies are its source's target over its size; whole copies are certain, and the
rest is its inclusion probability for one more. With odds, expectations are in proportion to them, up to the limit. Documents are ranked by random odds over inclusion odds, and the first
ones whose words make up the rest of the target are taken once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import with_place, words
from millrace.operators.ordered import placed, running_total
from millrace.session import stored


def uniform(seed: str, key: Column) -> Column:
    """A number in (0, 1) that depends on seed and key alone: 52 bits of a digest."""
    hexed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(hexed, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: Sequence[float], total: float, most_copies: float) -> DataFrame:
    """``sizes`` (source, source_size) with ``source_no``, ``weight`` and ``target``. One row per source.

    With sources in order of cap over weight, capping the first k leaves (budget - their caps) / (other weights) per unit
    of weight; the greatest of these is the level at which no target is above its cap and all is given out.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name)
    weighted = sizes.withColumn("source_no", n).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") - 1) % len(weights) + 1))
    caps = weighted.withColumn("_cap", F.col("source_size") * F.lit(float(most_copies)))
    first = Window.orderBy(F.col("_cap") / F.col("weight"), "source_no")
    before = F.coalesce(F.sum("_cap").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(first.rowsBetween(0, Window.unboundedFollowing))
    everything = F.sum("source_size").over(Window.partitionBy())
    level = F.max((everything * F.lit(float(total)) - before) / after).over(Window.partitionBy())
    return caps.withColumn("target", F.least(F.col("weight") * level, F.col("_cap"))).drop("_cap")


def mixed(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    total: float = 1.5,
    most_copies: int = 2,
    odds: str | None = None,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source, source_size, target, taken (words) and copies.

    Size is the number of words (null text: 0). Sources in code point order, null last, get ``weights`` in turn and share
    ``total`` times all words. ``odds`` names a column of positive weights that make a document's expected copies more or
    fewer than its source's mean (null or not positive counts as 1); what exceeds ``most_copies`` is reshared inside the source. Equal draws are ordered by id, size and content, so
    reruns agree; of repeated rows any may be the one that is taken, the result is the same. Rows without words are never
    taken. A null id is a key like any other. Other columns aren't read, an empty table gives an empty result.
    """
    rows, targets = _sized(docs, [], id, text, source, weights, total, most_copies, odds)
    rows = stored(_ranked(rows, targets, most_copies, seed))
    cuts = _cuts(rows, targets)
    return rows.join(cuts, "source_no").select(
        "doc_id", "size", "source", "source_size", "target", (_copies() * F.col("size")).alias("taken"), _copies().alias("copies")
    )


_TIES = ["_rank", "doc_id", "size", "_content"]


def _rows(docs: DataFrame, passed: list[str], id: str, text: str, source: str, odds: str | None) -> DataFrame:
    wish = F.when(F.col(odds) > 0, F.col(odds).cast("double")).otherwise(F.lit(1.0)) if odds else F.lit(1.0)
    return docs.select(
        F.col(id).alias("doc_id"),
        F.col(source).alias("source"),
        F.size(words(F.col(text))).cast("bigint").alias("size"),
        F.xxhash64(F.col(text)).alias("_content"),
        wish.alias("_wish"),
        *passed,
    )


def _sized(docs, passed, id, text, source, weights, total, most_copies, odds) -> tuple[DataFrame, DataFrame]:
    """Rows with their sizes, and the targets of their sources."""
    rows = stored(_rows(docs, passed, id, text, source, odds))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("_wish")).alias("_wished"))
    targets = stored(source_targets(sizes, weights, total, most_copies))
    rated = targets.withColumn("_rate", F.col("target") / F.when(F.col("_wished") > 0, F.col("_wished"))).drop("_wished")
    return rows, (stored(_reshared(rows, rated, most_copies)) if odds else rated)


def _reshared(rows: DataFrame, targets: DataFrame, most_copies: int) -> DataFrame:
    """``targets`` with the rate of expected copies per wish at which a source's expectations, none above ``most_copies``, sum up
    to its target.

    What documents at the limit can't take raises the rate of the others, which may bring more of them there: until no
    rate changes, a sum per source each time.
    """
    while True:
        rates = targets.select(F.col("source").alias("_source"), "_rate")
        here = rows.join(rates, F.col("source").eqNullSafe(F.col("_source")))
        full = F.col("_wish") * F.col("_rate") >= F.lit(float(most_copies))
        sums = here.groupBy("_source").agg(
            F.sum(F.when(full, F.col("size")).otherwise(F.lit(0))).alias("_full"),
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("size") * F.col("_wish"))).alias("_open"),
        )
        left = F.col("target") - F.lit(float(most_copies)) * F.col("_full")
        rate = F.when((F.col("_full") > 0) & (F.col("_open") > 0), left / F.col("_open")).otherwise(F.col("_rate"))
        found = stored(targets.join(sums, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_next", rate))
        targets = found.select(*[c for c in targets.columns if c != "_rate"], F.greatest("_rate", "_next").alias("_rate"))
        if found.where("_next > _rate").isEmpty():
            return targets


def _ranked(rows: DataFrame, targets: DataFrame, most_copies: int, seed: str) -> DataFrame:
    """The rows with what is sure of them (``_sure`` copies) and their rank for one more (null: no chance of one)."""
    expected = F.least(F.coalesce(F.col("_rate") * F.col("_wish"), F.lit(0.0)), F.lit(float(most_copies)))
    chance = F.col("_expected") - F.col("_sure")
    draw = uniform(seed, F.col("doc_id"))
    # in logarithms, so that odds near 0 or without bound stay in order
    odds = F.ln(draw) - F.ln(1 - draw) - F.ln(chance) + F.ln(1 - chance)
    known = targets.withColumnRenamed("source", "_source").drop("weight")
    return (
        rows.join(known, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_expected", expected)
        .withColumn("_sure", F.floor("_expected"))
        .withColumn("_rank", F.when((chance > 0) & (F.col("size") > 0), odds))
    )


def _cuts(rows: DataFrame, targets: DataFrame, place: list[str] | None = None) -> DataFrame:
    """Per source, the last row in rank order that is taken once more: the last of which half is still wanted."""
    ties = [*_TIES, *(place or [])]
    sure = rows.groupBy("source_no").agg(F.sum(F.col("_sure") * F.col("size")).alias("_given"))
    in_order = placed(rows.where("_rank is not null").select("source_no", "target", *ties), ["source_no", *ties])
    totals = running_total(in_order, ["source_no"], ties, "size", "_upto").join(sure, "source_no")
    taken = totals.where(F.col("_upto") - F.col("size") / 2 <= F.col("target") - F.col("_given"))
    last = taken.groupBy("source_no").agg(F.max(F.struct(*ties)).alias("_last"))
    return stored(targets.select("source_no").join(last, "source_no", "left"))


def _copies(place: list[str] | None = None) -> Column:
    more = F.col("_rank").isNotNull() & (F.struct(*_TIES, *(place or [])) <= F.col("_last"))
    return (F.col("_sure") + F.when(more, 1).otherwise(0)).cast("bigint")


def mix(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    total: float = 1.5,
    most_copies: int = 2,
    odds: str | None = None,
    seed: str = "mix",
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their columns. Repeated rows are told apart by place.

    Once the last row that is taken is known per source, each row is decided where it is read: no text is shuffled.
    """
    place = ["_file", "_row"]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    named = {"_id": id, "_text": text, "_source": source} | ({"_odds": odds} if odds else {})
    read = with_place(docs.select(whole, *[F.col(c).alias(n) for n, c in named.items()]))
    names = "_id", "_text", "_source"
    own = "_odds" if odds else None
    rows, targets = _sized(read, place, *names, weights, total, most_copies, own)
    cuts = _cuts(stored(_ranked(rows, targets, most_copies, seed)), targets, place)
    again = _ranked(_rows(read, [*place, "_whole"], *names, own), stored(targets.join(cuts, "source_no")), most_copies, seed)
    copies = again.withColumn("_n", _copies(place).cast("int")).where("_n > 0")
    return copies.select("_whole", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_time")).select("_whole.*")
