"""URL filtering by rules and by a tree of path templates per host.

Rules (allow or block a host with its subdomains, from a path on) decide first. The others are judged by the template that
their path falls under. Level by level, the values of a path segment below one template are counted: values that hold
enough of its rows stay as branches, and so do those, however few, whose share of bad rows is clearly another than that of
the rest; all others become a wildcard. Large branches that are alike, in the share of labelled rows
that are bad and in the share of paths that end there, are merged into one. A template is rejected when the share of bad
rows among its labelled ones, smoothed towards its host's and the host's towards that of all hosts, is too high.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import LOWER, UPPER
from millrace.session import stored


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TreeOptions:
    """A value stays a branch with at least ``branch_rows`` rows and ``branch_share`` of its parent's, or when its share of bad
    rows is more than ``z`` standard errors away from that of its parent's other rows. Rows without labels are told
    apart by ``levels`` segments, others as long as good and bad ones are mixed. Branches are alike within ``z`` standard errors. ``weight`` is the number of labelled rows that a host's share counts for in a template,
    and that of all hosts in a host; ``reject`` the share of bad rows from which on a template is rejected."""

    levels: int = 4
    branch_rows: int = 20
    branch_share: float = 0.02
    z: float = 2.58
    weight: float = 8.0
    reject: float = 0.7


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for what has no ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, parts, 1), UPPER, LOWER), F.regexp_extract(text, parts, 2)


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, else nulls. For rule lists that fit into a query."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _share_gap(a: Column, na: Column, b: Column, nb: Column, corrected: bool = False) -> Column:
    """Standard errors between two shares, 0 where one of them has no rows; ``corrected`` for shares of few rows."""
    p = F.try_divide(a + b, na + nb)
    parts = F.try_divide(F.lit(1), na) + F.try_divide(F.lit(1), nb)
    spread = F.sqrt(p * (1 - p) * parts)
    apart = F.abs(F.try_divide(a, na) - F.try_divide(b, nb)) - (F.lit(0.5) * parts if corrected else F.lit(0.0))
    # null where a side has no rows, or where all rows are alike
    return F.coalesce(F.try_divide(apart, spread), F.lit(0.0))


_PARENT = ["host", "template"]


def _next_level(rows: DataFrame, level: int, options: TreeOptions) -> DataFrame:
    """``rows`` with the next segment in their templates."""
    here = rows.where(F.size("_segments") >= level).withColumn("_value", F.col("_segments")[level - 1])
    ends = F.sum(F.when(F.size("_segments") == level, F.col("n")).otherwise(0))
    figures = ("n", "good", "bad", "ends")
    values = stored(here.groupBy(*_PARENT, "_value").agg(*(F.sum(c).alias(c) for c in figures[:3]), ends.alias("ends")))
    whole = values.groupBy(*_PARENT).agg(*(F.sum(c).alias(f"_all_{c}") for c in figures))
    rest = {c: F.col(f"_all_{c}") - F.col(c) for c in figures}
    labelled, rest_labelled = F.col("good") + F.col("bad"), rest["good"] + rest["bad"]
    shares = F.col("bad"), labelled, rest["bad"], rest_labelled
    enough = (F.col("n") >= options.branch_rows) & (F.col("n") >= options.branch_share * F.col("_all_n"))
    alike = F.greatest(_share_gap(*shares), _share_gap(F.col("ends"), F.col("n"), rest["ends"], rest["n"])) <= options.z
    branches = values.join(whole, _PARENT).select(
        *_PARENT, "_value", (enough & alike).alias("_alike"), (enough | (_share_gap(*shares, corrected=True) > options.z)).alias("_stays")
    )
    branches = stored(branches.where("_stays").drop("_stays"))
    # at most 1 / branch_share of them per parent
    merged = branches.where("_alike").groupBy(*_PARENT).agg(F.array_sort(F.collect_set("_value")).alias("_merged"))
    merged = merged.select(*_PARENT, F.lit(True).alias("_alike"), F.concat(F.lit("{"), F.concat_ws("|", "_merged"), F.lit("}")).alias("_set"), F.size("_merged").alias("_size"))
    name = F.when(F.col("_size") > 1, F.col("_set")).otherwise(F.col("_value"))
    branches = branches.join(merged, [*_PARENT, "_alike"], "left").select(*_PARENT, "_value", name.alias("_name"))
    named = rows.withColumn("_value", F.get("_segments", F.lit(level - 1))).join(branches, [*_PARENT, "_value"], "left")
    step = F.when(F.col("_value").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.coalesce("_name", F.lit("*"))))
    return stored(named.withColumn("template", F.concat("template", step)).drop("_value", "_name"))


def templates(paths: DataFrame, options: TreeOptions) -> DataFrame:
    """``paths`` (host, form, n, good, bad; one row per host and form) with the template of each.

    Below a host's first segments, templates whose labelled rows agree aren't told apart any further, and after ``levels``
    segments neither are those without any: parts of them could only differ in how few rows they have. Where good and bad
    rows are mixed, paths are followed to their ends. What isn't told apart any more is one ``*``.
    """
    segments = F.split(F.regexp_replace("form", "^/", ""), "/")
    rows = stored(paths.withColumn("_segments", segments).withColumn("template", F.lit("")))
    done, level = [], 0
    while True:
        level += 1
        deeper = F.size("_segments") >= level
        if level > 1:
            sums = rows.groupBy(*_PARENT).agg(F.sum("good").alias("_g"), F.sum("bad").alias("_b"))
            unknown = (F.col("_g") + F.col("_b") == 0) & F.lit(level <= options.levels)
            mixed = sums.where((F.col("_g") > 0) & (F.col("_b") > 0) | unknown)
            rows = stored(rows.join(mixed.select(*_PARENT, F.lit(True).alias("_mixed")), _PARENT, "left").withColumn("_goes_on", deeper & F.col("_mixed").isNotNull()).drop("_mixed"))
            done.append(rows.where("not _goes_on").withColumn("template", F.concat("template", F.when(deeper, "/*").otherwise(""))).drop("_goes_on"))
            rows = rows.where("_goes_on").drop("_goes_on")
        if rows.where(deeper).isEmpty():
            return reduce(DataFrame.unionByName, done, rows).drop("_segments")
        rows = _next_level(rows, level, options)


def judged_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = (),
    *,
    id: str = "page_id",
    url: str = "url",
    label: Column | None = None,
    options: TreeOptions = TreeOptions(),
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, template, bad_share.

    ``label`` tells good (0) and bad (1) rows, null where unknown; by default the rules label the rows that they decide. A
    null url, or one without ``://``, has an empty host and path and is judged as such. Runs of digits in a path count as
    one wildcard. Repeated rows are judged alike and count each, ids are passed on, other columns aren't read, and an empty
    table gives an empty result.
    """
    host, path = url_parts(F.col(url))
    read = pages.select(F.col(id).alias("page_id"), host.alias("host"), path.alias("path"), *([label.alias("_label")] if label is not None else []))
    found = read.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules))
    if label is None:
        found = found.withColumn("_label", F.when(F.col("_rule.verdict") == "block", 1).when(F.col("_rule.verdict") == "allow", 0))
    rows = stored(found.withColumn("form", F.regexp_replace("path", "[0-9]+", "#")))
    count = F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_label") == 0, 1)).alias("good"), F.count(F.when(F.col("_label") == 1, 1)).alias("bad")
    forms = templates(rows.groupBy("host", "form").agg(*count), options)

    of_all = forms.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum(F.col("good") + F.col("bad")), F.lit(0)) + 2)).alias("_all_share"))
    seen = F.sum("good").alias("good"), F.sum("bad").alias("bad")
    smoothed = lambda prior: (F.col("bad") + options.weight * prior) / (F.col("good") + F.col("bad") + options.weight)
    hosts = forms.groupBy("host").agg(*seen).select("host", smoothed(of_all.scalar()).alias("_host_share"))
    shares = forms.groupBy("host", "template").agg(*seen).join(hosts, "host")
    shares = shares.select("host", "template", smoothed(F.col("_host_share")).alias("bad_share"))
    told = stored(forms.select("host", "form", "template").join(shares, ["host", "template"]))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("bad_share") >= options.reject, "block").otherwise("allow"))
    return rows.join(told, ["host", "form"]).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), "template", "bad_share"
    )
