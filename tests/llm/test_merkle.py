"""The manifest against a plain tree, and proofs of changed rows."""

import hashlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from millrace.llm.merkle import Shape, audited, leaf, manifest

ROWS = (
    [(i, "s", "en", f"Text {i}") for i in range(1, 76)]
    + [(i, None, None, None) for i in (5, 5, 200)]
    + [(None, "s", "en", "no id"), (None, "t", "en", "no id"), (7, "s", "en", "again"), (7, "s", "en", "Text 7")]
    + [(300, "é", "fr", ""), (303, "s", "", "X" * 100_000)]
    + [(400 + i, "s", f"l{i:02}", "one") for i in range(11)]
)


def plain_hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return plain_hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, arity):
    """(root, proof of each node: its siblings level by level)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for n, p in enumerate(at):
            run = p // arity * arity
            proofs[n].append((nodes[run:p], nodes[p + 1 : run + arity]))
        nodes = [plain_hash(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
        at = [p // arity for p in at]
    return nodes[0], proofs


def plain_manifest(rows, arity):
    def order(r):
        return ("" if r[2] is None else "=" + r[2], r[0] is not None, r[0] or 0, plain_leaf(r))

    groups = [list(g) for _, g in groupby(sorted(rows, key=order), key=lambda r: r[2])]
    done = [tree([plain_leaf(r) for r in g], arity) for g in groups]
    root, tops = tree([d[0] for d in done], arity)
    out = []
    for g, (subroot, proofs), top in zip(groups, done, tops, strict=True):
        for row, proof in zip(g, proofs, strict=True):
            siblings = "".join(s for left, right in proof + top for s in left + right)
            out.append((row[0], plain_leaf(row), subroot, root, plain_hash(siblings)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, source string, lang string, text string")
    return df.select("*", *[F.lit("clash").alias(c) for c in ("tree", "idx", "node", "row", "path", "left", "leaf", "root", "l0")])


def columns(**changed):
    return {c: F.col(c) for c in ("doc_id", "source", "lang", "text")} | changed


@pytest.mark.parametrize("shape", [Shape(), Shape(8, 1), Shape(2, 2), Shape(3, 3)])
def test_proofs(docs, shape):
    third = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    changed = leaf(list(columns(text=F.lower("text")).values()))
    found = audited(manifest(docs, columns(), group="lang", id="doc_id", carried={"now": F.when(third, changed)}, shape=shape), F.coalesce("now", "leaf"))
    rows = found.collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in rows), key=repr) == plain_manifest(ROWS, shape.arity)
    # a text without capitals stays as it is, and so does a null one
    assert {(r.doc_id, r.verified) for r in rows if r.doc_id in (3, 4, 5, 200, 300, 303)} == {(3, False), (4, True), (5, True), (200, True), (300, True), (303, False)}
    assert all(r.verified == (r.folded_root == r.root) and r.verified == (r.now in (None, r.leaf)) for r in rows)


def test_small_tables(docs):
    def found(df):
        return audited(manifest(df, columns(), group="lang", id="doc_id"), F.col("leaf"))

    assert found(docs.where("false")).collect() == []
    (only,) = found(docs.where("doc_id = 300")).collect()
    assert only.leaf == only.subroot == only.root == plain_leaf((300, "é", "fr", "")) and only.verified
    assert only.proof_sha256 == hashlib.sha256(b"").hexdigest()
