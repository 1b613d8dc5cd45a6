"""Fingerprints: collision rates against generalised Jaccard, neighbours and edits against plain Python."""

import hashlib
import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from millrace.llm.queries import QUERIES
from millrace.llm.weighted import Draws, Sampling, fingerprinted, likeness, prints, signatures

WORDS = [f"w{i}" for i in range(400)]
RNG = np.random.default_rng(5)


def text(n):
    return " ".join(RNG.choice(WORDS, n))


def similarity(a, b):
    def counts(t):
        w = t.split()
        n = min(5, len(w))
        return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()

    x, y = counts(a), counts(b)
    return sum((x & y).values()) / sum((x | y).values()) if x or y else 1.0


def test_samples_agree_as_often_as_weights_are_alike():
    terms = RNG.integers(0, 2**63, 300, dtype=np.uint64)
    a, b = RNG.integers(1, 9, 300).astype(float), RNG.integers(1, 9, 300).astype(float)
    a[:60], b[-90:] = 0.25, 3.5
    docs = [(terms[:250], a[:250]), (terms[50:], b[50:])]
    x, y = np.where(np.arange(300) < 250, a, 0), np.where(np.arange(300) >= 50, b, 0)
    first, second = signatures(docs, Sampling(samples=6000))
    expected = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((first == second).mean() - expected) < 4 * math.sqrt(expected * (1 - expected) / 6000)


def test_gammas():
    draws = Draws(RNG.integers(0, 2**63, 200_000, dtype=np.uint64), np.ones(200_000), Sampling())
    r, c, b = draws.gammas(3)
    # Gamma(2, 1) has mean and variance 2
    assert all(abs(x.mean() - 2) < 0.02 and abs(x.var() - 2) < 0.06 for x in (r, c)) and abs(b.mean() - 0.5) < 0.005
    assert abs(np.corrcoef(r, c)[0, 1]) < 0.01 and abs(np.corrcoef(r, b)[0, 1]) < 0.01


def test_ranks_are_those_of_the_formula():
    terms, weights = RNG.integers(0, 2**63, 500, dtype=np.uint64), RNG.integers(1, 40, 500).astype(float)
    draws = Draws(terms, weights, Sampling())
    r, c, b = (x.astype(float) for x in draws.gammas(0))
    t = np.floor(np.log(weights) / r + b)
    a = np.log(c) - r * (t - b + 1)
    assert terms[np.argmin(draws.ranked(0))] == terms[np.argmin(a)]


def test_likeness_of_texts():
    a = text(300)
    b = " ".join(a.split()[:200]) + " " + text(100)
    many = Sampling(samples=2000)
    x, y, empty, blank = prints([a, b, "", " \n"], many)
    expected = similarity(a, b)
    assert abs(likeness(x, y) - expected) < 4 * math.sqrt(expected * (1 - expected) / 2000)
    assert empty == blank == b"" and likeness(empty, blank) == 1 and likeness(x, empty) == 0 and likeness(x, x) == 1
    assert prints([a], many) == [x]


ROWS = [(3, "é" * 7 + " b"), (1, None), (2, "a b c d e f g h"), (2, "a b c d e f g h"), (None, "Z " * 9), (5, ""), (9, text(150_000)), (7, text(30)), (8, "x"), (None, None)]


@pytest.fixture
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    return df.select("*", *[F.lit("clash").alias(c) for c in ("n_chars", "place", "edge", "fingerprint", "following", "_next")])


def test_neighbours(docs):
    found = {(r.doc_id, r.n_chars): r for r in fingerprinted(docs).collect()}
    assert fingerprinted(docs).count() == len(ROWS) and fingerprinted(docs.where("false")).isEmpty()
    following = {(1, 0): "a b", (3, 9): "", (5, 0): dict(ROWS)[7], (7, len(dict(ROWS)[7])): "x", (8, 1): dict(ROWS)[9]}
    for (doc, n), after in following.items():
        given = dict(ROWS)[doc] or ""
        changed = given[: n - n // 2] + after[: n // 2]
        assert found[doc, n].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
    assert found[1, 0].near_edited == 1 and found[1, 0].near_next == 0
    # the last document meets the first, one without an id
    last = dict(ROWS)[9]
    heads = ["", "Z " * 9]
    changed = {hashlib.sha256((last[: len(last) - len(last) // 2] + h).encode()).hexdigest() for h in heads}
    assert found[9, len(last)].edited_sha256 in changed
    (only,) = fingerprinted(docs.where("doc_id = 7")).collect()
    assert only.near_next == 1 and 0 < only.near_edited <= 1


def test_query(spark):
    found = QUERIES["op13_fingerprints"].plan(spark, SF_DIR).toPandas().set_index("doc_id").sort_index()
    source = pd.read_parquet(f"{SF_DIR}/documents.parquet").sort_values("doc_id")
    texts = [t or "" for t in source["text"]]
    assert list(found.index) == list(source["doc_id"]) and len(set(found.groupby(source.set_index("doc_id")["text"]).fingerprint.nunique())) == 1
    gaps = []
    for own, after, row in zip(texts, [*texts[1:], texts[0]], found.itertuples(), strict=True):
        half = len(own) // 2
        changed = own[: len(own) - half] + after[:half]
        assert row.n_chars == len(own) and row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        gaps += [(row.near_edited - similarity(own, changed)), (row.near_next - similarity(own, after))]
        if own == after:
            assert row.near_next == 1
    # four standard errors of a sample of 64; over all documents the errors even out
    assert max(map(abs, gaps)) < 0.3 and abs(np.mean(gaps)) < 0.004
