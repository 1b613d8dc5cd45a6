"""The pipeline stage by stage against plain Python, each on its own input."""

import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_brute import groups, word_sets
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm.quality import ENDS, NOTICES
from millrace.session import new_folder

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
GAP = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows in, rows out) of each stage."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        folder = new_folder(spark, f"test-{name}")
        stage(spark, docs, SMALL).write.parquet(folder)
        after = spark.read.parquet(folder)
        out.append((name, [r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()]))
        docs = after
    return {name: (before, after) for name, before, after in out}


def as_counts(rows):
    return Counter(tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in rows)


def fails(line):
    n, end = len(WORD.findall(line)), line.strip(GAP)[-4:]
    unended = not re.search(f"[{ENDS}][\"'”’»)\\]]*$", end)
    return (
        (unended and (n < 8 or not re.search(f"[{ENDS}][\"'”’»)\\]]*[\x20\x09-\x0D]", line)))
        or len(re.findall(r"[#*$%&<>]{2,}", line)) > n * 0.1
        or line.count("!!") > n * 0.2
        or sum(w in "|»›•·" for w in WORD.findall(line)) >= n * 0.15
        or (n <= 25 and re.search(NOTICES, line.lower()) is not None)
    )


def judged_lines(text):
    out = []
    for line in text.split("\n"):
        before = out[-1].split("\n")[-1] if out else ""
        ended = re.search(f"[{ENDS}][\"'”’»)\\]]{{0,3}}[ \t\r]{{0,2}}$", before)
        if len(before) >= 40 and not ended and unicodedata.category((line or " ")[0]) in ("Ll", "Lo"):
            out[-1] += "\n" + line
        else:
            out.append(line)
    return [x for x in out if WORD.search(x)]


def test_quality(stages):
    before, after = stages["quality"]
    expected = []
    for r in before:
        words = WORD.findall(r["text"])
        found = Counter(zip(words, words[1:], words[2:], strict=False))
        repeats = {i + k for i in range(len(words) - 2) if found[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = judged_lines(r["text"])
        left = [x for x in lines if not fails(x)]
        if len(words) >= 50 and 2 * len(repeats) <= len(words) and 2 * sum(map(len, left)) >= sum(map(len, lines)):
            expected.append(r | {"text": "\n".join(left), "n_chars": len("\n".join(left))})
    assert as_counts(after) == as_counts(expected) and len(after) < len(before)


def test_exact_dedup(stages):
    before, after = stages["exact_dedup"]
    fold, last = {i: i + 32 for i in range(65, 91)}, {}
    for r in before:
        key = r["text"].translate(fold)
        last[key] = max(last.get(key, r), r, key=lambda x: x["doc_id"])
    assert as_counts(after) == as_counts(last.values()) and len(after) < len(before)


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    label = groups(word_sets({r["doc_id"]: r["text"] for r in before}, 5), 80)
    assert as_counts(after) == as_counts(r for r in before if label[r["doc_id"]] == r["doc_id"])


def test_mixing(stages):
    before, after = stages["mixing"]
    size = {r["doc_id"]: len(WORD.findall(r["text"])) for r in before}
    by = defaultdict(list)
    for r in before:
        by[r["source"]].append(r)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(by))}
    whole = {s: sum(size[r["doc_id"]] for r in rows) for s, rows in by.items()}
    target, left, open_ = {}, 1.5 * sum(whole.values()), set(by)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * whole[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2.0 * whole[s] for s in full}
        left -= sum(2 * whole[s] for s in full)
        open_ -= full
    expected = Counter()
    for s, rows in by.items():
        rate = min(target[s] / whole[s], 2.0)
        sure, given = math.floor(rate), 0
        draw = {r["doc_id"]: (int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for r in rows}
        for r in sorted(rows, key=lambda r: draw[r["doc_id"]]):
            n = size[r["doc_id"]]
            more = rate > sure and given + n / 2 <= target[s] - sure * whole[s]
            given += n if rate > sure else 0
            expected[tuple(r[c] for c in corpus_pipeline.COLUMNS)] += sure + more
    assert as_counts(after) == +expected


def test_packing(stages):
    before, after = stages["packing"]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, total = Counter(), 0
    for r in before:
        ids = [*own.encode(r["text"], add_special_tokens=False).ids, 0]
        total += len(ids)
        first = len(ids) % 2048 or 2048
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 2048)], [*range(first, len(ids), 2048), len(ids)], strict=True)):
            body = np.array(ids[a:b], "<u4").tobytes()
            expected[r["doc_id"], k, a, b - a, zlib.crc32(body), body] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in after) == expected
    sequences = defaultdict(list)
    for r in after:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for slots in sequences.values():
        ends = [0, *(o + n for o, n in sorted(slots))]
        assert [o for o, _ in sorted(slots)] == ends[:-1] and ends[-1] <= 2048
    assert len(sequences) <= -(-total // 2048) + 2


def test_stages_with_odd_rows(spark):
    """Nulls in every column, empty and repeated rows, other columns; empty tables."""
    prose = " ".join(f"a{i} b{i} c{i} d{i} e{i} f{i} g{i}." for i in range(9))
    rows = [(1, prose, "en", "x", 1), (1, prose, "en", "x", 1), (None, prose + " More here.", None, None, None), (3, None, "en", "y", 0), (4, "", "en", "y", 0)]
    docs = spark.createDataFrame(rows, corpus_pipeline.DOCUMENTS).withColumn("kept", corpus_pipeline.F.lit("clash"))
    for given in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            folder = new_folder(spark, f"odd-{name}")
            stage(spark, given, SMALL).write.parquet(folder)
            if name != "packing":
                assert spark.read.parquet(folder).columns == corpus_pipeline.COLUMNS
            given = spark.read.parquet(folder)
    first = new_folder(spark, "odd-first")
    corpus_pipeline.quality(spark, docs, SMALL).write.parquet(first)
    assert spark.read.parquet(first).count() == 3
    assert corpus_pipeline.exact_dedup(spark, spark.read.parquet(first), SMALL).count() == 2


def test_run(spark):
    assert set(corpus_pipeline.run(spark, SMALL).columns) >= {"doc_id", "piece", "sequence_id", "offset", "ids"}
