"""Operators that SQL can't express, against plain Python over a small table."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import suffixes, tokens
from millrace.llm.minhash import Banding, near_groups, sketch
from millrace.llm.queries import QUERIES
from millrace.llm.repeats import without_repeats
from millrace.llm.shards import Order
from millrace.llm.urls import TreeOptions, judged_urls

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def groups(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def word_sets(texts, n):
    fold = {i: i + 32 for i in range(65, 91)}
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t.translate(fold)) for i, t in texts.items()}
    return {i: {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set() for i, w in split.items()}


def test_near_groups(spark, texts):
    sets = word_sets(texts, 2)
    expected = groups(sets, 80)
    for r in QUERIES["op1_minhash_dedup"].plan(spark, SMALL).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), expected[r.doc_id], expected[r.doc_id] == r.doc_id)


def test_near_groups_of_variants(spark):
    """Variants of one text that are like the original but not all like each other, and some like none."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(260):
        words = list(base)
        for k in rng.choice(120, int(rng.integers(0, 14)), replace=False):
            words[k] = f"v{i}x{k}"
        rows.append((i, " ".join(words)))
    found = near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()
    expected = groups(word_sets(dict(rows), 2), 80)
    assert len(set(expected.values())) > 3
    assert {r.doc_id: r.component_id for r in found} == expected


@given(st.sets(st.integers(0, 2**64 - 1), max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=60))
@settings(max_examples=60, deadline=None)
def test_sketches_differ_in_no_more_cells_than_sets_in_members(a, b):
    x, y = (sketch(np.array(sorted(s), np.uint64)).view(np.uint64) for s in (a, b))
    assert sum(int(v).bit_count() for v in x ^ y) <= len(a ^ b)


def test_bins_agree_as_often_as_sets_are_alike():
    from millrace.llm.minhash import signature

    rng, banding = np.random.default_rng(1), Banding()
    for size in (12, 200):
        share = []
        for _ in range(200):
            pool = rng.integers(0, 2**64, size + size // 4, dtype=np.uint64)
            a, b = np.unique(pool[:size]), np.unique(pool)  # similarity 0.8
            share.append((signature(a, banding) == signature(b, banding)).mean())
        assert abs(np.mean(share) - 0.8) < 0.02  # of 200 draws


def test_ids_are_those_of_the_tokenizer(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    odd = ["", " ", "\n\n  x", "<|endoftext|> a", "a<|endoftext|>", "日本 ß 🎈", "don't  DON'T 12 345 ###", "\x00\x7f", "a" * 3000]
    for text in [*odd, *texts.values()]:
        assert tokens.encode(text, path, specials=True) == own.encode(text, add_special_tokens=False).ids
    assert 50256 not in tokens.encode("<|endoftext|>", path, specials=False)


def test_packing(spark, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    ids = {i: own.encode(t, add_special_tokens=False).ids + [0] for i, t in texts.items()}
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in QUERIES["op4_best_fit_packing"].plan(spark, SMALL).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length))
    assert set(pieces) == set(ids)
    for i, own_pieces in pieces.items():
        own_pieces.sort()
        assert [p[0] for p in own_pieces] == list(range(len(own_pieces))) and sum(p[2] for p in own_pieces) == len(ids[i])
        assert all(p[2] == 2048 for p in own_pieces[1:])
    for slots in sequences.values():
        ends = [0, *(o + n for o, n in sorted(slots))]
        assert [o for o, _ in sorted(slots)] == ends[:-1] and ends[-1] <= 2048
    assert len(sequences) <= -(-sum(map(len, ids.values())) // 2048) + 1


@given(st.integers(1, 3000), st.integers(0, 2**32))
@settings(max_examples=40, deadline=None)
def test_order_is_a_permutation_both_ways(n, key):
    order, numbers = Order(n, key), np.arange(n)
    slots = order.slot(numbers)
    assert sorted(slots.tolist()) == numbers.tolist() and (order.sequence(slots) == numbers).all()


def test_shards_hold_the_running_ids(spark, texts):
    from millrace.llm.shards import read_layout, read_shards, write_shards
    from millrace.session import new_folder

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").coalesce(1)
    folder = new_folder(spark, "shards-test")
    layout = write_shards(docs, folder, length=256, per_shard=100, key=5)
    assert read_layout(spark, folder) == layout
    path = public_tokenizers.path("byte_bpe_50k.json")
    running = [t for r in docs.collect() for t in [*tokens.encode(r.text, path, specials=False), 50256]]
    assert layout.tokens == len(running) and layout.n == -(-len(running) // 256)
    running += [50256] * (layout.n * 256 - len(running))
    rows = read_shards(spark, folder).collect()
    assert [np.frombuffer(r.ids, "<u2").tolist() for r in sorted(rows, key=lambda r: r.sequence)] == [running[k : k + 256] for k in range(0, len(running), 256)]
    later = read_shards(spark, folder, first_slot=150).collect()
    assert sorted(r.slot for r in later) == list(range(150, layout.n))


def test_shard_query(spark):
    rows = QUERIES["op6_token_shards"].plan(spark, SMALL).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) == sorted(r.sequence for r in rows)
    assert len({r.ids_crc32 for r in rows}) > 0.5 * len(rows)


def removed(texts, length):
    seen, out = {}, {}
    for i, t in sorted(texts.items()):
        data = t.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\x01" * length
            else:
                seen[data[p : p + length]] = 1
        left = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(left).hexdigest())
    return out


def test_repeats_query(spark, texts):
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op7_suffix_dedup"].plan(spark, SMALL).collect()}
    assert found == removed(texts, 100)


@pytest.mark.parametrize("options", [{}, {"crowd": 1}, {"chunk_bytes": 300}])
def test_repeats_of_dense_and_periodic_texts(spark, options):
    rng = np.random.default_rng(5)
    rows = {i: "".join(rng.choice(list("ab"), 400)) for i in range(6)}
    rows |= {10: "a" * 300, 11: "b" + "a" * 200, 12: "ab" * 150, 13: "", 14: "short", 15: "é" * 80, 16: "x" + "é" * 70}
    passage = "".join(chr(97 + k % 26) + str(k) for k in range(40))
    rows |= {20 + i: f"{i}" * 7 + passage + f"{i + 1}" * 9 for i in range(12)}
    df = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string").repartition(4)
    found = without_repeats(df, length=24, gram=10, **options).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.left).hexdigest()) for r in found} == removed(rows, 24)


def test_crowded_windows_are_sent_once_and_never_gathered():
    """A passage that many documents have between other texts."""
    import zstandard

    from millrace.llm.repeats import SPAN, _windows

    length, passage = 24, b"0123456789abcdefghijklmnopqrstuvwxyz"
    bodies = [b"%05d" % i + passage + b"%05d" % (i * 7) for i in range(50)]
    send, meet = _windows(length, 1)
    begins = np.cumsum([0, *(len(b) + 1 for b in bodies[:-1])])
    asked = [{"fp": 9, "pos": int(b) + 5, "n": len(passage) - length + 1, "doc": i, "kinds": 50} for i, b in enumerate(begins)]
    sent = list(send(iter([(3, [len(b) for b in bodies], zstandard.ZstdCompressor().compress(b"\n".join(bodies)), asked)])))
    windows, spans = [r for r in sent if r[1] == 1], [r for r in sent if r[1] == 2]
    assert len(windows) == len(passage) - length + 1 and {r[3] for r in windows} == {0}
    found = np.concatenate([np.frombuffer(r[6], SPAN) for r in spans])
    assert sorted(zip(found["start"].tolist(), found["end"].tolist(), strict=True)) == [(b + 5, b + 5 + len(passage)) for b in begins[1:].tolist()]

    read = []

    def rows():
        for i in range(100_000):
            read.append(i)
            yield 7, 1, i % 10, i, 0, i, passage[:length]

    out = meet(rows())
    next(out)
    assert len(read) < 10_000
    assert sum(len(np.frombuffer(x, SPAN)) for _, x in out) > 90_000


@given(st.text("ab", min_size=40, max_size=300), st.sampled_from([8, 16]))
@settings(max_examples=60, deadline=None)
def test_suffix_classes(text, shallow):
    data, length = text.encode(), 24
    starts = np.arange(len(data) - length + 1)
    found = suffixes.classes(data, starts, length, shallow)
    strings = [data[s : s + length] for s in starts]
    many = Counter(strings)
    for i, s in enumerate(strings):
        assert (found[i] >= 0) == (many[s] > 1)
    by = defaultdict(set)
    for s, c in zip(strings, found.tolist(), strict=True):
        if c >= 0:
            by[c].add(s)
    assert all(len(v) == 1 for v in by.values()) and len(by) == sum(n > 1 for n in many.values())


def plain_templates(rows, o):
    """host, path, good, bad of each row -> template of each, level by level."""
    forms = [(h, re.sub("[0-9]+", "#", p).removeprefix("/").split("/")) for h, p, _, _ in rows]
    templates, going = ["" for _ in rows], set(range(len(rows)))
    level = 0
    while True:
        by = defaultdict(list)
        for k in going:
            by[forms[k][0], templates[k]].append(k)
        if level:
            for ks in by.values():
                good, bad = (any(rows[k][c] for k in ks) for c in (2, 3))
                on = (good and bad) or (not good and not bad and level < o.levels)
                for k in ks:
                    if len(forms[k][1]) <= level or not on:
                        templates[k] += "/*" if len(forms[k][1]) > level else ""
                        going.remove(k)
        below = defaultdict(lambda: defaultdict(list))
        for k in going:
            h, segments = forms[k]
            if len(segments) > level:
                below[h, templates[k]][segments[level]].append(k)
        if not below:
            return templates
        for values in below.values():
            figures = {
                v: np.array([sum(rows[k][3] for k in ks), sum(rows[k][2] + rows[k][3] for k in ks), sum(len(forms[k][1]) == level + 1 for k in ks), len(ks)])
                for v, ks in values.items()
            }
            total = sum(figures.values())

            def gap(a, na, b, nb, corrected=False):
                p = (a + b) / (na + nb) if na and nb else 0
                s = (p * (1 - p) * (1 / na + 1 / nb)) ** 0.5 if na and nb else 0
                return (abs(a / na - b / nb) - corrected * 0.5 * (1 / na + 1 / nb)) / s if s > 0 else 0

            large = {v for v, f in figures.items() if f[3] >= o.branch_rows and f[3] >= o.branch_share * total[3]}
            stay = large | {v for v, f in figures.items() if gap(f[0], f[1], *(total - f)[:2], True) > o.z}
            alike = [v for v in large if max(gap(*figures[v][:2], *(total - figures[v])[:2]), gap(*figures[v][2:], *(total - figures[v])[2:])) <= o.z]
            for v, ks in values.items():
                name = "*" if v not in stay else "{" + "|".join(sorted(alike)) + "}" if v in alike and len(alike) > 1 else v
                for k in ks:
                    templates[k] += "/" + name
        level += 1


def test_urls_are_told_apart_at_any_depth_and_in_any_number(spark):
    """Bad sections below a path of common segments, and one bad section of a hundred on one host."""
    rows = [(f"http://deep.net/a/b/c/{kind}/x{n:x}y/z", int(kind == "spam")) for kind in ("spam", "news") for n in range(1000)]
    rows += [(f"http://wide.net/s{chr(97 + s // 10)}{chr(97 + s % 10)}/x{n:x}y", int(s == 42)) for s in range(100) for n in range(60)]
    rows = [(i, u, label if i % 3 else None) for i, (u, label) in enumerate(rows)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, bad int")
    options = TreeOptions()
    found = {r.page_id: r for r in judged_urls(df, label=F.col("bad"), options=options).collect()}
    assert {(r.verdict == "block") == ("/spam/" in r.path or "/sec/" in r.path) for r in found.values()} == {True}
    plain = [(u.split("/")[2], "/" + u.split("/", 3)[3], int(b == 0), int(b == 1)) for _, u, b in rows]
    assert [found[i].template for i in range(len(rows))] == plain_templates(plain, options)


def test_url_templates(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(3000):
        section = rng.choice(["en", "fr", "spam", "shop", f"u{rng.choice(list('abcdefghijk'))}x"])
        path = f"/{section}/{rng.integers(1000)}" + ("/cart" if section == "shop" else "")
        label = None if rng.random() < 0.6 else int(section == "spam" or rng.random() < 0.05)
        rows.append((i, f"http://h{i % 3}.net{path}", label))
    options = TreeOptions()
    df = spark.createDataFrame(rows, "page_id bigint, url string, bad int")
    found = {r.page_id: r for r in judged_urls(df, label=F.col("bad"), options=options).collect()}
    plain = [(f"h{i % 3}.net", u.split(".net", 1)[1], int(b == 0), int(b == 1)) for i, u, b in rows]
    names = plain_templates(plain, options)
    assert [found[i].template for i in range(len(rows))] == names
    of = lambda keep: (sum(r[3] for r, k in zip(plain, keep, strict=True) if k), sum(r[2] + r[3] for r, k in zip(plain, keep, strict=True) if k))
    bad, n = of([True] * len(rows))
    share, w = (bad + 1) / (n + 2), options.weight
    for host in {r[0] for r in plain}:
        bad, n = of([r[0] == host for r in plain])
        of_host = (bad + w * share) / (n + w)
        for name in {t for t, r in zip(names, plain, strict=True) if r[0] == host}:
            here = [t == name and r[0] == host for t, r in zip(names, plain, strict=True)]
            bad, n = of(here)
            expected = (bad + w * of_host) / (n + w)
            for i in np.flatnonzero(here)[:3].tolist():
                assert found[i].bad_share == pytest.approx(expected)
                assert found[i].verdict == ("block" if expected >= options.reject else "allow")
    assert {r.verdict for r in found.values() if "/spam/" in r.path} == {"block"}
    assert {r.verdict for r in found.values() if "/en/" in r.path} == {"allow"}


def test_url_query_keeps_rows(spark):
    rows = QUERIES["op8_url_filter"].plan(spark, SF_DIR).collect()
    assert len({r.page_id for r in rows}) == len(rows)
    assert all(r.verdict in ("allow", "block") for r in rows)
