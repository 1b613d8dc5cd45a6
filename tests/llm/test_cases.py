"""Odd inputs for every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm.chat import parse, prefix_tree, read_back
from millrace.llm.exact import exact_dedup, without_copies
from millrace.llm.minhash import near_groups, without_near_copies
from millrace.llm.mixing import mix, mixed
from millrace.llm.packing import packed
from millrace.llm.quality import cleaned, line_quality
from millrace.llm.repeats import without_repeats
from millrace.llm.shards import materialised
from millrace.llm.urls import Rule, judged_urls
from millrace.llm.warc import archived, read_archives, write_archives

PROSE = "One two three four five six seven eight nine ten eleven twelve."
LONG = " ".join(f"w{i}" for i in range(30_000))
#: Names that the operators use inside.
CLASH = ["_file", "_row", "_gone", "_whole", "_id", "_source", "_odds", "digest", "kept", "bucket", "label", "ids", "part", "chunk", "size", "target", "n", "body", "rank", "start", "_text", "_rank"]
ROWS = [(1, "A b c d e f", "x"), (2, "a B c d e f", "x"), (2, "a B c d e f", "x"), (3, None, None), (4, "", "y"), (None, "q r", "y"), (5, LONG, "x"), (6, " \t ", "z"), (None, None, "z")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_quality(docs, none):
    found = [r.asDict() for r in line_quality(docs).collect()]
    assert len(found) == len(ROWS) and line_quality(none).isEmpty()
    assert {r["n_words"] for r in found if r["doc_id"] in (3, 4, 6)} == {0}
    assert all(r["base_failed"] for r in found if r["n_words"] < 50)
    assert [c for c in cleaned(docs).columns] == docs.columns and cleaned(none).isEmpty()


def test_quality_lines(spark):
    prose = " ".join(f"a{i} b{i} c{i} d{i} e{i} f{i} g{i}." for i in range(9))
    text = f"{prose}\nHome | News | About\nAll rights reserved.\nread on"
    df = spark.createDataFrame([(1, text), (2, "\n".join(["Menu | A | B"] * 60))], "doc_id bigint, text string")
    kept, junk = sorted(line_quality(df, clean="clean").collect())
    assert kept.kept and kept.clean == prose and kept.n_lines_removed == 3
    assert not junk.kept and junk.n_dup_lines == 59
    assert [r.text for r in cleaned(df).collect()] == [prose]


def test_quality_of_other_scripts_and_wrapped_lines(spark):
    hindi = "\n".join(" ".join(f"{w}{i}" for w in "यह वाक्य और इसमें कुछ साधारण शब्द".split()) + " हैं।" for i in range(20))
    urdu = "\n".join(" ".join(f"{w}{i}" for w in "یہ جملہ اور اس میں کچھ الفاظ".split()) + " ہیں۔" for i in range(20))
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    wrapped = "\n".join(" ".join(words[i : i + 10]) for i in range(0, 200, 10)) + "."
    endless = wrapped[:-1]  # wrapped, but never a sentence
    menu = "\n".join(" ".join(f"Topic{i}{j}" for j in range(9)) for i in range(20))
    given = [(1, hindi), (2, urdu), (3, wrapped), (4, endless), (5, menu), (6, f"{wrapped}\n{menu[:80]}"), (7, f"Menu\nhome\n{wrapped}")]
    found = {r.doc_id: r for r in line_quality(spark.createDataFrame(given, "doc_id bigint, text string"), clean="clean").collect()}
    assert [i for i in found if found[i].kept] == [1, 2, 3, 6, 7]
    assert found[1].clean == hindi and found[2].clean == urdu and all(found[i].clean == wrapped for i in (3, 6, 7))
    assert found[3].n_lines_removed == 0 and found[7].n_lines_removed == 2


def test_exact(docs, none):
    found = sorted(((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()), key=repr)
    assert found == sorted(
        [(0, 4, 3, False), (0, None, 1, True), (1, 2, 3, False), (2, 2, 3, False), (2, 2, 3, True), (3, 4, 3, False), (4, 4, 3, True), (5, 5, 1, True), (6, 6, 1, True)],
        key=repr,
    )
    assert exact_dedup(none).isEmpty()
    left = without_copies(docs)
    assert left.columns == docs.columns and left.count() == 5


def test_exact_tells_digest_clashes_apart(docs):
    weak = lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 3), 2, "0"))
    strong = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()}
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs, digest=weak).collect()} == strong


def test_exact_state_outlives_a_batch(spark, folder):
    from millrace.llm.exact import content_keys, remember, sha256
    from millrace.llm.text import with_place

    for n, ids in enumerate(([1, 2], [3])):
        texts = spark.createDataFrame([(i, "same" if i != 2 else "other") for i in ids], "doc_id bigint, text string")
        content_keys(with_place(texts), "doc_id", "text", sha256).write.mode("append").parquet(folder("keys"))
        found = remember(spark, folder("keys"), folder("state"))
        assert sorted((r.keeper.doc_id, r.group_size) for r in found.collect()) == [[(1, 1), (2, 1)], [(2, 1), (3, 2)]][n]


def test_near(docs, none):
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_groups(docs, words=2).collect()}
    assert found == {(1, 5, 1, True), (2, 5, 1, False), (3, 0, 3, True), (4, 0, 4, True), (None, 1, None, True), (5, 29999, 5, True), (6, 0, 6, True), (None, 0, None, True)}
    assert near_groups(none).isEmpty()
    left = without_near_copies(docs, words=2)
    assert left.columns == docs.columns and left.count() == len(ROWS) - 2


def test_an_id_over_several_texts_links_them(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(9)) for c in "xyz")
    rows = [(1, one), (5, one), (2, two), (5, two), (3, three), (9, "q"), (9, three)]
    found = {(r.doc_id, r.component_id) for r in near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {(1, 1), (5, 1), (2, 1), (3, 3), (9, 3)}


def test_mixing(docs, none, spark):
    found = mixed(docs, total=1.0).collect()
    assert len(found) == len(ROWS) and mixed(none).isEmpty()
    assert all(r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0 for r in found)
    assert mix(docs).columns == docs.columns and mix(none).isEmpty()
    many = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(id % 40 as int)) as text", "concat('s', id % 4) as source", "cast(id % 7 as double) as odds")
    rows = mixed(many, odds="odds").collect()
    for name in ("s0", "s1", "s2", "s3"):
        of = [r for r in rows if r.source == name]
        assert abs(sum(r.taken for r in of) - of[0].target) <= 0.02 * of[0].target + 40
    taken = {r.doc_id: r.copies for r in mixed(many).collect()}
    copies = {r.doc_id: r["count"] for r in mix(many).groupBy("doc_id").count().collect()}
    assert copies == {k: v for k, v in taken.items() if v}
    assert taken == {r.doc_id: r.copies for r in mixed(many.repartition(5)).collect()}


def test_packing(docs, none):
    found = packed(docs, capacity=64).collect()
    assert packed(none).isEmpty()
    assert sum(r.length == 1 and r.offset is not None for r in found) >= 3
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for slots in by.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in found)
    assert len(by) <= -(-total // 64) + 1


def test_shards(docs, none):
    found = materialised(docs, length=64, per_shard=16).collect()
    assert materialised(none).isEmpty()
    n = len(found)
    assert sorted(r.slot for r in found) == list(range(n)) == sorted(r.sequence for r in found)
    assert all(r.shard == r.slot // 16 and r.record == r.slot % 16 and len(r.ids) == 128 for r in found)


def test_repeats(docs, none):
    found = [(r.doc_id, r.n_bytes, r.n_removed) for r in without_repeats(docs, length=20, gram=8).collect()]
    assert len(found) == len(ROWS) and without_repeats(none).isEmpty()
    assert {r[1] for r in found if r[0] in (3, 4)} == {0}


def test_urls(spark):
    urls = ["http://A.Example.ORG/es/1?x", None, "no host", "ftp://h", "http://h/\u00c9/" + "x/" * 500, "http://h#f", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id bigint, url string, template string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged_urls(pages, [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/")]).collect()}
    assert found[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert found[1] == found[2] == ("", "", None, "allow")
    assert found[3][:2] == ("h", "") and found[5][:2] == ("h", "") and found[6][:2] == ("b:", "//c/d")
    assert judged_urls(pages.where("false")).isEmpty()


def test_warc(spark):
    big = "x" * 1000
    rows = [(1, "http://a/ b\r\n", big), (2, None, big), (2, None, big), (None, "u", big), (3, "u", "WARC/1.1\r\n\r\n" * 9), (4, "u", None), (5, "u", "é")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash"))
    found = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in archived(pages).collect()), key=repr)
    assert found == sorted([(1, 1000, "revisit", 2), (2, 1000, "response", None), (2, 1000, "response", None), (0, 1000, "revisit", 2), (3, 108, "response", None), (4, 0, "response", None), (5, 2, "response", None)], key=repr)
    assert archived(pages.where("false")).isEmpty()
    tiny = ((10, 3), (500, 2))
    assert sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in archived(pages, shared=tiny).collect()), key=repr) == found


def test_warc_files_are_bounded_by_bytes(spark, folder):
    pages = spark.createDataFrame([(n, "u", f"{n}" * (2_000_000 if n < 3 else 10)) for n in range(10)], "page_id bigint, url string, html string").coalesce(1)
    write_archives(pages, folder("warc"), shared=((1000, 4), (1_000_000, 2)))
    files = [r.length for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder("warc")).select("length").collect()]
    assert sorted(n > 2_000_000 for n in files) == [False, False, True, True, True] and max(files) < 2_100_000
    assert {(r.page_id, r.payload_bytes) for r in read_archives(spark, folder("warc")).collect()} == {(n, 2_000_000 if n < 3 else 10) for n in range(10)}


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", r"\### </turn> \\"), (2, 0, "user", "hi"), (2, 1, "assistant", "b"), (3, None, None, None), (3, 2, "a\nb### ", "x" * 50_000)]
    rows += [(4, 0, "user", "hi"), (4, 0, "user", "hi"), (None, 0, "assistant", "<")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("rank", F.lit("clash"))
    tree, leaves = prefix_tree(turns)
    found = {r.conv_id: r for r in read_back(tree, leaves).collect()}
    assert {k: r.n_turns for k, r in found.items()} == {1: 2, 2: 2, 3: 2, 4: 2, None: 1}
    assert found[1].loss_sha256 == hashlib.sha256(rows[1][3].encode()).hexdigest()
    assert found[3].turns_sha256 == hashlib.sha256(("\n\n" + rows[5][2] + "\n" + rows[5][3] + "\n").encode()).hexdigest()
    nodes = {r.start: r for r in tree.collect()}
    assert len(nodes) == 7  # "hi" once for three conversations
    at = 0
    for start in sorted(nodes):
        assert start == at
        at += nodes[start].n_tokens
    for leaf in leaves.collect():
        ancestors, position = set(), 0
        for start in leaf.path:
            seen = {t for a in nodes[start].attend for t in range(a.start, a.end)}
            assert seen == ancestors and nodes[start].position == position
            ancestors |= set(range(start, start + nodes[start].n_tokens))
            position += nodes[start].n_tokens
    assert prefix_tree(turns.where("false"))[0].isEmpty()
    with pytest.raises(ValueError):
        parse("### user\nhi")


def test_chat_of_long_conversations(spark, monkeypatch):
    """One conversation with most rows and branches off it: given in pieces, and read in batches that never hold all of it."""
    from millrace.llm import chat

    monkeypatch.setattr(chat, "PIECE", 64)
    turns = lambda conv, n, last="": [(conv, i, ("user", "assistant")[i % 2], f"t{i}" + (last if i == n - 1 else "")) for i in range(n)]
    rows = turns(None, 1000) + turns(1, 300, "x") + turns(2, 300, "y") + turns(3, 301) + turns(4, 1000) + turns(5, 700, "z")
    tree, leaves = prefix_tree(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert max(len(r.path) for r in leaves.collect()) <= 64
    found = {r.conv_id: r for r in read_back(tree, leaves).collect()}
    for conv in (None, 1, 2, 3, 4, 5):
        own = [r for r in rows if r[0] == conv]
        assert found[conv].n_turns == len(own)
        assert found[conv].turns_sha256 == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in own).encode()).hexdigest()
    nodes = {r.start: r for r in tree.collect()}
    assert len(nodes) == 1003
    paths = {}
    for r in sorted(leaves.collect(), key=lambda r: r.piece):
        paths.setdefault(r.conv_id, []).extend(r.path)
    for way in paths.values():
        ancestors, position = set(), 0
        for start in way:
            assert {t for a in nodes[start].attend for t in range(a.start, a.end)} == ancestors and nodes[start].position == position
            ancestors |= set(range(start, start + nodes[start].n_tokens))
            position += nodes[start].n_tokens
