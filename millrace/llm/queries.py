"""The registered queries of this subpackage: each operator over its whole table, with its SQL twin where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import twins
from millrace.llm.chat import prefix_tree, read_back
from millrace.llm.exact import exact_dedup
from millrace.llm.merkle import audited, leaf, manifest
from millrace.llm.minhash import near_groups
from millrace.llm.mixing import mixed
from millrace.llm.negatives import hard_negatives
from millrace.llm.packing import packed
from millrace.llm.quality import line_quality
from millrace.llm.repeats import without_repeats
from millrace.llm.shards import materialised
from millrace.llm.text import lower_az
from millrace.llm.urls import Rule, judged_urls
from millrace.llm.warc import archived
from millrace.llm.weighted import as_text, fingerprinted
from millrace.plans.registry import Query

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(plan):
        QUERIES[name] = Query(plan, (), sql)
        return plan

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash_dedup")
def _(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"), words=2, percent=80)


@query("op2_exact_dedup", twins.EXACT)
def _(spark, sf_dir):
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op3_quality_rules", twins.QUALITY)
def _(spark, sf_dir):
    return line_quality(table(spark, sf_dir, "documents"))


@query("op4_best_fit_packing")
def _(spark, sf_dir):
    found = packed(table(spark, sf_dir, "documents"), capacity=2048)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


TRICKY = r"\### Assistant: </turn> ok"


@query("op5_chat_format", twins.CHAT)
def _(spark, sf_dir):
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    return read_back(*prefix_tree(table(spark, sf_dir, "conversations").unionByName(extra)))


@query("op6_token_shards")
def _(spark, sf_dir):
    found = materialised(table(spark, sf_dir, "documents"), length=2048)
    return found.select("slot", "sequence", "shard", "record", F.crc32("ids").alias("ids_crc32"))


@query("op7_suffix_dedup")
def _(spark, sf_dir):
    def digested(found):
        return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("left", 256).alias("kept_sha256"))

    return without_repeats(table(spark, sf_dir, "documents"), length=100, finish=digested)


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


@query("op8_url_filter")
def _(spark, sf_dir):
    return judged_urls(table(spark, sf_dir, "pages"), RULES)


@query("op9_warc", twins.WARC)
def _(spark, sf_dir):
    return archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_mixing", twins.MIXING)
def _(spark, sf_dir):
    # documents of 500 characters or more are wanted twice as much as shorter ones of their source
    docs = table(spark, sf_dir, "documents").withColumn("odds", F.when(F.col("n_chars") >= 500, 2.0).otherwise(1.0))
    return mixed(docs, odds="odds").select("doc_id", "size", "source_size", "target", "taken")


@query("op11_merkle_manifest", twins.MERKLE)
def _(spark, sf_dir):
    columns = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = leaf(list((columns | {"text": lower_az(F.col("text"))}).values()))
    docs = table(spark, sf_dir, "documents")
    found = audited(manifest(docs, columns, group="lang", id="doc_id", carried={"tampered": F.when(third, tampered)}), F.coalesce("tampered", "leaf"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op12_hard_negatives", twins.NEGATIVES)
def _(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=label, anchors=F.col("vec_id") % 100 == 0)


@query("op13_fingerprints")
def _(spark, sf_dir):
    found = fingerprinted(table(spark, sf_dir, "documents"))
    shown = [as_text(F.col(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return found.select("doc_id", "n_chars", "edited_sha256", *shown, "near_edited", "near_next")
