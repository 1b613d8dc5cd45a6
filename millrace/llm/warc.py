"""WARC archives without repeated payloads.

Only headers (id, digest, length) are shuffled: they are grouped by payload digest, the record with the greatest id becomes
the original, and the others are written as revisit records that refer to it. Archives are plain WARC/1.1 files: Spark's
text writer ends each value with a line feed, the last of the four bytes that end a record.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import new_folder, stored

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, target_uri string"
)
_END = "\r\n"


def headers(pages: DataFrame, id: str, url: str, payload: str) -> DataFrame:
    body = F.coalesce(F.col(payload), F.lit(""))
    return pages.select(
        F.col(id).cast("bigint").alias("page_id"),
        F.col(url).alias("url"),
        body.alias("body"),
        F.octet_length(body).cast("bigint").alias("bytes"),
        F.sha1(body.cast("binary")).alias("digest"),
    )


def originals(heads: DataFrame, min_bytes: int) -> DataFrame:
    """(digest, keep_id) of payloads that at least two records share."""
    groups = heads.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return groups.where("n > 1 and keep_id is not null").select("digest", "keep_id")


def _record_id(page_id: Column, digest: Column) -> Column:
    name = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("")), digest).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing when the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(_END)), F.lit(""))


def records(heads: DataFrame, kept: DataFrame, date: str) -> DataFrame:
    """One text value per record: header, block and all but the last byte of the record end."""
    revisit = F.col("keep_id").isNotNull() & ((F.col("page_id") < F.col("keep_id")) | F.col("page_id").isNull())
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("bytes").cast("string"), F.lit(_END * 2)
    )
    block_bytes = F.length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    uri = F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    value = F.concat(
        F.lit(f"WARC/1.1{_END}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(_END),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("keep_id"), F.col("digest")))),
        _line("X-Refers-To-Page", F.when(revisit, F.col("keep_id"))),
        _line("X-Page", F.col("page_id")),
        F.lit(f"Content-Type: application/http; msgtype=response{_END}Content-Length: "),
        block_bytes.cast("string"),
        F.lit(_END * 2),
        http,
        F.when(revisit, "").otherwise(F.col("body")),
        F.lit("\r\n\r"),
    )
    return heads.join(kept, "digest", "left").select(value.alias("value"))


#: Payload bytes up to which records share files, and how many of them: no file gets much above 256 MB.
SHARED = ((2**18, 1000), (2**23, 32))


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
    shared: Sequence[tuple[int, int]] = SHARED,
) -> None:
    """Write a record per row of ``pages`` below ``folder``.

    Null payloads are empty, a null url has no target line, a null id no id line. Of equal payloads of ``min_bytes`` or
    more, the record with the greatest id is the response and the others revisit it (repeated rows with that id are all
    responses); a payload whose rows all lack an id is written in full each time. Files are bounded by bytes: records go
    into files with others of their size class, as many to a file as ``shared`` says (largest payload, records), and
    those above all classes have a file each. Other columns aren't read. An empty table leaves archives without records.
    """
    heads = headers(pages, id, url, payload)
    known = stored(heads.drop("body", "url"))
    kept = stored(originals(known, min_bytes))
    least = 0
    for most, records_per_file in (*shared, (2**31, 1)):
        own = (F.col("bytes") >= least) & (F.col("bytes") < most)
        # classes without rows aren't read for; the first is written in any case, so that there is an archive
        if least == 0 or not known.where(own).isEmpty():
            writer = records(heads.where(own), kept, date).write.option("lineSep", "\n").option("maxRecordsPerFile", str(records_per_file))
            writer.text(f"{folder}/below-{most}")
        least = most


_BLANK_LINE = re.compile(rb"\r\n\r\n")


def _blank_line(data: memoryview, start: int, end: int) -> int:
    found = _BLANK_LINE.search(data, start, end)
    if found is None:
        raise ValueError(f"no header ends after byte {start}")
    return found.start()


def _parsed(content: memoryview) -> Iterator[tuple]:
    at, data = 0, memoryview(content)
    while at < len(data):
        cut = _blank_line(data, at, len(data))
        lines = str(data[at:cut], "utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record starts at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start = cut + 4
        end = start + int(head["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where its length says")
        body = _blank_line(data, start, end) + 4
        page, refers = head.get("X-Page"), head.get("X-Refers-To-Page")
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response":
            size = end - body
            if hashlib.sha1(data[body:end]).hexdigest() != digest:
                raise ValueError(f"the payload of the record at byte {at} doesn't have its digest")
        else:
            http = dict(x.split(": ", 1) for x in str(data[start : body - 4], "utf-8").split("\r\n")[1:])
            size = int(http["Content-Length"])
        yield (
            int(page) if page else None,
            size,
            digest,
            head["WARC-Type"],
            int(refers) if refers else None,
            head["WARC-Record-ID"],
            head.get("WARC-Target-URI"),
        )
        at = end + 4


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record; payloads are measured and their digests checked. A damaged archive fails."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [{"bigint": pa.int64(), "string": pa.string()}[x.split()[1]] for x in RECORD.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = list(zip(*_parsed(content.as_buffer()), strict=True))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, types, strict=True)], names=names)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("content").mapInArrow(parse, RECORD)


def archived(pages: DataFrame, **names: str) -> DataFrame:
    """Write the archives to a new shared folder and read them back."""
    folder = new_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, **names)
    return read_archives(pages.sparkSession, folder)
