"""CSV with line breaks in fields, cut at any byte, against Python's own reader; members of any type."""

import csv
import io
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.semi import flatten_members
from millrace.sources.files import DelimitedFormat
from millrace.sources.quoted import read_quoted_csv

RANDOM = random.Random(9)
BITS = ["a", "bc", " ", "\n", "\r\n", '"', ",", "é", "\n\n", '""', "x" * 40, "|"]


def made(n, sep=","):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=sep, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
    data = [(i, "t" + "".join(RANDOM.choices(BITS, k=RANDOM.randint(0, 9 if i % 7 else 120))) + "t", i / 4) for i in range(n)]
    writer.writerow(["id", "text", "amount"])
    writer.writerows(data)
    return out.getvalue(), data


@pytest.mark.parametrize("size", ["300b", "1k", "1m"])
def test_any_cut_gives_the_same_records(spark, folder, tmp_path, size):
    (tmp_path / "in").mkdir()
    expected = []
    for n in range(3):
        text, data = made(400)
        (tmp_path / "in" / f"{n}.csv").write_text(text, newline="")
        expected += data
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", size)
    found = read_quoted_csv(session, folder("in"), "id bigint, text string, amount double")
    assert sorted((r.id, r.text, r.amount) for r in found.collect()) == sorted(expected)
    if size != "1m":
        assert session.read.text(folder("in")).rdd.getNumPartitions() > 20


def test_record_over_many_ranges(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    long = "\n".join(f"line {n}" for n in range(3000))
    (tmp_path / "in" / "x.csv").write_text(f'id;text\n1;"{long}"\n2;b\n\n3;"c\nd"', newline="")
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    found = read_quoted_csv(session, folder("in"), "id bigint, text string", DelimitedFormat(separator=";"))
    assert rows(found) == [(1, long), (2, "b"), (3, "c\nd")]


def test_broken_files(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text('1,"a\n2,b\n3,c\n')
    plain = DelimitedFormat(header=False)
    with pytest.raises(Exception, match="doesn't end"):
        read_quoted_csv(spark, folder("in"), "id bigint, text string", plain).collect()
    (tmp_path / "in" / "x.csv").write_text('1,"a\nb"\nx,c\n')
    with pytest.raises(Exception, match="MALFORMED|parse"):
        read_quoted_csv(spark, folder("in"), "id bigint, text string", plain).collect()
    found = read_quoted_csv(spark, folder("in"), "id bigint, text string", plain, mode="PERMISSIVE")
    assert sorted((r.id or 0, r.text, r._corrupt_record) for r in found.collect()) == [(0, "c", "x,c"), (1, "a\nb", None)]
    with pytest.raises(ValueError, match="doubled"):
        read_quoted_csv(spark, folder("in"), "id bigint", DelimitedFormat(escape="\\"))


def test_members_of_any_type(spark):
    docs = ['{"r":{"n":1,"t":"x","a":[1,{"b":2}],"o":{},"z":null}}', '{"r":{}}', '{"r":[true,2.5]}', '{"r":7}', '{"q":1}', None]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, d string").select("id", F.parse_json("d").alias("v"))

    def told(outer):
        return rows(flatten_members(df, "v", "$.r", outer).select("id", "key", "pos", F.to_json("value").alias("value")))

    members = [(0, "a", 0, '[1,{"b":2}]'), (0, "n", 1, "1"), (0, "o", 2, "{}"), (0, "t", 3, '"x"'), (0, "z", 4, "null"), (2, None, 0, "true"), (2, None, 1, "2.5")]
    assert told(False) == sorted(members, key=repr)
    assert told(True) == sorted([*members, *[(n, None, None, None) for n in (1, 3, 4, 5)]], key=repr)
