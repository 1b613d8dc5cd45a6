"""Merges and row history: properties that must hold whatever the batch."""

from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.times import ntz
from millrace.operators.history import apply_scd2, scd2_changes, start_history, unstamped_updates
from millrace.operators.merge import any_changed, delete_where, diff_snapshots, merge_changes, merge_scd1, update_where
from millrace.operators.ordered import next_time_in_key
from millrace.plans.dimension import run_scd1_batch
from millrace.session import stored
from millrace.sources.versions import BucketedTable, HistoryTable, VersionedTable
from millrace.streaming.dimension import dimension_tables, maintaining

ROW = "id bigint, name string, update_timestamp timestamp_ntz"
KEY, COLS = ["id"], ["name"]
DAY = [datetime(2024, 1, d) for d in range(1, 10)]
END = datetime(9999, 12, 31)


def step(history, before, after, now):
    changes = stored(diff_snapshots(before, after, KEY))
    return stored(apply_scd2(history, stored(scd2_changes(changes, history, KEY, COLS, F.lit(now).cast("timestamp_ntz"))), KEY))


def intervals(history):
    out = {}
    for r in history.collect():
        out.setdefault(r.id, []).append((r.start_time, r.end_time, r.is_current, r.name))
    return {k: sorted(v) for k, v in out.items()}


def check(history):
    for versions in intervals(history).values():
        assert sum(v[2] for v in versions) <= 1
        for one, nxt in zip(versions, versions[1:]):
            assert one[1] <= nxt[0]
        for v in versions:
            assert v[2] == (v[1] == END)


def test_mutation_script(spark):
    """One insert, one update, one delete, then a look at the three keys."""
    before = spark.createDataFrame([(72, "Ann", DAY[0]), (73, "Bob", DAY[0]), (74, "Cid", DAY[0])], ROW)
    history = start_history(before)
    after = update_where(before, F.col("id") == 72, {"name": F.lit("Jessica"), "update_timestamp": F.lit(DAY[1])})
    after = delete_where(after, F.col("id") == 73).unionByName(spark.createDataFrame([(223136, "Jessica", DAY[1])], ROW))
    result = step(history, before, after, DAY[2])
    assert intervals(result) == {
        72: [(DAY[0], DAY[1], False, "Ann"), (DAY[1], END, True, "Jessica")],
        73: [(DAY[0], DAY[2], False, "Bob")],
        74: [(DAY[0], END, True, "Cid")],
        223136: [(DAY[1], END, True, "Jessica")],
    }
    assert rows(step(result, before, after, DAY[2])) == rows(result)  # the same change rows once more


def test_update_without_new_stamp_is_reported(spark):
    before = spark.createDataFrame([(1, "Ann", DAY[0])], ROW)
    after = spark.createDataFrame([(1, "Eve", DAY[0])], ROW)
    history = start_history(before)
    changes = diff_snapshots(before, after, KEY)
    assert rows(step(history, before, after, DAY[1])) == rows(history)
    assert [r.name for r in unstamped_updates(changes, history, KEY).collect()] == ["Eve"]


def test_several_versions_in_one_batch(spark):
    before = spark.createDataFrame([(1, "a", DAY[0])], ROW)
    history = start_history(before)
    changes = spark.createDataFrame(
        [(1, "a", DAY[0], "DELETE", True), (1, "c", DAY[3], "INSERT", True), (1, "b", DAY[2], "INSERT", True),
         (2, "x", DAY[1], "INSERT", False), (2, "y", DAY[4], "INSERT", False), (2, "y", DAY[4], "INSERT", False)],
        ROW + ", action string, is_update boolean",
    )
    result = apply_scd2(history, scd2_changes(changes, history, KEY, COLS, ntz("2024-01-09 00:00:00")), KEY)
    assert intervals(result) == {
        1: [(DAY[0], DAY[2], False, "a"), (DAY[2], DAY[3], False, "b"), (DAY[3], END, True, "c")],
        2: [(DAY[1], DAY[4], False, "x"), (DAY[4], END, True, "y")],
    }


table_state = st.dictionaries(st.integers(0, 5), st.sampled_from(["a", "b", None]), max_size=5)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(states=st.lists(table_state, min_size=2, max_size=3))
def test_replayed_changes_rebuild_the_table(spark, states):
    stamps, frames, seen = {}, [], {}
    for i, state in enumerate(states):
        stamps = {k: stamps[k] if k in seen and seen[k] == v else DAY[i] for k, v in state.items()}
        seen = state
        frames.append(spark.createDataFrame([(k, v, stamps[k]) for k, v in state.items()], ROW))
    history = start_history(frames[0])
    for i in range(1, len(frames)):
        history = step(history, frames[i - 1], frames[i], DAY[i])
    check(history)
    now = history.where("is_current").select("id", "name", F.col("start_time").alias("update_timestamp"))
    assert rows(now) == rows(frames[-1])


def test_merge_is_idempotent_and_sees_nulls_on_request(spark):
    target = spark.createDataFrame([(1, "a", DAY[0]), (2, "b", DAY[0]), (3, None, DAY[0])], ROW)
    staged = spark.createDataFrame([(1, "A"), (2, None), (3, "c"), (4, "d")], "id bigint, name string")
    now = F.lit(DAY[1]).cast("timestamp_ntz")
    once = merge_scd1(target, staged, KEY, COLS, now)
    assert rows(once) == rows(spark.createDataFrame([(1, "A", DAY[1]), (2, "b", DAY[0]), (3, None, DAY[0]), (4, "d", DAY[1])], ROW))
    assert rows(merge_scd1(once, staged, KEY, COLS, F.lit(DAY[2]).cast("timestamp_ntz"))) == rows(once)
    strict = merge_scd1(target, staged, KEY, COLS, now, null_safe=True)
    assert rows(strict) == rows(spark.createDataFrame([(1, "A", DAY[1]), (2, None, DAY[1]), (3, "c", DAY[1]), (4, "d", DAY[1])], ROW))
    assert rows(merge_changes(target, staged, KEY, COLS, now)) == rows(diff_snapshots(target, once, KEY))
    assert rows(merge_changes(target, staged, KEY, COLS, now, null_safe=True)) == rows(diff_snapshots(target, strict, KEY))


def test_next_time_with_a_hot_key(spark):
    """A third of the rows share one key; the result equals the plain lead."""
    hot = spark.range(4000).select(F.lit(1).alias("id"), (F.lit(DAY[0]) + F.make_dt_interval(secs=F.col("id") * 997)).cast("timestamp_ntz").alias("ts"))
    rest = spark.range(8000).select((F.col("id") % 900 + 2).cast("int").alias("id"), (F.lit(DAY[0]) + F.make_dt_interval(secs=F.col("id") * 61)).cast("timestamp_ntz").alias("ts"))
    df = hot.unionByName(rest)
    found = {(r.id, r.ts): r.nxt for r in next_time_in_key(df, ["id"], "ts", "nxt").collect()}
    per_key = {}
    for key, ts in found:
        per_key.setdefault(key, []).append(ts)
    expected = {}
    for key, line in per_key.items():
        line.sort()
        expected.update({(key, a): b for a, b in zip(line, [*line[1:], None])})
    assert len(found) == 12000 and found == expected


def test_versions(spark, folder):
    dim = VersionedTable(spark, folder("dim"))
    with pytest.raises(LookupError):
        dim.read()
    first = spark.createDataFrame([(1, "a")], "id bigint, name string")
    assert dim.commit(first, batch="b1") == 0
    assert dim.commit(first.limit(0), batch="b1") == 0  # known batch: nothing is written
    assert dim.commit(first.limit(0), "truncate") == 1
    assert dim.read().count() == 0 and dim.read(0).count() == 1
    dim.drop()
    with pytest.raises(LookupError):
        dim.read()
    dim.undrop()
    assert dim.read().count() == 0
    dim.restore(0)
    assert dim.read().count() == 1
    assert dim.commit(first.union(first)) == 2 and dim.read().count() == 2


def test_buckets_rewrite_only_what_is_touched(spark, folder):
    df = spark.range(100).select("id", F.lit("a").alias("name"))
    dim = BucketedTable(spark, folder("dim"), df.schema, KEY, 8)
    dim.replace(df)
    files = set(dim.read().inputFiles())
    batch = df.where("id = 7")
    dim.change(batch, lambda part: delete_where(part, F.col("id") == 7))
    assert rows(dim.read()) == rows(df.where("id <> 7"))
    later = set(dim.read().inputFiles())
    assert len(files - later) == 1 and len(later - files) == 1
    assert [r.folder for r in dim.unused().collect()] == [f"{dim.folder}/_commit=0/_bucket={dim.touched(batch)[0]}"]
    everything = df.where("id <> 7")
    dim.change(everything, lambda part: part.limit(0))  # emptied buckets are replaced as well
    assert dim.read().count() == 0


def test_a_crash_before_the_log_line_leaves_the_table_as_it_was(spark, folder):
    df = spark.range(100).select("id", F.lit("a").alias("name"))
    dim = BucketedTable(spark, folder("dim"), df.schema, KEY, 4)
    dim.replace(df)
    note = dim.log.note

    def lost(*_, **__):
        raise OSError("lost the driver")

    dim.log.note = lost
    gone = df.where("id < 50")
    with pytest.raises(OSError):
        dim.change(gone, lambda part: delete_where(part, F.col("id") < 50))
    dim.log.note = note
    assert rows(dim.read()) == rows(df)
    dim.change(gone, lambda part: delete_where(part, F.col("id") < 50))
    assert rows(dim.read()) == rows(df.where("id >= 50"))


def test_other_buckets_or_keys_are_refused(spark, folder):
    df = spark.range(100).select("id", F.lit("a").alias("name"))
    BucketedTable(spark, folder("dim"), df.schema, KEY, 16).replace(df)
    for keys, buckets in ((KEY, 7), (["name"], 16)):
        dim = BucketedTable(spark, folder("dim"), df.schema, keys, buckets)
        for use in (dim.read, dim.started, lambda dim=dim: dim.replace(df)):
            with pytest.raises(ValueError):
                use()


def test_rows_staged_between_merge_and_retry_are_merged(spark, folder):
    target, staged = (VersionedTable(spark, folder(n)) for n in ("dim", "staging"))
    target.commit(spark.createDataFrame([(1, "a", DAY[0])], ROW))
    staged.commit(spark.createDataFrame([(1, "b")], "id bigint, name string"))
    commit = staged.commit

    def lost(*_):
        raise OSError("lost the driver")

    staged.commit = lost
    with pytest.raises(OSError):
        run_scd1_batch(target, staged, KEY, COLS, F.lit(DAY[1]).cast("timestamp_ntz"))
    staged.commit = commit
    staged.commit(staged.read().unionByName(spark.createDataFrame([(2, "c")], "id bigint, name string")))
    for _ in range(2):
        run_scd1_batch(target, staged, KEY, COLS, F.lit(DAY[2]).cast("timestamp_ntz"))
    assert rows(target.read()) == rows(spark.createDataFrame([(1, "b", DAY[1]), (2, "c", DAY[2])], ROW))
    assert staged.read().count() == 0


def test_history_batch_can_be_retried_after_a_crash(spark, folder):
    """The open rows are written twice, or the second half of a batch is missing: the history comes out the same."""
    base = spark.range(40).select("id", F.lit("a").alias("name"))
    fields = base.schema

    def run(name, crash):
        current, history = dimension_tables(spark, folder(name), fields, KEY, 4)
        write = maintaining(current, history, KEY, COLS)
        write(base.withColumn("loaded_at", F.lit(DAY[0]).cast("timestamp_ntz")), 0)
        second = base.where("id < 30").select("id", F.when(F.col("id") < 20, "b").otherwise("a").alias("name"), F.lit(DAY[1]).cast("timestamp_ntz").alias("loaded_at"))
        if crash:
            replace, calls = history.opened.replace, []

            def half(rows_, only=None):
                some = only[: len(only) // 2]
                replace(rows_.where(history.opened._bucket().isin(some)), some)
                calls.append(some)
                raise OSError("lost the driver")

            history.opened.replace = half
            with pytest.raises(OSError):
                write(second, 1)
            assert calls[0]
            history.opened.replace = replace
        write(second, 1)
        write(second, 1)
        return current, history

    plain_current, plain_history = run("plain", crash=False)
    crashed_current, crashed_history = run("crashed", crash=True)
    check(plain_history.read())
    assert plain_history.read().where("not is_current").count() == 20
    assert rows(crashed_history.read()) == rows(plain_history.read())
    assert rows(crashed_current.read()) == rows(plain_current.read())


def test_history_without_closed_rows_can_be_read(spark, folder):
    first = start_history(spark.createDataFrame([(1, "a", DAY[0])], ROW))
    history = HistoryTable(spark, folder("h"), first.schema, KEY, 2)
    assert not history.started()
    history.start(first, "b0")
    assert history.started() and rows(history.read()) == rows(first)


def test_any_changed_ignores_nulls_by_default(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("x", "x"), ("x", "y"), (None, None)], "a string, b string")
    pair = [(F.col("a"), F.col("b"))]
    assert [r[0] for r in df.select(any_changed(pair)).collect()] == [False, False, False, True, False]
    assert [r[0] for r in df.select(any_changed(pair, null_safe=True)).collect()] == [True, True, False, True, False]


def test_late_batch_changes_neither_table(spark, folder):
    base = spark.range(10).select("id", F.lit("a").alias("name"))
    current, history = dimension_tables(spark, folder("late"), base.schema, KEY, 2)
    write = maintaining(current, history, KEY, COLS)

    def at(name, day):
        return F.lit(name).alias("name"), F.lit(DAY[day]).cast("timestamp_ntz").alias("loaded_at")

    write(base.select("id", *at("a", 0)), 0)
    write(base.where("id < 5").select("id", *at("c", 2)), 1)
    before = rows(current.read()), rows(history.read())
    write(base.where("id < 5").select("id", *at("b", 1)), 2)
    assert (rows(current.read()), rows(history.read())) == before
    write(base.where("id >= 5").select("id", *at("b", 1)), 3)  # not late for these
    open_now = history.read().where("is_current").select("id", "name")
    assert rows(open_now) == rows(current.read().select("id", "name"))
    check(history.read())


def test_rows_are_late_by_their_own_time(spark, folder):
    """Keys whose batch also held later rows of other keys; only a row older than its key's own is put aside."""
    fields = spark.createDataFrame([], "id bigint, name string").schema
    current, history = dimension_tables(spark, folder("own"), fields, KEY, 1)
    write = maintaining(current, history, KEY, COLS)

    def batch(n, *rows_):
        df = spark.createDataFrame(rows_, "id bigint, name string, hour int")
        write(df.select("id", "name", F.expr("timestamp_ntz'2024-05-01 00:00:00' + make_dt_interval(0, hour)").alias("loaded_at")), n)

    def names():
        return {r.id: r.name for r in current.read().collect()}

    batch(0, (1, "a", 10), (2, "a", 12))
    batch(1, (1, "b", 11), (3, "a", 12))
    batch(2, (1, "c", 11), (2, "old", 9), (2, "older", 8))
    assert {r.id: r.name for r in current.read().collect()} == {1: "c", 2: "a", 3: "a"}
    assert sorted(r.name for r in spark.read.parquet(folder("own") + "/late").collect()) == ["old", "older"]
    told = history.read().orderBy("id", "start_time").collect()
    assert [(r.id, r.name, r.is_current) for r in told] == [(1, "a", False), (1, "b", False), (1, "c", True), (2, "a", True), (3, "a", True)]
