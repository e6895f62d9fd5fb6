"""Versioned results, one-pass outputs, streams that stop and resume, progress as
a table, offset ranges, and running totals without a one-task window."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import validation as V
from tidemark.operators import windows as W
from tidemark.sinks import stream as K
from tidemark.sinks import versions
from tidemark.sources import stream as SS
from tidemark.streaming import events as E
from tidemark.streaming import replay, runner
from tidemark.streaming import transactions as TX

# ---------------------------------------------------------------- versions


def values(df):
    return sorted(r[0] for r in df.collect())


def failing(spark):
    """Rows of which the last partition's fail when they are written."""
    row = F.when(F.col("id") > 90, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return spark.range(0, 100, 1, 4).select(row.cast("long").alias("id"))


def test_a_write_that_dies_midway_leaves_the_former_result(spark, tmp):
    path = f"{tmp}/table"
    assert versions.newest(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    assert versions.publish(spark.range(3), path) == 0
    with pytest.raises(PySparkException):
        versions.publish(failing(spark), path)
    assert versions.newest(spark, path) == 0 and values(versions.read(spark, path)) == [0, 1, 2]
    assert versions.publish(spark.range(5, 7), path) == 1  # over what the failed write left
    assert values(versions.read(spark, path)) == [5, 6]
    assert values(versions.read(spark, path, "id long", version=0)) == [0, 1, 2]


def test_data_without_a_commit_are_not_seen(spark, tmp):
    path = f"{tmp}/table"
    versions.publish(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}/data/version=1")  # the driver died before the commit
    assert values(versions.read(spark, path)) == [0, 1, 2]
    versions.publish(spark.range(4), path, version=1)
    assert values(versions.read(spark, path)) == [0, 1, 2, 3]


def test_a_committed_version_is_not_written_again(spark, tmp):
    path = f"{tmp}/table"
    write = versions.replace_each_batch(path)
    write(spark.range(2), 0)
    write(spark.range(3), 1)
    write(failing(spark), 1)  # a batch run again after a restart: not even computed
    assert versions.publish(spark.range(8), path, version=0) == 1
    assert values(versions.read(spark, path)) == [0, 1, 2]


def test_old_versions_are_deleted_but_for_the_kept(spark, tmp):
    path = f"{tmp}/table"
    for k in range(5):
        versions.publish(spark.range(k), path, keep=2)
    assert sorted(os.listdir(f"{path}/data")) == ["version=3", "version=4"]
    assert versions.retire(spark, path, 1) == [3] and values(versions.read(spark, path)) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        versions.retire(spark, path, 0)


def test_outputs_of_a_batch_become_visible_together(spark, tmp):
    path = f"{tmp}/split"
    rows = spark.createDataFrame([(1, True), (2, False), (3, True)], "id long, ok boolean")
    good = {"yes": lambda b: b.where("ok").select("id"), "no": lambda b: b.where("NOT ok").select("id")}
    versions.split_each_batch(path, good)(rows, 0)

    def lost(batch):
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        versions.split_each_batch(path, {"yes": good["yes"], "no": lost})(rows, 1)
    seen = lambda name: sorted((r.id, r.batch) for r in versions.read_output(spark, path, name, "id long").collect())
    assert seen("yes") == [(1, 0), (3, 0)] and seen("no") == [(2, 0)]
    versions.split_each_batch(path, good)(rows, 1)
    versions.split_each_batch(path, good)(rows, 1)
    assert seen("yes") == [(1, 0), (1, 1), (3, 0), (3, 1)] and seen("no") == [(2, 0), (2, 1)]


# ---------------------------------------------------------------- one pass


def test_one_pass_reads_the_topic_once_and_routes_every_record(spark, tmp):
    def record(k, **change):
        body = {"user_id": f"u{k}", "amount": 100, "timestamp": f"2024-01-01T00:0{k % 3}:00.000000", "source": "web"} | change
        return json.dumps({a: b for a, b in body.items() if b is not None})

    good = [record(k) for k in range(6)]
    bad = [record(1, amount=-1), record(1, amount=-1), record(2, source=None), record(3, timestamp="x"), "{bad", "{bad"]
    payloads = good + good[:2] + bad
    now = dt.datetime(2024, 1, 1)
    for part in range(2):
        rows = [(b"k", p.encode(), "t", 0, i, now, 0) for i, p in enumerate(payloads) if i % 2 == part]
        spark.createDataFrame(rows, SS.ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp}/topic")
    topic = SS.read_envelope_files(spark, f"{tmp}/topic", max_files_per_trigger=1)
    with runner.state_width(spark, 2):
        q = TX.start_one_pass(topic, f"{tmp}/out", f"{tmp}/ckpt", V.Rules(), runner.AVAILABLE_NOW)
    runner.await_all([q])
    assert sum(runner.input_rows_per_batch(q)) == len(payloads)
    valid = TX.read_one_pass(spark, f"{tmp}/out", TX.VALID).collect()
    assert sorted(r.user_id for r in valid) == [f"u{k}" for k in range(6)]
    reasons = sorted(r.error_reason for r in TX.read_one_pass(spark, f"{tmp}/out", TX.REJECTED).collect())
    assert reasons == ["amount_negative"] * 2 + ["invalid_source", "invalid_timestamp"] + ["missing_user_id"] * 2
    totals = {r.window_start.minute: r.running_total for r in TX.read_one_pass(spark, f"{tmp}/out", TX.TOTALS).collect()}
    assert totals == {0: 200, 1: 200, 2: 200}


def test_one_pass_in_the_reference_order_of_steps(spark, tmp):
    rows = [(b"k", b"{bad", "t", 0, i, dt.datetime(2024, 1, 1), 0) for i in range(4)]
    spark.createDataFrame(rows, SS.ENVELOPE_SCHEMA).write.parquet(f"{tmp}/topic")
    with runner.state_width(spark, 2):
        q = TX.start_one_pass(SS.read_envelope_files(spark, f"{tmp}/topic"), f"{tmp}/out", f"{tmp}/ckpt",
                              V.Rules(mode="compat"), runner.AVAILABLE_NOW)
    runner.await_all([q])
    assert TX.read_one_pass(spark, f"{tmp}/out", TX.REJECTED).count() == 1  # malformed rows are one
    assert TX.read_one_pass(spark, f"{tmp}/out", TX.VALID).count() == 0
    assert TX.read_one_pass(spark, f"{tmp}/out", TX.TOTALS).count() == 0


# ---------------------------------------------------------------- stop and resume, progress


def test_windows_over_a_restart_judge_late_rows_by_the_saved_watermark(spark, tmp):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    runs = [[(at(1),), (at(2),), (at(40),)], [(at(3),), (at(25),), (at(59),)]]  # 3 is behind 40 - 10, 25 in no open window

    def start():
        s = SS.stream_files(spark, f"{tmp}/src", "json", "t timestamp")
        agg = E.windowed_count(s, "t", "10 minutes", watermark="10 minutes")
        with runner.state_width(spark, 2):
            return K.start_files(agg, f"{tmp}/out", f"{tmp}/ckpt", trigger=runner.AVAILABLE_NOW)

    rows = [(t, k) for k, run in enumerate(runs) for (t,) in run]
    dealt = spark.createDataFrame(rows, f"t timestamp, {replay.RUN} int")
    with runner.progress_table(spark, f"{tmp}/progress", every=1):
        ended = replay.run_in_turn(dealt, 2, f"{tmp}/src", start)
    got = {r.window_start.minute: r["count"] for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert got == {0: 2}  # minute 20's window ended at the watermark; 40's is not over yet
    assert ended[0].id == ended[1].id and ended[0].runId != ended[1].runId
    table = spark.read.schema(runner.ProgressTable.SCHEMA).parquet(f"{tmp}/progress")
    by_run = {r.run: (r.n, r.late) for r in table.groupBy("run").agg(F.sum("input_rows").alias("n"), F.sum("dropped_rows").alias("late")).collect()}
    assert by_run == {0: (3, 0), 1: (3, 2)}
    assert table.where("batch_id = 0").count() == 1


def test_progress_of_a_failing_query_is_written_and_the_listener_removed(spark, tmp):
    spark.range(3).write.json(f"{tmp}/src")
    with runner.progress_table(spark, f"{tmp}/progress"):
        s = SS.stream_files(spark, f"{tmp}/src", "json", "id long")
        q = K.start_foreach_batch(s.groupBy().count(), lambda b, i: b.write.parquet(f"{tmp}/out/{i}"), f"{tmp}/ckpt",
                                  "complete", runner.AVAILABLE_NOW)
        runner.await_all([q])
        bad = K.start_foreach_batch(s.select(F.raise_error(F.lit("no")).alias("x")), lambda b, i: b.write.parquet(f"{tmp}/bad"),
                                    f"{tmp}/ckpt2", trigger=runner.AVAILABLE_NOW)
        with pytest.raises(Exception, match="no"):
            runner.await_all([bad])
    rows = spark.read.schema(runner.ProgressTable.SCHEMA).parquet(f"{tmp}/progress").where("input_rows > 0").collect()
    assert [(r.query_id, r.input_rows) for r in rows] == [(str(q.id), 3)]


def test_runs_are_dealt_by_range_with_late_rows_one_run_behind(spark):
    df = spark.createDataFrame([(k, k % 10 == 0) for k in range(100)] + [(None, False)], "t long, late boolean")
    got = {r.t: r[replay.RUN] for r in replay.in_runs(df, "t", 4, F.col("late")).collect()}
    assert got[None] == 0
    assert all(got[k] == min(3, k * 4 // 100 + (k % 10 == 0)) for k in range(100))
    empty = spark.createDataFrame([], "t long")
    assert replay.in_runs(empty, "t", 4).collect() == []


# ---------------------------------------------------------------- offset ranges


def test_offset_ranges_of_a_topic(spark, tmp):
    rows = [(None, b"v", t, p, o, None, 0) for t in "ab" for p in range(3) for o in range(10)] + [(None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SS.ENVELOPE_SCHEMA)
    df.write.parquet(f"{tmp}/topic")
    starting, ending = {"a": {0: 7, 2: SS.EARLIEST}, "b": {1: 4}}, {"a": {2: 2, 0: SS.LATEST}}
    want = [("a", 0, 7), ("a", 0, 8), ("a", 0, 9), ("a", 2, 0), ("a", 2, 1), *(("b", 1, o) for o in range(4, 10))]
    for frame in (df, spark.read.schema(SS.ENVELOPE_SCHEMA).parquet(f"{tmp}/topic")):
        assert sorted((r.topic, r.partition, r.offset) for r in SS.offset_range(frame, starting, ending).collect()) == want
    assert SS.offset_range(df, {}).count() == 0
    with pytest.raises(ValueError):
        SS.offset_range(df, {"a": {0: SS.LATEST}})
    with pytest.raises(ValueError):
        SS.offset_range(df, {"a": {0: 1}}, {"a": {0: SS.EARLIEST}})
    options = SS.kafka_range_options("b:9092", starting, ending)
    assert json.loads(options["startingOffsets"]) == {"a": {"0": 7, "2": -2}, "b": {"1": 4}}
    assert json.loads(options["endingOffsets"]) == {"a": {"0": -1, "2": 2}, "b": {"1": -1}}
    assert json.loads(options["assign"]) == {"a": [0, 2], "b": [1]}


def test_the_position_in_a_range_is_kept_in_the_checkpoint(spark, tmp):
    add = lambda offsets: spark.createDataFrame(
        [(None, b"v", "t", 0, o, None, 0) for o in offsets], SS.ENVELOPE_SCHEMA).write.mode("append").parquet(f"{tmp}/topic")

    def run():
        topic = SS.offset_range(SS.read_envelope_files(spark, f"{tmp}/topic"), {"t": {0: 2}}, {"t": {0: 9}})
        runner.await_all([K.start_files(topic.select("offset"), f"{tmp}/out", f"{tmp}/ckpt", trigger=runner.AVAILABLE_NOW)])
        return values(spark.read.schema("offset long").parquet(f"{tmp}/out"))

    add(range(5))
    assert run() == [2, 3, 4]
    add(range(5, 12))
    assert run() == [2, 3, 4, 5, 6, 7, 8]
    assert run() == [2, 3, 4, 5, 6, 7, 8]


# ---------------------------------------------------------------- totals and positions over sort partitions


def test_running_total_is_exact_over_a_million_keys(spark):
    df = spark.range(0, 1_000_000, 1, 8).select((F.col("id") * 7919 % 1_000_003).alias("k"), F.expr("CAST(id % 1000 AS DECIMAL(18,2))").alias("v"))
    out = W.running_total(df, "k", "v", "total")
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = out.agg(F.count("*"), F.max("total"), F.sum("total")).first()
    running, total = 0, 0
    for k, v in sorted(((i * 7919 % 1_000_003), i % 1000) for i in range(1_000_000)):
        running += v
        total += running
    assert (got[0], int(got[1]), int(got[2])) == (1_000_000, running, total)
    # one-task exchanges see one row per sort partition, never the rows themselves
    for at in [i for i, line in enumerate(plan.splitlines()) if "SinglePartition" in line]:
        assert "HashAggregate" in plan.splitlines()[at + 1]


def test_running_total_with_ties_nulls_and_a_hot_order_value(spark):
    rnd = random.Random(1)
    rows = [(7 if rnd.random() < 0.4 else rnd.choice([None, *range(30)]), rnd.choice([None, 1, 2, 3])) for _ in range(3000)]
    got = W.running_total(spark.createDataFrame(rows, "k int, v int").repartition(5), "k", "v", "total").collect()
    assert sorted((r.k is not None, r.k, r.v is not None, r.v) for r in got) == sorted((k is not None, k, v is not None, v) for k, v in rows)
    by_key, before = {}, 0
    for k in [None, *range(30)]:
        mine = [r for r in got if r.k == k]
        values_ = [v for kk, v in rows if kk == k and v is not None]
        by_key[k] = [r.total for r in mine if r.total is not None]
        # totals inside a key run from what came before to that plus the key's sum
        if by_key[k]:
            assert max(by_key[k]) == before + sum(values_) and min(by_key[k]) >= before
        before += sum(values_)
    assert W.running_total(spark.createDataFrame([], "k int, v int"), "k", "v", "total").collect() == []
    keyed = W.running_total(spark.createDataFrame([("a", 1, 2), ("b", 1, 5), ("a", 2, 3)], "g string, k int, v int"), "k", "v", "total", ["g"])
    assert sorted((r.g, r.total) for r in keyed.collect()) == [("a", 2), ("a", 5), ("b", 5)]


def test_global_position_is_row_number(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 31 % 97).alias("a"), "id")
    got = {r.id: r.position for r in W.global_position(df, [F.col("a").desc(), F.col("id").asc()]).collect()}
    want = sorted(range(5000), key=lambda i: (-(i * 31 % 97), i))
    assert all(got[i] == n for n, i in enumerate(want, 1))
