"""Watermarks and late rows over an ordered multi-batch file stream.

One JSON file per micro-batch, modification times set in batch order;
watermark 3 minutes on t, one-minute tumbling sum of v.
"""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import stream as K
from tidemark.sources.stream import ENVELOPE_SCHEMA, read_envelope_files, stream_files
from tidemark.streaming import events as E
from tidemark.streaming import runner
from tidemark.streaming import transactions as TX

BATCHES = [
    [("a", "00:00:10", 1), ("b", "00:10:00", 2)],
    [("late", "00:01:00", 4), ("c", "00:10:30", 8)],
    [("d", "00:30:00", 16), ("late2", "00:02:00", 32)],
    [("e", "01:00:00", 64), ("a", "00:00:10", 128)],
    [("f", "02:00:00", 256)],
]
SCHEMA = "user string, t timestamp, v long"


def _write_batches(folder):
    os.makedirs(folder)
    base = 1_700_000_000
    for i, rows in enumerate(BATCHES):
        path = f"{folder}/batch-{i}.json"
        with open(path, "w") as fh:
            for user, t, v in rows:
                fh.write(json.dumps({"user": user, "t": f"2024-01-01T{t}Z", "v": v}) + "\n")
        os.utime(path, (base + 10 * i, base + 10 * i))


@pytest.fixture()
def source(spark, tmp):
    folder = f"{tmp}/src"
    _write_batches(folder)
    return stream_files(spark, folder, "json", SCHEMA, max_files_per_trigger=1)


def _minute_sums(df):
    return (df.withWatermark("t", "3 minutes").groupBy(F.window("t", "1 minute"))
            .agg(F.sum("v").alias("total")))


def _as_dict(rows):
    return {r.window.start.strftime("%H:%M"): r.total for r in rows}


def test_append_drops_late_rows_and_keeps_open_window(spark, tmp, source):
    q = K.start_files(_minute_sums(source), f"{tmp}/out", f"{tmp}/ckpt",
                      trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    got = _as_dict(spark.read.parquet(f"{tmp}/out").collect())
    assert got == {"00:00": 1, "00:01": 4, "00:10": 10, "00:30": 16, "01:00": 64}
    dropped = runner.rows_dropped_by_watermark(q)
    assert sum(dropped) == 2
    assert dropped[:4] == [0, 0, 1, 1]


def test_complete_mode_counts_late_rows(spark, source):
    q = K.start_memory(_minute_sums(source), "late_complete", "complete",
                       trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    got = _as_dict(spark.sql("SELECT * FROM late_complete").collect())
    assert got == {"00:00": 129, "00:01": 4, "00:02": 32, "00:10": 10, "00:30": 16,
                   "01:00": 64, "02:00": 256}


def test_update_mode_emits_interim_values(spark, source):
    q = K.start_memory(_minute_sums(source), "late_update", "update",
                       trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    rows = [(r.window.start.strftime("%H:%M"), r.total)
            for r in spark.sql("SELECT * FROM late_update").collect()]
    assert ("00:10", 2) in rows and ("00:10", 10) in rows and ("02:00", 256) in rows
    assert ("00:02", 32) not in rows and ("00:00", 129) not in rows


def test_dedup_with_watermark_drops_late_duplicates(spark, tmp, source):
    out = source.withWatermark("t", "3 minutes").dropDuplicates(["user", "t"])
    q = K.start_files(out, f"{tmp}/out", f"{tmp}/ckpt", trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    users = sorted(r.user for r in spark.read.parquet(f"{tmp}/out").collect())
    assert users == sorted(["a", "b", "c", "late", "d", "e", "f"])


def test_watermark_without_state_drops_nothing(spark, tmp, source):
    q = K.start_files(source.withWatermark("t", "3 minutes"), f"{tmp}/out", f"{tmp}/ckpt",
                      trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    assert spark.read.parquet(f"{tmp}/out").count() == 9


def test_dedup_before_watermark_keeps_late_rows(spark, tmp, source):
    out = E.dedup_unbounded(source, ["user", "t"]).withWatermark("t", "3 minutes")
    q = K.start_files(out, f"{tmp}/out", f"{tmp}/ckpt", trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    users = sorted(r.user for r in spark.read.parquet(f"{tmp}/out").collect())
    assert users == sorted(["a", "b", "c", "late", "d", "late2", "e", "f"])


def test_throttle_one_file_per_batch(spark, tmp, source):
    q = K.start_files(source, f"{tmp}/out", f"{tmp}/ckpt", trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    assert [n for n in runner.input_rows_per_batch(q) if n] == [2, 2, 2, 2, 1]


def test_transaction_stream_keeps_late_records(spark, tmp):
    """Five one-row batches, one 26 minutes late, one copy of the first and one
    reject: each distinct record is published, rejected with its payload or both
    totalled, and the late one is in the totals."""
    rows = [("u1", "00:00:10", 5), ("u2", "00:30:00", 7), ("u3", "00:04:00", 11), ("u1", "00:00:10", 5), ("u4", "01:00:00", -1)]
    src = f"{tmp}/topic"
    for i, (user, t, amount) in enumerate(rows):
        text = json.dumps({"user_id": user, "amount": amount, "timestamp": f"2024-01-01T{t}Z", "source": "web"})
        row = [(None, text.encode(), "transactions", 0, i, None, 0)]
        spark.createDataFrame(row, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    streams = TX.build(read_envelope_files(spark, src, max_files_per_trigger=1))
    for mode in ("update", "complete"):
        out = TX.Outputs(f"{tmp}/{mode}/valid", f"{tmp}/{mode}/dlq", f"{tmp}/{mode}/totals", f"{tmp}/{mode}/ckpt")
        runner.await_all(TX.start(streams, out, trigger=runner.AVAILABLE_NOW, totals_mode=mode))
        assert sorted(r.user_id for r in TX.read_records(spark, out.valid).collect()) == ["u1", "u2", "u3"]
        [bad] = TX.read_records(spark, out.rejected, with_origin=True).collect()
        assert (bad.user_id, bad.error_reason, bad.offset) == ("u4", "amount_negative", 4)
        assert json.loads(bad.raw_value)["amount"] == -1
        assert sorted(r.running_total for r in TX.read_totals(spark, out.totals, mode).collect()) == [5, 7, 11]


def test_append_totals_need_chaining(spark, tmp):
    streams = TX.build(read_envelope_files(spark, tmp))
    out = TX.Outputs(f"{tmp}/valid", f"{tmp}/dlq", f"{tmp}/totals", f"{tmp}/ckpt")
    with pytest.raises(ValueError):
        TX.start(streams, out, totals_mode="append", chain_totals=False)


def test_idle_source_stops_both_queries(spark, tmp):
    os.makedirs(f"{tmp}/empty")
    streams = TX.build(read_envelope_files(spark, f"{tmp}/empty"))
    out = TX.Outputs(f"{tmp}/valid", f"{tmp}/dlq", f"{tmp}/totals", f"{tmp}/ckpt")
    with pytest.raises(TimeoutError):
        TX.start(streams, out, trigger={"processingTime": "1 second"}, first_commit_timeout=3.0)
    assert not spark.streams.active
