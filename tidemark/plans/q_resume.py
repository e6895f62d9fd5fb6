"""Registered queries: streams that stop and resume, one-pass outputs, offset
ranges, progress as a table, and replaced results (A9-A11, B1, B10, I5, I8, I9,
I12-I15, I17).

The resumed queries replay the activity records in event-time order as three runs
of one checkpointed query. A seventh of the records, and every re-delivered one,
arrive one run late, so the watermark that crossed the restart has to judge them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.q_functions import RULES_SQL, TEST_RULES
from tidemark.plans.q_streaming import (
    EVENT_TIME_SQL, FAULT_ROWS_SQL, _activity_static, _envelope_static, _envelope_stream, _minute_total_sql, _run_files,
)
from tidemark.plans.registry import register
from tidemark.session import scratch_path
from tidemark.sinks import stream as K
from tidemark.sinks import versions
from tidemark.sources import stream as SS
from tidemark.sources import tables as T
from tidemark.streaming import events as E
from tidemark.streaming import replay, runner
from tidemark.streaming import transactions as TX

RUNS = 3

# ---------------------------------------------------------------- oracle SQL pieces


def _runs_sql(copies_of=None):
    """Activity rows with the run they arrive in, and the watermark base of each
    run: the newest event time of the runs before it, in whole milliseconds."""
    copies = f"UNION ALL SELECT *, 1 FROM events WHERE event_type = '{copies_of}'" if copies_of else ""
    return f"""
arrived AS (
  SELECT event_id AS "Index", user_id AS "User", event_type AS gt, {EVENT_TIME_SQL} AS event_time,
         LEAST({RUNS - 1}, (epoch_us(ts) - lo) * 1000 * {RUNS} // ((hi - lo) * 1000 + 1)
               + CASE WHEN event_id % 7 = 0 OR again = 1 THEN 1 ELSE 0 END) AS run
  FROM (SELECT *, 0 AS again FROM events {copies}),
       (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)),
seen AS (
  SELECT n AS run, (SELECT date_trunc('milliseconds', max(event_time)) FROM arrived WHERE run < n) AS newest
  FROM range({RUNS + 1}) t(n))"""


WINDOWS_SQL = f"""
WITH {_runs_sql()},
placed AS (
  SELECT run, time_bucket(INTERVAL '5 minutes', event_time) AS ws FROM arrived
  UNION ALL
  SELECT run, time_bucket(INTERVAL '5 minutes', event_time) - INTERVAL '5 minutes' FROM arrived)
SELECT ws AS window_start, ws + INTERVAL '10 minutes' AS window_end, COUNT(*) AS count
FROM placed JOIN seen USING (run)
WHERE newest IS NULL OR ws + INTERVAL '10 minutes' > newest - INTERVAL '30 minutes'
GROUP BY ws
HAVING ws + INTERVAL '10 minutes' <= (SELECT newest - INTERVAL '30 minutes' FROM seen WHERE run = {RUNS})"""

# ---------------------------------------------------------------- runs


def _resumed(spark, sf_dir, name, query_of, sink, output_mode, copies_of=None):
    """Three runs of one query over the ordered activity replay. ``sink`` starts
    it on (frame, output folder, checkpoint); returns the output folder, the
    frame's schema and the ended queries."""
    act = _activity_static(spark, sf_dir).withColumn("again", F.lit(False))
    if copies_of:
        act = act.unionByName(act.where(F.col("gt") == copies_of).withColumn("again", F.lit(True)))
    dealt = replay.in_runs(act, "Creation_Time", RUNS, behind=(F.col("Index") % 7 == 0) | F.col("again"))
    folder, out, ckpt = (scratch_path(spark, f"{name}-{part}") for part in ("in", "out", "ckpt"))
    schema = act.schema

    def frame():
        stream = SS.stream_files(spark, folder, "json", schema)
        return query_of(E.with_event_time_from_ns(stream, "Creation_Time"))

    def start():
        with runner.state_width(spark):
            return sink(frame(), out, ckpt, output_mode)

    ended = replay.run_in_turn(dealt, RUNS, folder, start)
    return out, frame().schema, ended


def _to_files(df, out, ckpt, mode):
    return K.start_files(df, out, ckpt, output_mode=mode, trigger=runner.AVAILABLE_NOW)


def _to_versions(df, out, ckpt, mode):
    return K.start_foreach_batch(df, versions.replace_each_batch(out), ckpt, output_mode=mode, trigger=runner.AVAILABLE_NOW)


def _to_updates(df, out, ckpt, mode):
    return K.start_foreach_batch(df, K.append_updates_each_batch(out), ckpt, output_mode=mode, trigger=runner.AVAILABLE_NOW)


@register("st_resume_counter", 'SELECT user_id AS "User", COUNT(*) AS count FROM events GROUP BY user_id')
def st_resume_counter(spark, sf_dir):
    """Running counter per user over two restarts (B10, I2): the state of the
    runs before is in the checkpoint, so the last counts are whole."""
    out, schema, _ = _resumed(spark, sf_dir, "resume-counter", lambda s: E.count_by(s, ["User"]), _to_updates, "update")
    log = spark.read.schema(f"{schema.toDDL()}, update_batch int").parquet(out)
    return K.latest_state(log, ["User"])


@register(
    "st_resume_tumbling",
    f"""
WITH {_runs_sql()}
SELECT time_bucket(INTERVAL '10 minutes', event_time) AS window_start,
       time_bucket(INTERVAL '10 minutes', event_time) + INTERVAL '10 minutes' AS window_end, COUNT(*) AS count
FROM arrived GROUP BY 1, 2""",
)
def st_resume_tumbling(spark, sf_dir):
    """Tumbling windows in complete mode over two restarts (I5): late rows count,
    and each batch's whole result is the next version of the table."""
    count = lambda s: E.windowed_count(s, "event_time", "10 minutes")
    out, schema, _ = _resumed(spark, sf_dir, "resume-tumbling", count, _to_versions, "complete")
    return versions.read(spark, out, schema)


@register("st_resume_watermark_append", WINDOWS_SQL)
def st_resume_watermark_append(spark, sf_dir):
    """Sliding windows written once, over two restarts (I8): a late row counts in
    those of its windows that were still open when its run began."""
    count = lambda s: E.windowed_count(s, "event_time", "10 minutes", "5 minutes", watermark="30 minutes")
    out, schema, _ = _resumed(spark, sf_dir, "resume-append", count, _to_files, "append")
    return spark.read.schema(schema).parquet(out)


def _dedup(stream):
    return E.dedup_then_count(stream, "User", "event_time", "6 hours")


@register(
    "st_resume_dedup",
    f"""
WITH {_runs_sql("purchase")}
SELECT "User", COUNT(*) AS count FROM (
  SELECT DISTINCT "User", event_time FROM arrived JOIN seen USING (run)
  WHERE newest IS NULL OR event_time > newest - INTERVAL '6 hours')
GROUP BY "User" """,
)
def st_resume_dedup(spark, sf_dir):
    """De-duplication on (user, event time) over two restarts (I9): copies of an
    earlier run are known from the checkpoint or behind the watermark."""
    out, schema, _ = _resumed(spark, sf_dir, "resume-dedup", _dedup, _to_versions, "complete", copies_of="purchase")
    return versions.read(spark, out, schema)


@register(
    "st_progress",
    f"""
WITH {_runs_sql("purchase")}
SELECT CAST(run AS INTEGER) AS run, COUNT(*) AS input_rows,
       CAST(SUM(CASE WHEN event_time <= newest - INTERVAL '6 hours' THEN 1 ELSE 0 END) AS BIGINT) AS dropped_rows
FROM arrived JOIN seen USING (run) GROUP BY run""",
)
def st_progress(spark, sf_dir):
    """Input rows and late rows dropped in each run of the de-duplicating query,
    as its listener wrote them (I15, I17)."""
    path = scratch_path(spark, "progress")
    with runner.progress_table(spark, path, every=4):
        _, _, ended = _resumed(spark, sf_dir, "progress", _dedup, _to_versions, "complete", copies_of="purchase")
    table = spark.read.schema(runner.ProgressTable.SCHEMA).parquet(path).where(F.col("query_id") == str(ended[0].id))
    return table.groupBy("run").agg(F.sum("input_rows").alias("input_rows"), F.sum("dropped_rows").alias("dropped_rows"))


# ---------------------------------------------------------------- one pass, offsets, replaced results

ALL_FAULTS_SQL = f"""
SELECT * FROM ({FAULT_ROWS_SQL}) UNION ALL SELECT * FROM ({FAULT_ROWS_SQL}) WHERE made_of = 'purchase'"""


def _one_pass(spark, sf_dir):
    path, ckpt = scratch_path(spark, "one-pass"), scratch_path(spark, "one-pass-ckpt")
    with runner.state_width(spark):
        query = TX.start_one_pass(_envelope_stream(spark, sf_dir, faults=True), path, ckpt, TEST_RULES, runner.AVAILABLE_NOW)
    runner.await_all([query])
    return path


@register(
    "st_split",
    f"""
SELECT 'valid' AS target, user_id, amount, "timestamp", source, NULL AS error_reason FROM (
  SELECT DISTINCT user_id, amount, "timestamp", source FROM ({FAULT_ROWS_SQL}) WHERE ({RULES_SQL}) IS NULL)
UNION ALL
SELECT 'dlq', user_id, amount, "timestamp", source, error_reason FROM (
  SELECT *, {RULES_SQL} AS error_reason FROM ({ALL_FAULTS_SQL})) WHERE error_reason IS NOT NULL""",
)
def st_split(spark, sf_dir):
    """Valid records and rejects of one query that reads the raw topic once; both
    outputs of a batch become visible together (I12)."""
    path = _one_pass(spark, sf_dir)
    rows = [TX.read_one_pass(spark, path, out).withColumn("target", F.lit(name)) for out, name in ((TX.VALID, "valid"), (TX.REJECTED, "dlq"))]
    return rows[0].unionByName(rows[1])


@register("st_one_pass_totals", _minute_total_sql(
    f'SELECT DISTINCT user_id, "timestamp", amount, event_time FROM ({FAULT_ROWS_SQL}) WHERE ({RULES_SQL}) IS NULL'))
def st_one_pass_totals(spark, sf_dir):
    """Minute totals of the same query (I13, I14): sums of each batch, added up."""
    return TX.read_one_pass(spark, _one_pass(spark, sf_dir), TX.TOTALS)


@register(
    "src_topic_offsets",
    """
SELECT 'transactions' AS topic, CAST(user_id % 3 AS INTEGER) AS partition, event_id AS "offset", CAST(user_id AS VARCHAR) AS "key"
FROM events WHERE (user_id % 3 = 0 AND event_id >= 100) OR (user_id % 3 = 1 AND event_id < 5000)""",
)
def src_topic_offsets(spark, sf_dir):
    """Two partitions of a topic between given offsets, as a stream with their
    place in the topic (A9-A11); the third partition isn't read."""
    path = scratch_path(spark, "topic")
    _envelope_static(spark, sf_dir, copies_of=None).write.parquet(path)
    topic = SS.read_envelope_files(spark, path)
    part = SS.offset_range(
        topic, {"transactions": {0: 100, 1: SS.EARLIEST}}, {"transactions": {0: SS.LATEST, 1: 5000}}
    )
    out = part.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"))
    return _run_files(spark, out, "topic-range")


@register("sink_replace_table", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'")
def sink_replace_table(spark, sf_dir):
    """A table whose result is replaced, read while it holds rows of the former
    one (B1): readers see the newest committed version only."""
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "replaced")
    versions.publish(orders, path)
    kept = versions.read(spark, path, orders.schema).where(F.col("o_orderstatus") != "O")
    versions.publish(kept, path)
    return versions.read(spark, path, orders.schema)
