"""Registered queries: Structured Streaming jobs (A7, A12, G3, I1-I14, B3, B4,
B8-B10 in durable form).

Each query replays data derived from the test tables as a file stream into
the shared checkpoint folder, runs the streaming job to completion with
``trigger(availableNow=True)``, and returns the job's durable output read
back as a table. Sinks are Parquet/``foreachBatch`` writes (exactly once,
restartable from the checkpoint), never the driver-side memory sink.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import money
from tidemark.operators import validation as V
from tidemark.plans.q_functions import RULES_SQL, TEST_RULES
from tidemark.plans.registry import register
from tidemark.session import scratch_path
from tidemark.sinks import stream as K
from tidemark.sinks import versions
from tidemark.sources import stream as SS
from tidemark.sources import tables as T
from tidemark.streaming import events as E
from tidemark.streaming import replay, runner
from tidemark.streaming import transactions as TX

#: Files of a replay at least, and micro-batches of one that is throttled.
REPLAY_FILES = 8

# ---------------------------------------------------------------- oracle SQL pieces

# event time as the stream derives it from a nanosecond epoch
EVENT_TIME_SQL = (
    "make_timestamp(CAST(trunc(CAST(epoch_us(ts) * 1000 AS DOUBLE) / 1000000000 * 1000000) AS BIGINT))"
)
ACTIVITY_SQL = f"""
SELECT event_id AS "Index", user_id AS "User", event_type AS gt, value, {EVENT_TIME_SQL} AS event_time
FROM events"""

SLIDING_SQL = f"""
SELECT ws AS window_start, ws + INTERVAL '10 minutes' AS window_end, COUNT(*) AS count FROM (
  SELECT time_bucket(INTERVAL '5 minutes', event_time) AS ws FROM ({ACTIVITY_SQL})
  UNION ALL
  SELECT time_bucket(INTERVAL '5 minutes', event_time) - INTERVAL '5 minutes' FROM ({ACTIVITY_SQL}))
GROUP BY ws"""


# ---------------------------------------------------------------- replays


def _activity_static(spark, sf_dir, copies_of: str | None = None):
    """Activity records (reference shape) derived from ``events``; with
    ``copies_of`` the rows of that event type appear twice (re-delivered)."""
    ev = T.table(spark, sf_dir, "events")
    ns = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                          F.col("ts")) * 1000
    act = ev.select(
        F.col("event_id").alias("Index"), ns.alias("Creation_Time"),
        F.col("user_id").alias("User"), F.col("event_type").alias("gt"), "value",
    )
    if copies_of:
        act = act.unionByName(act.where(F.col("gt") == copies_of))
    return act


def _replay(spark, static, name, fmt, batches=None):
    """Write a replay's files (one parallel write, rows dealt at random) and
    return its folder and the files of a micro-batch, or None for all in one."""
    path = scratch_path(spark, name)
    n_files = replay.files_for(static, REPLAY_FILES)
    static.repartition(n_files).write.format(fmt).save(path)
    return path, batches and -(-n_files // batches)


def _activity_stream(spark, sf_dir, batches=None, copies_of=None):
    """The replay as a file stream of so many micro-batches. A file stream needs
    an explicit schema; it is the declared schema of the frame written, so no
    inference pass reads the replay (``src_json_dir`` shows the inferred form,
    A3). Without ``batches`` all comes in one; ``q_resume`` has the queries whose
    result depends on arrival order, over several runs."""
    static = _activity_static(spark, sf_dir, copies_of)
    path, max_files = _replay(spark, static, "activity-json", "json", batches)
    stream = SS.stream_files(spark, path, "json", static.schema, max_files_per_trigger=max_files)
    return E.with_event_time_from_ns(stream, "Creation_Time")


def _run_files(spark, df, name, output_mode="append"):
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    with runner.state_width(spark):
        q = K.start_files(df, out, ckpt, output_mode=output_mode, trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    return spark.read.schema(df.schema).parquet(out)


def _run_complete(spark, df, name):
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    with runner.state_width(spark):
        q = K.start_foreach_batch(df, versions.replace_each_batch(out), ckpt,
                                  output_mode="complete", trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    return versions.read(spark, out, df.schema)


def _run_update(spark, df, name, keys):
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    with runner.state_width(spark):
        q = K.start_foreach_batch(df, K.append_updates_each_batch(out), ckpt,
                                  output_mode="update", trigger=runner.AVAILABLE_NOW)
    runner.await_all([q])
    log = spark.read.schema(f"{df.schema.toDDL()}, update_batch int").parquet(out)
    return K.latest_state(log, keys)


# ---------------------------------------------------------------- queries


@register(
    "src_stream_json",
    'SELECT event_id AS "Index", user_id AS "User", event_type AS gt, value FROM events',
)
def src_stream_json(spark, sf_dir):
    """Throttled JSON file stream, one file per micro-batch, appended to Parquet."""
    s = _activity_stream(spark, sf_dir, batches=8)
    return _run_files(spark, s.select("Index", "User", "gt", "value"), "src-stream-json")


@register(
    "st_count_by_key",
    "SELECT event_type AS gt, COUNT(*) AS count FROM events GROUP BY event_type",
)
def st_count_by_key(spark, sf_dir):
    s = _activity_stream(spark, sf_dir, batches=4)
    return _run_complete(spark, E.count_by(s, ["gt"]), "count-by-key")


@register(
    "st_user_counter",
    'SELECT user_id AS "User", COUNT(*) AS count FROM events GROUP BY user_id',
)
def st_user_counter(spark, sf_dir):
    """Running per-user counter in update mode; the sink keeps an update log
    and the end state is its newest row per user."""
    s = _activity_stream(spark, sf_dir, batches=8)
    return _run_update(spark, E.count_by(s, ["User"]), "user-counter", ["User"])


@register(
    "st_filter_project",
    f"""SELECT gt, "User", event_time, value FROM ({ACTIVITY_SQL})
WHERE gt LIKE '%ic%' AND gt IS NOT NULL""",
)
def st_filter_project(spark, sf_dir):
    s = _activity_stream(spark, sf_dir, batches=8)
    out = E.pattern_filter(s, "gt", "%ic%", ("gt", "User", "event_time", "value"))
    return _run_files(spark, out, "filter-project")


@register(
    "st_cube",
    """
SELECT gt, "User", avg("Index") AS "avg_Index", avg("User") AS "avg_User",
       CAST(SUM(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / COUNT(value) AS avg_value
FROM (SELECT event_id AS "Index", user_id AS "User", event_type AS gt, value FROM events)
GROUP BY CUBE (gt, "User")""",
)
def st_cube(spark, sf_dir):
    """Streaming cube over (gt, User): mean of every numeric column."""
    s = _activity_stream(spark, sf_dir, batches=4)
    s = s.select("gt", "User", "Index", money("value").alias("value"))
    return _run_complete(spark, E.device_cube(s, ["gt", "User"]), "cube")


@register(
    "st_tumbling",
    f"""
SELECT time_bucket(INTERVAL '10 minutes', event_time) AS window_start,
       time_bucket(INTERVAL '10 minutes', event_time) + INTERVAL '10 minutes' AS window_end,
       COUNT(*) AS count
FROM ({ACTIVITY_SQL}) GROUP BY 1, 2""",
)
def st_tumbling(spark, sf_dir):
    s = _activity_stream(spark, sf_dir, batches=4)
    return _run_complete(spark, E.windowed_count(s, "event_time", "10 minutes"), "tumbling")


@register("st_sliding", SLIDING_SQL)
def st_sliding(spark, sf_dir):
    s = _activity_stream(spark, sf_dir, batches=4)
    return _run_complete(
        spark, E.windowed_count(s, "event_time", "10 minutes", "5 minutes"), "sliding"
    )


@register("st_watermark_complete", SLIDING_SQL)
def st_watermark_complete(spark, sf_dir):
    """Watermark + sliding windows in complete mode: nothing is dropped and
    no state is freed (complete mode keeps every window)."""
    s = _activity_stream(spark, sf_dir, batches=4)
    agg = E.windowed_count(s, "event_time", "10 minutes", "5 minutes", watermark="30 minutes")
    return _run_complete(spark, agg, "watermark-complete")


@register(
    "st_watermark_append",
    f"""
SELECT * FROM ({SLIDING_SQL})
WHERE window_end <= (SELECT max(event_time) - INTERVAL '30 minutes' FROM ({ACTIVITY_SQL}))""",
)
def st_watermark_append(spark, sf_dir):
    """Append mode: each window is written once, when the watermark (max event
    time - 30 min) passes its end; windows still open at the end stay out."""
    s = _activity_stream(spark, sf_dir)
    agg = E.windowed_count(s, "event_time", "10 minutes", "5 minutes", watermark="30 minutes")
    return _run_files(spark, agg, "watermark-append")


@register(
    "st_dedup_watermark",
    f"""SELECT "User", COUNT(*) AS count FROM (SELECT DISTINCT "User", event_time FROM ({ACTIVITY_SQL}))
GROUP BY "User" """,
)
def st_dedup_watermark(spark, sf_dir):
    """Purchase events are delivered twice; dedup on (User, event_time) under
    a 5-second watermark, then count per user (complete mode)."""
    s = _activity_stream(spark, sf_dir, copies_of="purchase")
    return _run_complete(spark, E.dedup_then_count(s, "User", "event_time", "5 seconds"),
                         "dedup-watermark")


# ---------------------------------------------------------------- transactions


def _envelope_static(spark, sf_dir, copies_of="purchase"):
    """Kafka-envelope rows for the transaction topic, derived from events;
    the ``copies_of`` records are re-delivered (same payload, new offset)."""
    tx = T.transactions(spark, sf_dir)
    payload = F.to_json(F.struct("user_id", "amount", "timestamp", "source"))
    env = tx.select(
        F.col("user_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        F.pmod(F.col("user_id").cast("long"), F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.to_timestamp("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.col("source").alias("_source"),
    )
    if copies_of:
        again = env.where(F.col("_source") == copies_of).withColumn(
            "offset", F.col("offset") + F.lit(1 << 40)
        )
        env = env.unionByName(again)
    return env.drop("_source")


def _with_faults(env):
    """Every kind of broken record, chosen by the event id: missing user, amount
    and timestamp, unparseable timestamp, negative and too large amount, null
    source, malformed JSON (16 classes, half of them left whole)."""
    kind = F.pmod(F.col("offset"), F.lit(16))
    rec = F.from_json(F.col("value").cast("string"), V.TRANSACTION_SCHEMA)
    broken = F.struct(
        F.when(kind != 0, rec["user_id"]).alias("user_id"),
        F.when(kind == 4, -rec["amount"]).when(kind == 5, rec["amount"] + 20000000)
        .when(kind != 1, rec["amount"]).alias("amount"),
        F.when(kind == 3, F.concat(F.lit("bad-"), F.pmod(F.col("offset"), F.lit(1 << 40)).cast("string")))
        .when(kind != 2, rec["timestamp"]).alias("timestamp"),
        F.when(kind != 6, rec["source"]).alias("source"),
    )
    text = F.when(kind == 7, F.lit("{bad")).otherwise(F.to_json(broken))
    return env.withColumn("value", text.cast("binary"))


def _envelope_stream(spark, sf_dir, faults=False):
    """The topic as a file stream of several micro-batches. Its files are dealt
    at random, so most rows of the later batches are older than the newest event
    time seen, far beyond any watermark on it."""
    env = _envelope_static(spark, sf_dir)
    path, max_files = _replay(spark, _with_faults(env) if faults else env, "tx-envelope", "parquet", batches=4)
    return SS.read_envelope_files(spark, path, max_files_per_trigger=max_files)


def _run_transactions(spark, sf_dir, rules=TEST_RULES, faults=False, totals_mode="update"):
    streams = TX.build(_envelope_stream(spark, sf_dir, faults=faults), rules)
    out = TX.Outputs(
        valid=scratch_path(spark, "tx-valid"), rejected=scratch_path(spark, "tx-dlq"),
        totals=scratch_path(spark, "tx-totals"), checkpoint=scratch_path(spark, "tx-ckpt"),
    )
    with runner.state_width(spark):
        queries = TX.start(streams, out, trigger=runner.AVAILABLE_NOW, totals_mode=totals_mode)
    runner.await_all(queries)
    return out


TX_SQL = """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, CAST(round(value * 100) AS INTEGER) AS amount,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", event_type AS source, ts AS event_time
FROM events"""


@register(
    "st_dedup_unbounded",
    f'SELECT user_id, amount, "timestamp", source FROM ({TX_SQL})',
)
def st_dedup_unbounded(spark, sf_dir):
    """dropDuplicates on (user_id, timestamp text) with no watermark."""
    tx = TX.decode(_envelope_stream(spark, sf_dir))
    out = E.dedup_unbounded(tx, ["user_id", "timestamp"])
    return _run_files(spark, out, "dedup-unbounded")


@register(
    "st_dedup_within_watermark",
    f'SELECT user_id, amount, "timestamp", source FROM ({TX_SQL})',
)
def st_dedup_within_watermark(spark, sf_dir):
    """Bounded-state form of I10: copies within an hour of processing time,
    over several micro-batches with late rows."""
    tx = TX.decode(_envelope_stream(spark, sf_dir))
    return _run_files(spark, E.dedup_on_arrival(tx, ["user_id", "timestamp"], "1 hour"),
                      "dedup-within-watermark")


# rejects are not de-duplicated in strict mode: count the re-delivered ones too
TX_ALL_SQL = """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(round(value * 100) AS INTEGER) AS amount,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", event_type AS source, ts AS event_time
FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'purchase')"""


@register(
    "st_tx_valid",
    f"""SELECT user_id, amount, "timestamp", source FROM ({TX_SQL}) WHERE ({RULES_SQL}) IS NULL""",
)
def st_tx_valid(spark, sf_dir):
    """Valid, de-duplicated records published by the transaction stream."""
    out = _run_transactions(spark, sf_dir)
    return TX.read_records(spark, out.valid).select("user_id", "amount", "timestamp", "source")


@register(
    "st_tx_dlq",
    f"""SELECT user_id, amount, "timestamp", source, error_reason FROM (
  SELECT *, {RULES_SQL} AS error_reason FROM ({TX_ALL_SQL})) WHERE error_reason IS NOT NULL""",
)
def st_tx_dlq(spark, sf_dir):
    """Rejected records with their reason on the dead-letter output."""
    out = _run_transactions(spark, sf_dir)
    return TX.read_records(spark, out.rejected)


def _minute_total_sql(valid_rows):
    return f"""
SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start,
       time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end,
       CAST(SUM(amount) AS BIGINT) AS running_total
FROM ({valid_rows}) WHERE event_time IS NOT NULL GROUP BY 1, 2"""


@register("st_tx_minute_total", _minute_total_sql(f"SELECT * FROM ({TX_SQL}) WHERE ({RULES_SQL}) IS NULL"))
def st_tx_minute_total(spark, sf_dir):
    """Per-minute totals of all valid amounts, late ones too, from the update
    log of the totals (I13)."""
    out = _run_transactions(spark, sf_dir)
    return TX.read_totals(spark, out.totals)


# ---------------------------------------------------------------- broken records, both modes

COMPAT_RULES = V.Rules(sources=T.TEST_SOURCES, max_amount=T.TEST_MAX_AMOUNT, mode="compat")

FAULT_ROWS_SQL = """
SELECT CASE WHEN k NOT IN (0, 7) THEN user_id END AS user_id,
       CASE WHEN k = 4 THEN -amount WHEN k = 5 THEN amount + 20000000 WHEN k NOT IN (1, 7) THEN amount END AS amount,
       CASE WHEN k = 3 THEN 'bad-' || event_id WHEN k NOT IN (2, 7) THEN "timestamp" END AS "timestamp",
       CASE WHEN k NOT IN (6, 7) THEN source END AS source,
       CASE WHEN k NOT IN (2, 3, 7) THEN ts END AS event_time, source AS made_of
FROM (SELECT event_id, event_id % 16 AS k, ts, CAST(user_id AS VARCHAR) AS user_id,
             CAST(round(value * 100) AS INTEGER) AS amount,
             strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", event_type AS source FROM events)"""

# compat: no rule for an unparseable timestamp, and a null source passes
COMPAT_RULES_SQL = f"""
CASE WHEN user_id IS NULL THEN 'missing_user_id'
     WHEN amount IS NULL THEN 'missing_amount'
     WHEN "timestamp" IS NULL THEN 'missing_timestamp'
     WHEN amount < 1 THEN 'amount_negative'
     WHEN amount > {T.TEST_MAX_AMOUNT} THEN 'amount_too_large'
     WHEN source NOT IN ({", ".join(f"'{s}'" for s in T.TEST_SOURCES)}) THEN 'invalid_source'
END"""

COMPAT_VALID_SQL = f"""
SELECT DISTINCT user_id, amount, "timestamp", source, event_time FROM ({FAULT_ROWS_SQL})
WHERE ({COMPAT_RULES_SQL}) IS NULL"""


@register("st_tx_valid_compat", f'SELECT user_id, amount, "timestamp", source FROM ({COMPAT_VALID_SQL})')
def st_tx_valid_compat(spark, sf_dir):
    """Valid records of the reference's order of steps: de-duplicate, then split."""
    out = _run_transactions(spark, sf_dir, COMPAT_RULES, faults=True)
    return TX.read_records(spark, out.valid).select("user_id", "amount", "timestamp", "source")


@register(
    "st_tx_dlq_compat",
    f"""SELECT DISTINCT user_id, "timestamp", error_reason FROM (
  SELECT *, {COMPAT_RULES_SQL} AS error_reason FROM ({FAULT_ROWS_SQL})) WHERE error_reason IS NOT NULL""",
)
def st_tx_dlq_compat(spark, sf_dir):
    """Rejects of the same: one per (user_id, timestamp), so all malformed rows
    are one. Which copy of a key stays is arbitrary, so only the key and the
    reason are returned."""
    out = _run_transactions(spark, sf_dir, COMPAT_RULES, faults=True)
    return TX.read_records(spark, out.rejected).select("user_id", "timestamp", "error_reason")


@register("st_tx_minute_total_compat", _minute_total_sql(COMPAT_VALID_SQL))
def st_tx_minute_total_compat(spark, sf_dir):
    """Complete-mode totals of the same: every window."""
    out = _run_transactions(spark, sf_dir, COMPAT_RULES, faults=True, totals_mode="complete")
    return TX.read_totals(spark, out.totals, "complete")


@register(
    "st_tx_routing",
    f"""
SELECT 'dlq' AS target, error_reason, COUNT(*) AS n, COUNT(*) AS with_payload FROM (
  SELECT *, {RULES_SQL} AS error_reason FROM (
    SELECT * FROM ({FAULT_ROWS_SQL}) UNION ALL SELECT * FROM ({FAULT_ROWS_SQL}) WHERE made_of = 'purchase'))
WHERE error_reason IS NOT NULL GROUP BY error_reason
UNION ALL
SELECT 'valid', NULL, COUNT(*), 0 FROM (
  SELECT DISTINCT user_id, "timestamp" FROM ({FAULT_ROWS_SQL}) WHERE ({RULES_SQL}) IS NULL)""",
)
def st_tx_routing(spark, sf_dir):
    """Where strict mode sends every record of a topic with broken ones: each
    reject, re-delivered ones too, with its raw payload; each valid one once."""
    out = _run_transactions(spark, sf_dir, faults=True)
    rejected = TX.read_records(spark, out.rejected, with_origin=True)
    valid = TX.read_records(spark, out.valid)
    return rejected.groupBy(F.lit("dlq").alias("target"), "error_reason").agg(
        F.count("*").alias("n"), F.count("raw_value").alias("with_payload"),
    ).unionByName(valid.select(
        F.lit("valid").alias("target"), F.lit(None).cast("string").alias("error_reason"),
    ).groupBy("target", "error_reason").agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("with_payload")))


@register(
    "topk_window_struct",
    f"SELECT * FROM ({SLIDING_SQL}) ORDER BY window_start DESC, window_end DESC LIMIT 10",
)
def topk_window_struct(spark, sf_dir):
    """``SELECT * FROM <result table> ORDER BY window DESC LIMIT 10`` over a
    named streaming result (A12, G3)."""
    s = _activity_stream(spark, sf_dir, batches=4)
    agg = E.windowed_count(s, "event_time", "10 minutes", "5 minutes", flatten=False)
    table = _run_complete(spark, agg, "sliding-named")
    name = "activity_by_window"
    table.createOrReplaceTempView(name)
    top = spark.sql(f"SELECT * FROM {name} ORDER BY window DESC LIMIT 10")
    return top.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "count")
