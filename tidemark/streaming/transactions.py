"""The validated transaction stream (I10-I14): decode the Kafka envelope,
parse JSON, validate, de-duplicate, route valid records and rejects to two
outputs, and total valid amounts per one-minute window.

``build`` returns the three frames; ``start`` wires them to sinks, Kafka topics
or their file stand-in. The same ``build`` applied to a bounded envelope table
gives the batch end state, which is how the stream is tested.

No record is lost to lateness: in strict mode copies are dropped under a
watermark on *processing* time, which no arriving row can be behind, so a valid
record is published however old its event time is. The horizon only says how long a
published key is remembered; a copy that comes later is published again.

Topology of ``start`` (default): the raw topic is read by two queries, the
validator (valid records, de-duplicated) and the dead-letter router; the
minute totals are computed downstream from the *published valid records*
(the valid topic, or its file stand-in), so the raw topic is not decoded,
validated and de-duplicated a third time and the de-duplication state
exists once. ``chain_totals=False`` keeps the reference's three readers of
the raw topic.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidemark.functions.scalar import binary_to_string, parse_json
from tidemark.operators import validation as V
from tidemark.sinks import stream as K
from tidemark.sinks import versions
from tidemark.sources import stream as SS
from tidemark.streaming import runner
from tidemark.streaming.events import dedup_on_arrival, dedup_unbounded

WATERMARK = "3 minutes"
TOTAL_WINDOW = "1 minute"
#: How long, in processing time, strict mode remembers a published key.
DEDUP_HORIZON = "1 hour"


# Columns of a published record (``sinks.stream.as_kafka_record``).
RECORD_SCHEMA = "key string, value string"
# Where a record came from; rejects carry these, so that one can be replayed.
ORIGIN = ("raw_key", "raw_value", "topic", "partition", "offset")


@dataclass(frozen=True)
class TransactionStreams:
    valid: DataFrame
    rejected: DataFrame
    minute_totals: DataFrame
    watermark: str = WATERMARK
    window: str = TOTAL_WINDOW


def decode(envelope: DataFrame, with_origin: bool = False) -> DataFrame:
    """Kafka value bytes -> JSON text -> typed columns.
    Malformed JSON gives an all-null row, which validation rejects;
    ``with_origin`` keeps the raw payload and its place in the topic."""
    text = envelope.withColumn("raw_value", binary_to_string("value"))
    origin = []
    if with_origin:
        text = text.withColumn("raw_key", binary_to_string("key"))
        origin = list(ORIGIN)
    return text.select(parse_json("raw_value", V.TRANSACTION_SCHEMA).alias("data"), *origin).select("data.*", *origin)


def build(
    envelope: DataFrame,
    rules: V.Rules = V.Rules(),
    watermark: str = WATERMARK,
    window: str = TOTAL_WINDOW,
    dedup_horizon: str = DEDUP_HORIZON,
) -> TransactionStreams:
    """Define the three outputs.

    strict (default): split first; valid records are de-duplicated on
    (user_id, timestamp) within ``dedup_horizon`` of processing time (bounded
    state, no late loss); every rejected record goes to the dead-letter output
    with its raw payload. compat: the reference's order - de-duplicate
    everything first (unbounded state; malformed rows collapse into one),
    then watermark and split.
    """
    validated = V.validate(V.with_event_time(decode(envelope, with_origin=True)), rules)
    keys = list(rules.dedup_keys)
    if rules.mode == "compat":
        deduped = dedup_unbounded(validated, keys)
        if deduped.isStreaming:
            deduped = deduped.withWatermark("event_time", watermark)
        valid, rejected = V.split(deduped)
    else:
        valid, rejected = V.split(validated)
        valid = dedup_on_arrival(valid, keys, dedup_horizon)
    valid = valid.drop(*ORIGIN)
    totals = V.minute_totals(valid, window)
    return TransactionStreams(valid=valid, rejected=rejected, minute_totals=totals,
                              watermark=watermark, window=window)


def totals_from_records(records: DataFrame, watermark: str | None = None,
                        window: str = TOTAL_WINDOW) -> DataFrame:
    """Minute totals computed from published valid records (``value`` = the
    record's JSON): decode, event time, window sum (I13). The records are
    already validated and de-duplicated upstream. With a ``watermark`` windows
    close and later rows are dropped (append mode needs that); without one
    every row counts, and the state is one row per minute with records."""
    valid = V.with_event_time(decode(records))
    if valid.isStreaming and watermark:
        valid = valid.withWatermark("event_time", watermark)
    return V.minute_totals(valid, window)


@dataclass(frozen=True)
class KafkaTopic:
    """An output topic; a plain string output is a folder, its file stand-in."""

    bootstrap_servers: str
    topic: str


@dataclass(frozen=True)
class Outputs:
    valid: str | KafkaTopic
    rejected: str | KafkaTopic
    totals: str
    checkpoint: str


def start(
    streams: TransactionStreams,
    out: Outputs,
    trigger: dict | None = None,
    totals_mode: str = "update",
    chain_totals: bool = True,
    first_commit_timeout: float = 600.0,
) -> list[StreamingQuery]:
    """Start the three queries with their own checkpoints.

    Valid records and rejects are published as Kafka-shaped records
    (``value`` = JSON of the row) to topics or to folders. Minute totals go to
    Parquet: ``update`` (default) appends each batch's changed windows to an
    update log, ``complete`` replaces the whole table each batch; both count
    late rows, and ``read_totals`` reads either. ``append`` writes a window
    once, when the watermark passes its end, and drops rows later than that.

    With ``chain_totals`` the totals query reads the valid output as a
    stream (the file sink's commit log makes it see only committed files).
    It starts once that output exists: at once for a topic, after the
    validator ends for a one-shot trigger (``availableNow``/``once``), after
    its first batch with input otherwise. If that doesn't come in
    ``first_commit_timeout`` seconds, or the validator fails, both started
    queries are stopped and the error is raised.
    """
    if totals_mode == "append" and not chain_totals:
        raise ValueError("append totals need the watermark of chained totals")
    q_valid = _publish(streams.valid, out.valid, f"{out.checkpoint}/valid", trigger)
    q_rejected = _publish(streams.rejected, out.rejected, f"{out.checkpoint}/dlq", trigger)
    totals = streams.minute_totals
    try:
        if chain_totals:
            one_shot = bool(trigger) and any(trigger.get(k) for k in ("availableNow", "once"))
            if one_shot or not isinstance(out.valid, KafkaTopic):
                _await_first_commit(q_valid, one_shot, first_commit_timeout)
            totals = totals_from_records(
                _read_published(streams.valid.sparkSession, out.valid),
                streams.watermark if totals_mode == "append" else None, streams.window)
        if totals_mode == "append":
            q_totals = K.start_files(totals, out.totals, f"{out.checkpoint}/totals",
                                     trigger=trigger)
        else:
            sink = K.append_updates_each_batch if totals_mode == "update" else versions.replace_each_batch
            q_totals = K.start_foreach_batch(totals, sink(out.totals), f"{out.checkpoint}/totals",
                                             output_mode=totals_mode, trigger=trigger)
    except Exception:
        for q in (q_valid, q_rejected):
            q.stop()
        raise
    return [q_valid, q_rejected, q_totals]


#: Outputs of ``start_one_pass``.
VALID, REJECTED, TOTALS = "valid", "rejected", "totals"
_TOTALS_SCHEMA = "window_start timestamp, window_end timestamp, running_total long"


def start_one_pass(
    envelope: DataFrame,
    path: str,
    checkpoint: str,
    rules: V.Rules = V.Rules(),
    trigger: dict | None = None,
    window: str = TOTAL_WINDOW,
    dedup_horizon: str = DEDUP_HORIZON,
) -> StreamingQuery:
    """All three outputs from one query that reads the raw topic once.

    Each batch is decoded, validated and de-duplicated once and persisted; its
    valid records, its rejects and its minute sums go to three outputs of the
    batch table at ``path``, which become visible together. Sums of a minute
    are added over batches by ``read_one_pass``, so totals need no state, and
    late rows count.

    strict: copies of a valid record are dropped within ``dedup_horizon``; a
    reject is its own key (its place in the topic), so every one of them gets
    through. compat: all rows are de-duplicated on (user_id, timestamp) first,
    without a bound.
    """
    validated = V.validate(V.with_event_time(decode(envelope, with_origin=True)), rules)
    if rules.mode == "compat":
        rows = dedup_unbounded(validated, list(rules.dedup_keys))
    else:
        place = ("topic", "partition", "offset")
        keyed = validated.withColumns({
            **{f"_{k}": F.when(F.col("is_valid"), F.col(k)) for k in rules.dedup_keys},
            **{f"_{k}": F.when(~F.col("is_valid"), F.col(k)) for k in place},
        })
        names = [f"_{k}" for k in (*rules.dedup_keys, *place)]
        rows = dedup_on_arrival(keyed, names, dedup_horizon).drop(*names)
    outputs = {
        VALID: lambda batch: K.as_kafka_record(batch.where("is_valid").drop(*ORIGIN), key="user_id"),
        REJECTED: lambda batch: K.as_kafka_record(batch.where("NOT is_valid"), key="user_id"),
        TOTALS: lambda batch: V.minute_totals(batch.where("is_valid"), window),
    }
    return K.start_foreach_batch(rows, versions.split_each_batch(path, outputs), checkpoint, trigger=trigger)


def read_one_pass(spark: SparkSession, path: str, output: str) -> DataFrame:
    """One output of ``start_one_pass``: records (``RECORD_SCHEMA``) or the sum
    of every minute over all committed batches."""
    if output == TOTALS:
        sums = versions.read_output(spark, path, TOTALS, _TOTALS_SCHEMA)
        return sums.groupBy("window_start", "window_end").agg(F.sum("running_total").alias("running_total"))
    return records_of(versions.read_output(spark, path, output, RECORD_SCHEMA).drop("batch"))


def _publish(rows: DataFrame, target: str | KafkaTopic, checkpoint: str,
             trigger: dict | None) -> StreamingQuery:
    records = K.as_kafka_record(rows, key="user_id")
    if isinstance(target, KafkaTopic):
        return K.start_kafka(records, target.bootstrap_servers, target.topic, checkpoint, trigger=trigger)
    return K.start_files(records, target, checkpoint, trigger=trigger)


def _read_published(spark: SparkSession, target: str | KafkaTopic) -> DataFrame:
    if isinstance(target, KafkaTopic):
        options = SS.kafka_options(target.bootstrap_servers, subscribe=target.topic, starting_offsets="earliest")
        return SS.read_kafka(spark, options).select("key", "value")
    return SS.stream_files(spark, target, "parquet", RECORD_SCHEMA)


def _await_first_commit(query: StreamingQuery, one_shot: bool, timeout: float) -> None:
    """Wait until ``query`` has committed output: its end for a one-shot
    trigger, else the first batch that read rows (an idle query reports
    progress too, so only a report with input counts). A failure of the query
    is raised here."""
    if one_shot:
        query.awaitTermination()
    waited = 0.0
    while not one_shot and query.isActive and not any(runner.input_rows_per_batch(query)):
        if waited >= timeout:
            raise TimeoutError("validator committed no batch; totals query not started")
        time.sleep(0.2)
        waited += 0.2
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"validator query failed: {exc}")


def read_totals(spark: SparkSession, path: str, totals_mode: str = "update") -> DataFrame:
    """End state of the totals output: every window with its sum."""
    schema = "window_start timestamp, window_end timestamp, running_total long"
    if totals_mode == "update":
        log = spark.read.schema(f"{schema}, update_batch int").parquet(path)
        return K.latest_state(log, ["window_start", "window_end"])
    if totals_mode == "complete":
        return versions.read(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def read_records(spark: SparkSession, path: str, with_origin: bool = False) -> DataFrame:
    """Read a record output back into transaction columns; ``with_origin``
    adds what a dead letter keeps of the record it came from."""
    return records_of(spark.read.schema(RECORD_SCHEMA).parquet(path), with_origin)


def records_of(recs: DataFrame, with_origin: bool = False) -> DataFrame:
    """Transaction columns of published records."""
    schema = StructType([*V.TRANSACTION_SCHEMA.fields,
                         StructField("error_reason", StringType(), True)])
    if with_origin:
        for name in ORIGIN:
            kind = {"partition": IntegerType(), "offset": LongType()}.get(name, StringType())
            schema = schema.add(name, kind)
    return recs.select(F.from_json("value", schema).alias("r")).select("r.*")
