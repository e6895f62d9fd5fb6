"""Golden rows for transaction validation, dedup and split (compat vs strict)."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import validation as V
from tidemark.sinks import stream as K
from tidemark.sources.stream import ENVELOPE_SCHEMA, read_envelope_files
from tidemark.streaming import runner
from tidemark.streaming import transactions as TX

T = "2024-01-01T00:00:10Z"


def _rec(**kw):
    return json.dumps(kw)


# (payload text, compat reason, strict reason); None = valid
ROWS = [
    (_rec(user_id="U1", amount=20000, timestamp=T, source="web"), None, None),
    (_rec(user_id=None, amount=5, timestamp=T, source="web"), "missing_user_id", "missing_user_id"),
    (_rec(user_id="U3", timestamp=T, source="web"), "missing_amount", "missing_amount"),
    (_rec(user_id="U4", amount=5, source="web"), "missing_timestamp", "missing_timestamp"),
    (_rec(user_id="U5", amount=-500, timestamp=T, source="mobile"), "amount_negative", "amount_negative"),
    (_rec(user_id="U6", amount=0, timestamp=T, source="mobile"), "amount_negative", "amount_negative"),
    (_rec(user_id="U7", amount=99999999, timestamp=T, source="web"), "amount_too_large", "amount_too_large"),
    (_rec(user_id="U8", amount=10000000, timestamp=T, source="pos"), None, None),
    (_rec(user_id="U9", amount=15000, timestamp=T, source="telegram"), "invalid_source", "invalid_source"),
    (_rec(user_id="U10", amount=15000, timestamp=T), None, "invalid_source"),
    (_rec(user_id="U11", amount=20000, timestamp="invalid_timestamp", source="pos"), None,
     "invalid_timestamp"),
    (_rec(user_id="U12", amount=-1, timestamp=T, source="telegram"), "amount_negative", "amount_negative"),
    (_rec(user_id="U1", amount=20000, timestamp=T, source="web"), None, None),  # duplicate of row 1
    ("{bad", "missing_user_id", "missing_user_id"),
    ("not json", "missing_user_id", "missing_user_id"),
]


def _envelope(spark):
    rows = [(None, v.encode(), "transactions", 0, i, None, 0) for i, (v, _, _) in enumerate(ROWS)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


@pytest.mark.parametrize("mode,col", [("compat", 1), ("strict", 2)])
def test_first_failing_rule_wins(spark, mode, col):
    decoded = TX.decode(_envelope(spark))
    out = V.validate(V.with_event_time(decoded), V.Rules(mode=mode)).collect()
    assert [r.error_reason for r in out] == [row[col] for row in ROWS]
    assert [r.is_valid for r in out] == [row[col] is None for row in ROWS]


@pytest.mark.parametrize("mode,valid,rejected,total", [
    ("compat", 4, 9, 10_035_000),
    ("strict", 2, 12, 10_020_000),
])
def test_dedup_split_and_minute_total_batch(spark, mode, valid, rejected, total):
    s = TX.build(_envelope(spark), V.Rules(mode=mode))
    assert s.valid.count() == valid
    assert s.rejected.count() == rejected
    totals = s.minute_totals.collect()
    assert len(totals) == 1 and totals[0].running_total == total


@pytest.mark.parametrize("mode,valid,rejected,total", [
    ("compat", 4, 9, 10_035_000),
    ("strict", 2, 12, 10_020_000),
])
def test_stream_matches_batch(spark, tmp, mode, valid, rejected, total):
    """The same records as a Kafka-envelope file stream reach the same end state."""
    src = f"{tmp}/envelope"
    _envelope(spark).write.parquet(src)
    streams = TX.build(read_envelope_files(spark, src), V.Rules(mode=mode))
    out = TX.Outputs(valid=f"{tmp}/valid", rejected=f"{tmp}/dlq", totals=f"{tmp}/totals",
                     checkpoint=f"{tmp}/ckpt")
    runner.await_all(TX.start(streams, out, trigger=runner.AVAILABLE_NOW, totals_mode="complete"))
    assert TX.read_records(spark, out.valid).count() == valid
    dlq = TX.read_records(spark, out.rejected)
    assert dlq.count() == rejected
    assert dlq.where(F.col("error_reason").isNull()).count() == 0
    totals = TX.read_totals(spark, out.totals, "complete").collect()
    assert [r.running_total for r in totals] == [total]


def test_json_field_coercion(spark):
    """Quoted numbers, int overflow and fractions become NULL, not errors."""
    texts = ['{"amount": "12"}', '{"amount": 99999999999}', '{"amount": 1.5}', '{"amount": 7}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = [r.amount for r in df.select(F.from_json("value", V.TRANSACTION_SCHEMA).alias("d"))
           .select("d.amount").collect()]
    assert got == [None, None, None, 7]


def test_kafka_record_omits_null_fields(spark):
    df = spark.createDataFrame([("U1", None)], "user_id string, error_reason string")
    rec = K.as_kafka_record(df, key="user_id").collect()[0]
    assert rec.key == "U1" and json.loads(rec.value) == {"user_id": "U1"}


def test_chained_totals_with_a_continuous_trigger(spark, tmp):
    """Totals read the published valid records; with a processing-time
    trigger they start after the validator's first committed batch."""
    src = f"{tmp}/envelope"
    _envelope(spark).write.parquet(src)
    streams = TX.build(read_envelope_files(spark, src), V.Rules(mode="strict"))
    out = TX.Outputs(valid=f"{tmp}/valid", rejected=f"{tmp}/dlq", totals=f"{tmp}/totals",
                     checkpoint=f"{tmp}/ckpt")
    qs = TX.start(streams, out, trigger={"processingTime": "1 second"}, totals_mode="complete")
    try:
        for q in qs:
            q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    assert TX.read_records(spark, out.valid).count() == 2
    assert [r.running_total for r in TX.read_totals(spark, out.totals, "complete").collect()] == [10_020_000]
