"""Registered queries: scalar functions, UDFs and validation (H, L, I11-I13 batch form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.functions import udfs as U
from tidemark.operators import validation as V
from tidemark.plans.registry import register
from tidemark.sources import tables as T

TX_SQL = """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(round(value * 100) AS INTEGER) AS amount,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", event_type AS source, ts AS event_time
FROM events"""

RULES_SQL = f"""
CASE WHEN user_id IS NULL THEN 'missing_user_id'
     WHEN amount IS NULL THEN 'missing_amount'
     WHEN "timestamp" IS NULL THEN 'missing_timestamp'
     WHEN event_time IS NULL THEN 'invalid_timestamp'
     WHEN amount < 1 THEN 'amount_negative'
     WHEN amount > {T.TEST_MAX_AMOUNT} THEN 'amount_too_large'
     WHEN source IS NULL OR source NOT IN ({", ".join(f"'{s}'" for s in T.TEST_SOURCES)})
       THEN 'invalid_source'
END"""

VALIDATED_SQL = f"""
SELECT *, error_reason IS NULL AS is_valid FROM (
  SELECT *, {RULES_SQL} AS error_reason FROM ({TX_SQL}))"""

TEST_RULES = V.Rules(sources=T.TEST_SOURCES, max_amount=T.TEST_MAX_AMOUNT)


def validated_transactions(spark, sf_dir, rules=TEST_RULES):
    return V.validate(V.with_event_time(T.transactions(spark, sf_dir)), rules)


@register("st_validate", VALIDATED_SQL)
def st_validate(spark, sf_dir):
    return validated_transactions(spark, sf_dir)


@register(
    "fn_bool_flag",
    f"SELECT is_valid, COUNT(*) AS n FROM ({VALIDATED_SQL}) GROUP BY is_valid",
)
def fn_bool_flag(spark, sf_dir):
    return validated_transactions(spark, sf_dir).groupBy("is_valid").agg(F.count("*").alias("n"))


@register(
    "st_split_counts",
    f"""
SELECT CASE WHEN is_valid THEN 'valid' ELSE 'dlq' END AS target, error_reason, COUNT(*) AS n
FROM ({VALIDATED_SQL}) GROUP BY 1, 2""",
)
def st_split_counts(spark, sf_dir):
    """Rows per output and reason, counted in one pass over the validated rows."""
    target = F.when(F.col("is_valid"), "valid").otherwise("dlq").alias("target")
    return validated_transactions(spark, sf_dir).groupBy(target, "error_reason").agg(F.count("*").alias("n"))


@register(
    "st_minute_total",
    f"""
SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start,
       time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end,
       CAST(SUM(amount) AS BIGINT) AS running_total
FROM ({VALIDATED_SQL}) WHERE is_valid AND event_time IS NOT NULL GROUP BY 1, 2""",
)
def st_minute_total(spark, sf_dir):
    valid, _ = V.split(validated_transactions(spark, sf_dir))
    return V.minute_totals(valid)


@register(
    "fn_like",
    "SELECT event_id, event_type AS gt, event_type LIKE '%ic%' AS matches FROM events",
)
def fn_like(spark, sf_dir):
    return T.activity(spark, sf_dir).select(
        F.col("Index").alias("event_id"), "gt", S.like("gt", "%ic%").alias("matches")
    )


@register(
    "fn_isin_not",
    f"""SELECT event_id, event_type AS source,
       NOT (event_type IN ({", ".join(f"'{s}'" for s in T.TEST_SOURCES)})) AS outside_domain
FROM events""",
)
def fn_isin_not(spark, sf_dir):
    tx = T.transactions(spark, sf_dir)
    return tx.select("event_id", "source",
                     S.not_in_domain("source", T.TEST_SOURCES).alias("outside_domain"))


@register(
    "fn_from_json",
    f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(round(value * 100) AS INTEGER) AS amount,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", event_type AS source
FROM events""",
)
def fn_from_json(spark, sf_dir):
    """Transactions serialised to JSON text and parsed back with the stream schema."""
    tx = T.transactions(spark, sf_dir)
    text = tx.select("event_id", S.row_to_json("user_id", "amount", "timestamp", "source").alias("value"))
    parsed = text.select("event_id", S.parse_json("value", V.TRANSACTION_SCHEMA).alias("data"))
    return parsed.select("event_id", "data.*")


@register(
    "fn_to_json",
    """
SELECT event_id, to_json({'user_id': CAST(user_id AS VARCHAR),
                          'amount': CAST(round(value * 100) AS INTEGER),
                          'timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
                          'source': event_type})::VARCHAR AS value
FROM events""",
)
def fn_to_json(spark, sf_dir):
    """Rows as compact JSON text; null fields would be omitted."""
    tx = T.transactions(spark, sf_dir)
    return tx.select("event_id", S.row_to_json("user_id", "amount", "timestamp", "source").alias("value"))


@register(
    "fn_ns_epoch",
    """
SELECT event_id, make_timestamp(CAST(trunc(CAST(epoch_us(ts) * 1000 AS DOUBLE) / 1000000000 * 1000000)
                                     AS BIGINT)) AS event_time
FROM events""",
)
def fn_ns_epoch(spark, sf_dir):
    ev = T.table(spark, sf_dir, "events")
    ns = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                          F.col("ts")) * 1000
    return ev.select("event_id", S.ns_epoch_to_timestamp(ns).alias("event_time"))


@register(
    "fn_current_ts",
    "SELECT event_type, COUNT(*) AS count, TRUE AS stamped FROM events GROUP BY event_type",
)
def fn_current_ts(spark, sf_dir):
    """Per-type counts stamped with processing time; the stamp itself differs
    from run to run, so the query returns only that there is one."""
    ev = T.table(spark, sf_dir, "events")
    stamped = ev.groupBy("event_type").count().withColumn("processed_at", S.processing_time())
    return stamped.select("event_type", "count", F.col("processed_at").isNotNull().alias("stamped"))


@register(
    "fn_binary_to_string",
    "SELECT event_id, props AS value FROM events",
)
def fn_binary_to_string(spark, sf_dir):
    ev = T.table(spark, sf_dir, "events").select("event_id", F.encode("props", "UTF-8").alias("value"))
    return ev.select("event_id", S.binary_to_string("value").alias("value"))


@register(
    "fn_trim_lower",
    "SELECT c_custkey AS user_id, trim(lower(c_name)) AS name, trim(lower(c_mktsegment)) AS segment "
    "FROM customer",
)
def fn_trim_lower(spark, sf_dir):
    c = T.table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("user_id"), S.normalize_text("c_name").alias("name"),
                    S.normalize_text("c_mktsegment").alias("segment"))


@register(
    "udf_scalar",
    "SELECT p_partkey AS product_id, p_name AS fruit, CAST(length(p_name) AS INTEGER) AS length FROM part",
)
def udf_scalar(spark, sf_dir):
    p = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"),
                                              F.col("p_name").alias("fruit"))
    return p.withColumn("length", U.text_length_rowwise(F.col("fruit")))


@register(
    "udf_pandas",
    "SELECT p_partkey AS product_id, p_name AS fruit, CAST(length(p_name) AS INTEGER) AS length FROM part",
)
def udf_pandas(spark, sf_dir):
    p = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"),
                                              F.col("p_name").alias("fruit"))
    return p.withColumn("length", U.text_length_batched(F.col("fruit")))
