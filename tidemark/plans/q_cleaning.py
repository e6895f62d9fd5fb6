"""Registered queries: projection, typing and cleaning (group C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators import cleaning as C
from tidemark.plans import oracle as O
from tidemark.plans import retail as R
from tidemark.plans.registry import register
from tidemark.sources import tables as T


def _events(spark, sf_dir):
    return T.table(spark, sf_dir, "events")


@register(
    "proj_select",
    "SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date, "
    "o_totalprice AS total_amount FROM orders",
)
def proj_select(spark, sf_dir):
    return C.select_columns(
        T.table(spark, sf_dir, "orders"),
        {"order_id": "o_orderkey", "user_id": "o_custkey", "order_date": "o_orderdate",
         "total_amount": "o_totalprice"},
    )


@register(
    "proj_struct_star",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def proj_struct_star(spark, sf_dir):
    ev = _events(spark, sf_dir)
    parsed = ev.select("event_id", S.parse_json("props", "k int").alias("data"))
    return parsed.select("event_id", "data.*")


@register(
    "proj_select_expr",
    """
SELECT event_id, user_id, event_type, value, props, ts, creation_ns,
       make_timestamp(CAST(trunc(CAST(creation_ns AS DOUBLE) / 1000000000 * 1000000) AS BIGINT))
         AS event_time
FROM (SELECT *, epoch_us(ts) * 1000 AS creation_ns FROM events)""",
)
def proj_select_expr(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn(
        "creation_ns",
        F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                         F.col("ts")) * 1000,
    )
    return C.select_expr(
        ev, "*", "cast(cast(creation_ns as double)/1000000000 as timestamp) as event_time"
    )


@register(
    "cast_numeric",
    """
SELECT event_id,
       TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
       TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value,
       TRY_CAST(event_type AS INTEGER) AS event_type
FROM events""",
)
def cast_numeric(spark, sf_dir):
    ev = _events(spark, sf_dir).select(
        "event_id",
        F.regexp_extract("props", "[0-9]+", 0).alias("k"),
        F.col("value").cast("string").alias("value"),
        "event_type",
    )
    return C.cast_columns(ev, {"k": "int", "value": "double", "event_type": "int"})


@register(
    "cast_date",
    "SELECT o_orderkey AS order_id, TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS order_date "
    "FROM orders",
)
def cast_date(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    )
    return C.to_date_columns(o, ["order_date"])


@register(
    "cast_timestamp_fmt",
    """
SELECT o_orderkey AS order_id,
       try_strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS order_datetime,
       CAST(NULL AS TIMESTAMP) AS date_only_parsed
FROM orders""",
)
def cast_timestamp_fmt(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_datetime"),
        # a date-only string does not match the pattern: NULL, not an error
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_only_parsed"),
    )
    return C.to_timestamp_columns(o, ["order_datetime", "date_only_parsed"], S.DATETIME_PATTERN)


@register(
    "cast_timestamp_iso",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS event_time
FROM events""",
)
def cast_timestamp_iso(spark, sf_dir):
    ev = _events(spark, sf_dir).select(
        "event_id",
        # the stream producer emits an unparseable token for some records
        F.when(F.col("event_type") == "error", F.lit("invalid_timestamp"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("event_time"),
    )
    return C.to_timestamp_columns(ev, ["event_time"], pattern=None)


@register(
    "proj_rename_drop",
    "SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_datetime FROM orders",
)
def proj_rename_drop(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
    )
    # names that are not there are passed over
    return C.rename_drop(o, {"order_date": "order_datetime", "no_such_column": "renamed"},
                         drop=["neither_this"])


@register(
    "clean_dropna_keys",
    """
SELECT c_custkey AS user_id, last_early FROM customer
LEFT JOIN (SELECT o_custkey, max(CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN o_orderdate END) AS last_early
           FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey
WHERE last_early IS NOT NULL""",
)
def clean_dropna_keys(spark, sf_dir):
    """Latest early order of every customer over all orders; customers without
    orders, and those with later ones only, have a null there and go."""
    o = T.table(spark, sf_dir, "orders")
    early = F.when(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"), F.col("o_orderdate"))
    last = o.groupBy("o_custkey").agg(F.max(early).alias("last_early"))
    users = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    joined = users.join(last, users.user_id == last.o_custkey, "left").select("user_id", "last_early")
    return C.drop_null_keys(joined, ["user_id", "last_early"])


@register(
    "clean_positive",
    """
SELECT o.o_orderkey AS order_id, l.l_partkey AS product_id, l.l_quantity AS quantity,
       l.l_extendedprice AS price
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_quantity > 0 AND l.l_extendedprice > 0""",
)
def clean_positive(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select("o_orderkey")
    li = T.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
    )
    j = o.join(li, o.o_orderkey == li.l_orderkey).select(
        F.col("o_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
    )
    return C.keep_positive(j, ["quantity", "price"])


@register(
    "clean_normalize_text",
    "SELECT p_partkey AS product_id, trim(lower(p_type)) AS category, "
    "trim(lower(p_brand)) AS brand FROM part",
)
def clean_normalize_text(spark, sf_dir):
    p = T.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
    )
    return C.normalize_columns(p, ["category", "brand"])


@register(
    "dedup_keys",
    O.with_model("SELECT order_id, product_id, quantity, price FROM items_c", fact=False),
)
def dedup_keys(spark, sf_dir):
    items = R.clean(R.load_model(spark, sf_dir)).order_items
    return items.select("order_id", "product_id", "quantity", "price")


@register(
    "dedup_user_event_type",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def dedup_user_event_type(spark, sf_dir):
    """Coarser key than the data's own grain; only key columns are projected so
    the arbitrary survivor of ``dropDuplicates`` cannot change the result."""
    return C.distinct_rows(_events(spark, sf_dir).select("user_id", "event_type"),
                           ["user_id", "event_type"])


@register(
    "filter_where",
    """
SELECT event_type AS gt, user_id AS "User", ts AS event_time, value FROM events
WHERE event_type LIKE '%ic%' AND event_type IS NOT NULL""",
)
def filter_where(spark, sf_dir):
    act = T.activity(spark, sf_dir).withColumn("matches", S.like("gt", "%ic%"))
    out = C.filter_where(C.filter_where(act, "matches"), "gt is not null")
    return out.select("gt", "User", "event_time", "value")
