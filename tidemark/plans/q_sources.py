"""Registered queries: file sources and batch sinks."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_join
from tidemark.plans import gmv_batch
from tidemark.plans.registry import register
from tidemark.session import scratch_path
from tidemark.sinks import stream as K
from tidemark.sources import files as FS
from tidemark.sources import tables as T


@register(
    "src_csv_infer",
    "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
    "FROM customer",
)
def src_csv_infer(spark, sf_dir):
    """customer -> CSV -> read back with header + type inference."""
    path = scratch_path(spark, "customer-csv")
    T.table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return FS.read_csv(spark, path)


@register(
    "src_json_dir",
    "SELECT event_id, user_id, event_type, value, props, ts FROM events",
)
def src_json_dir(spark, sf_dir):
    """events -> JSON lines -> read back with an inferred schema; names are
    referenced in another case to show case-insensitive resolution."""
    path = scratch_path(spark, "events-json")
    T.table(spark, sf_dir, "events").write.option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ).json(path)
    df = FS.read_json_dir(spark, path)
    return df.select(
        F.col("EVENT_ID").alias("event_id"), F.col("User_Id").alias("user_id"),
        F.col("Event_Type").alias("event_type"), F.col("VALUE").alias("value"),
        F.col("props"), F.col("ts").cast("timestamp_ntz").alias("ts"),
    )


# ---------------------------------------------------------------- malformed CSV (A2)

# The fault injection: every line of one brand's products is replaced by junk.
# All rows of ``part`` are written; the rule only picks which lines are broken.
BROKEN_BRAND = "Brand#13"
BROKEN_LINE = "~~ cut off in transfer ~~"
PRODUCT_CSV_SCHEMA = "product_id int, product_name string, category string, price double"
CORRUPT_COLUMN = "_corrupt_record"


def _product_feed_csv(spark, sf_dir):
    """part -> headerless CSV lines (id, name, type, price), with the broken
    brand's lines replaced by junk; one parallel text write."""
    part = T.table(spark, sf_dir, "part")
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('\\"')), F.lit('"')) for c in ("p_name", "p_type")]
    good = F.concat_ws(",", F.col("p_partkey").cast("string"), *quoted, F.col("p_retailprice").cast("string"))
    line = F.when(F.col("p_brand") == BROKEN_BRAND, F.lit(BROKEN_LINE)).otherwise(good)
    path = scratch_path(spark, "product-feed-csv")
    part.select(line.alias("value")).write.text(path)
    return path


PRODUCT_FEED_SQL = """
SELECT CAST(p_partkey AS INTEGER) AS product_id, p_name AS product_name, p_type AS category,
       p_retailprice AS price{extra}
FROM part WHERE p_brand <> 'Brand#13'"""


@register(
    "src_csv_malformed",
    PRODUCT_FEED_SQL.format(extra=", CAST(NULL AS VARCHAR) AS _corrupt_record")
    + """
UNION ALL
SELECT NULL, NULL, NULL, NULL, '~~ cut off in transfer ~~' FROM part WHERE p_brand = 'Brand#13'""",
)
def src_csv_malformed(spark, sf_dir):
    """PERMISSIVE read: broken lines stay as all-null rows whose raw text is
    kept in the corrupt-record column."""
    path = _product_feed_csv(spark, sf_dir)
    return FS.read_csv(spark, path, schema=f"{PRODUCT_CSV_SCHEMA}, {CORRUPT_COLUMN} string",
                       header=False, mode="PERMISSIVE", corrupt_column=CORRUPT_COLUMN)


@register("src_csv_dropmalformed", PRODUCT_FEED_SQL.format(extra=""))
def src_csv_dropmalformed(spark, sf_dir):
    """DROPMALFORMED read: broken lines are dropped."""
    path = _product_feed_csv(spark, sf_dir)
    return FS.read_csv(spark, path, schema=PRODUCT_CSV_SCHEMA, header=False,
                       mode="DROPMALFORMED")


# ---------------------------------------------------------------- schema document (A4)

# Fixed value: a Spark schema document for the event feed. The "unique" key
# is not a Spark field property; reading the document ignores it.
EVENT_SCHEMA_DOC = {
    "type": "struct",
    "fields": [
        {"name": "event_id", "type": "long", "nullable": False, "metadata": {}, "unique": True},
        {"name": "user_id", "type": "long", "nullable": True, "metadata": {}},
        {"name": "event_type", "type": "string", "nullable": True, "metadata": {}},
        {"name": "value", "type": "double", "nullable": True, "metadata": {}},
    ],
}


@register("src_schema_json", "SELECT event_id, user_id, event_type, value FROM events")
def src_schema_json(spark, sf_dir):
    """events -> JSON lines -> read with the schema built from the document, itself
    read from the shared folder; fields the document does not name are not read."""
    path, doc = scratch_path(spark, "events-json-doc"), scratch_path(spark, "events-schema")
    T.table(spark, sf_dir, "events").write.json(path)
    spark.createDataFrame([(json.dumps(EVENT_SCHEMA_DOC),)], "value string").coalesce(1).write.text(doc)
    return FS.read_json_dir(spark, path, schema=FS.schema_from_json(doc, spark))


# ---------------------------------------------------------------- keyed records


@register(
    "sink_kafka_keyed",
    """
SELECT CAST(user_id AS VARCHAR) AS key,
       to_json({'user_id': CAST(user_id AS VARCHAR),
                'amount': CAST(round(value * 100) AS INTEGER),
                'timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
                'source': event_type})::VARCHAR AS value
FROM events""",
)
def sink_kafka_keyed(spark, sf_dir):
    """Records shaped for a keyed Kafka write: the key (user id) sends all
    of a user's records to one topic partition, the value is the row's JSON."""
    tx = T.transactions(spark, sf_dir).select("user_id", "amount", "timestamp", "source")
    return K.as_kafka_record(tx, key="user_id")


# The transaction source domain and its channel weights, an
# inline lookup table (bounded by construction, so broadcast is safe).
EVENT_TYPE_CHANNEL = [
    ("click", "web", 1.0),
    ("view", "web", 0.5),
    ("purchase", "pos", 2.0),
    ("signup", "mobile", 0.0),
    ("error", "mobile", 0.0),
]


@register(
    "src_inline",
    """
SELECT e.event_id, e.event_type, c.channel, CAST(e.value * c.weight AS DOUBLE) AS weighted_value
FROM events e JOIN (VALUES ('click', 'web', 1.0), ('view', 'web', 0.5), ('purchase', 'pos', 2.0),
                           ('signup', 'mobile', 0.0), ('error', 'mobile', 0.0))
                   AS c(event_type, channel, weight) ON e.event_type = c.event_type""",
)
def src_inline(spark, sf_dir):
    lookup = FS.inline(spark, EVENT_TYPE_CHANNEL, "event_type string, channel string, weight double")
    ev = T.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    j = broadcast_join(ev, lookup, "event_type", checked=True)
    return j.select("event_id", "event_type", "channel",
                    (F.col("value") * F.col("weight")).alias("weighted_value"))


@register(
    "sink_parquet_overwrite",
    """
SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id, o.o_orderdate AS order_datetime,
       l.l_partkey AS product_id, CAST(l.l_quantity AS INTEGER) AS quantity, l.l_extendedprice AS price,
       CAST(l.l_quantity AS INTEGER) * l.l_extendedprice AS gmv
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_quantity > 0 AND l.l_extendedprice > 0""",
)
def sink_parquet_overwrite(spark, sf_dir):
    """The GMV batch job end to end, read back from its Parquet output."""
    return gmv_batch.run(spark, sf_dir, scratch_path(spark, "gmv-parquet"))
