"""The driver's test tables and their mapping onto the logical retail model.

Logical model (users, products, orders, order_items) <- test tables:

* users       <- customer x nation (city = nation name); no signup date
                 exists, so one is derived from the key by a fixed rule
* products    <- part (category = part type, price = retail price)
* orders      <- orders (total_amount = total price)
* order_items <- lineitem (price = extended price); the tie-break columns
                 used to pick one row per (order, product) are kept

All readers select only the columns they need, so the parquet scan's
ReadSchema is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_join

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed rule for the synthetic signup date (shared with the SQL oracle):
# DATE '1995-01-01' + (c_custkey * 7 % 2400) days.
SIGNUP_EPOCH = "1995-01-01"
SIGNUP_STEP = 7
SIGNUP_SPAN = 2400
# TPC-H fixes nation at 25 rows, so broadcasting it is bounded by construction.
NATION_MAX_ROWS = 25
# order_items survivor per (order_id, product_id): smallest of these, in order
ITEM_TIEBREAK = ["line_number", "supp_id", "quantity", "price", "ship_date"]


# Declared schemas of the tables the jobs read. A declared schema spares the
# footer-reading inference job on every read (at scale, a listing-sized
# job per table); other tables fall back to inference.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, name, city, signup_date."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name")
    )
    joined = broadcast_join(cust, nation, "c_nationkey", how="inner",
                            max_rows=NATION_MAX_ROWS)
    signup = F.date_add(
        F.lit(SIGNUP_EPOCH).cast("date"),
        (F.col("c_custkey") * SIGNUP_STEP % SIGNUP_SPAN).cast("int"),
    )
    return joined.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("city"),
        signup.alias("signup_date"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, product_name, category, price."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id, user_id, order_date (timestamp), total_amount."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id, product_id, quantity, price + tie-break columns."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("supp_id"),
        F.col("l_shipdate").alias("ship_date"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity-stream shape from ``events``: gt, User, event_time, value ..."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Index"),
        F.col("ts").alias("event_time"),
        F.col("user_id").alias("User"),
        F.col("event_type").alias("gt"),
        F.col("value"),
        F.col("props"),
    )


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the test tables to ``spark.sql`` under their own names."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


# Test mapping of the transaction stream onto ``events`` (fixed values):
# amount in cents, source = event type, so the rule domain/limits are
# parameters: sources {click, view, purchase}, maximum 30000 cents.
TEST_SOURCES = ("click", "view", "purchase")
TEST_MAX_AMOUNT = 30000
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id text, amount int, timestamp ISO text, source text (+ event_id)."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.round(F.col("value") * 100).cast("int").alias("amount"),
        F.date_format("ts", ISO_MICROS).alias("timestamp"),
        F.col("event_type").alias("source"),
    )
