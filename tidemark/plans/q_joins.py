"""Registered queries: joins and join strategies (group D, M2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import copartition as P
from tidemark.operators import joins as J
from tidemark.plans import oracle as O
from tidemark.plans import retail as R
from tidemark.plans.registry import register
from tidemark.sources import tables as T

# purchases x customers x products, the demo star of the reference
STAR_SQL = """
SELECT p.product_id, p.customer_id, p.order_id, p.quantity, p.price,
       c.c_name AS customer_name, pr.p_name AS product_name, pr.p_retailprice AS list_price
FROM (SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
             CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS price
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) p
JOIN customer c ON p.customer_id = c.c_custkey
JOIN part pr ON p.product_id = pr.p_partkey"""


def _star_inputs(spark, sf_dir):
    li = T.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").alias("price"),
    )
    orders = T.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    purchases = J.join_using(li, orders, "order_id")
    customers = T.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name")
    )
    products = T.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
    )
    return purchases, customers, products


def _star_select(df, customers, products):
    # both dimensions carry 'name' and products a second 'price': disambiguate
    return df.select(
        "product_id", "customer_id", "order_id", "quantity",
        F.col("p.price").alias("price"),
        customers["name"].alias("customer_name"),
        products["name"].alias("product_name"),
        products["price"].alias("list_price"),
    )


def _star(spark, sf_dir, join_fn):
    purchases, customers, products = _star_inputs(spark, sf_dir)
    p = purchases.alias("p")
    step = join_fn(p, customers, "customer_id")
    out = join_fn(step, products, "product_id")
    return _star_select(out, customers, products)


@register("join_inner_using", STAR_SQL)
def join_inner_using(spark, sf_dir):
    return _star(spark, sf_dir, J.join_using)


@register("join_sort_merge", STAR_SQL)
def join_sort_merge(spark, sf_dir):
    return _star(spark, sf_dir, J.sort_merge_join)


@register("join_broadcast", STAR_SQL)
def join_broadcast(spark, sf_dir):
    # the dimension is broadcast only if it proves to hold <= 1M rows
    return _star(spark, sf_dir, lambda a, b, on: J.broadcast_join(a, b, on))


@register("join_shuffle_hash", STAR_SQL)
def join_shuffle_hash(spark, sf_dir):
    return _star(spark, sf_dir, J.shuffle_hash_join)


@register(
    "join_inner_expr",
    """
SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id, o.o_orderdate AS order_date,
       l.l_partkey AS product_id, CAST(l.l_quantity AS INTEGER) AS quantity, l.l_extendedprice AS price
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
)
def join_inner_expr(spark, sf_dir):
    orders = T.orders(spark, sf_dir)
    items = T.order_items(spark, sf_dir).withColumn("quantity", F.col("quantity").cast("int"))
    j = J.join_on(orders, items, lambda o, oi: o("order_id") == oi("order_id"),
                  left_alias="o", right_alias="oi")
    return j.select(
        F.col("o.order_id"), F.col("o.user_id"), F.col("o.order_date"),
        F.col("oi.product_id"), F.col("oi.quantity"), F.col("oi.price"),
    )


@register(
    "join_left",
    O.with_model("""
SELECT u.user_id, u.name, u.city, l.order_date_max_per_user
FROM users_c u LEFT JOIN (SELECT user_id, max(order_date) AS order_date_max_per_user
                          FROM orders_c GROUP BY user_id HAVING max(order_date) >= DATE '1998-01-01') l
ON u.user_id = l.user_id""", fact=False),
)
def join_left(spark, sf_dir):
    """Users left-joined to the latest order of the users who still buy: the others keep a null."""
    m = R.clean(R.load_model(spark, sf_dir))
    last = m.orders.groupBy("user_id").agg(F.max("order_date").alias("order_date_max_per_user"))
    last = last.where(F.col("order_date_max_per_user") >= F.lit("1998-01-01").cast("date"))
    return J.join_using(m.users.select("user_id", "name", "city"), last, "user_id", how="left")


@register(
    "join_copartitioned",
    """
SELECT o_orderkey AS order_id, o_custkey AS user_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def join_copartitioned(spark, sf_dir):
    """Orders and items written in buckets of the order, joined without a shuffle."""
    orders = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    items = T.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity")
    )
    buckets = spark.sparkContext.defaultParallelism
    left, right = (P.write_buckets(df, "order_id", buckets, name) for df, name in ((orders, "orders"), (items, "items")))
    return P.join_buckets(spark, left, right).select("order_id", "user_id", "product_id", "quantity")
