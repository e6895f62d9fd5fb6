"""Registered queries: fact table, aggregates, windows, sort/limit (D6, E, F, G, H1-H4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators import aggregate as A
from tidemark.operators import control
from tidemark.operators import ordering as G
from tidemark.plans import oracle as O
from tidemark.plans import retail as R
from tidemark.plans.registry import register
from tidemark.sources import tables as T

# The test orders never exceed 500,000 (max about 499,979), so the oracle
# queries pass a lower threshold to make both labels appear.
TEST_HIGH_VALUE_THRESHOLD = 250000

FACT_COLUMNS = [
    "order_id", "user_id", "order_date", "total_amount", "product_id", "quantity", "price",
    "total_item_value", "category", "list_price", "name", "city",
]


def _model(spark, sf_dir):
    """Written dimensions; no report below reads the tenure."""
    return R.prepared(spark, sf_dir, skew_safe_joins=True, tenure=False)


def _user_report(spark, sf_dir):
    return control.materialize(R.user_report(_model(spark, sf_dir)), "user-report")


def _fact(spark, sf_dir):
    return R.fact_table(_model(spark, sf_dir))


@register("join_star_fact", O.with_model(f"SELECT {', '.join(FACT_COLUMNS)} FROM fact"))
def join_star_fact(spark, sf_dir):
    return _fact(spark, sf_dir).select(*FACT_COLUMNS)


@register(
    "agg_daily_category",
    O.with_model(f"""
SELECT order_date, category,
       {O.money_sum('total_item_value')} AS daily_gmv_category,
       COUNT(DISTINCT order_id) AS daily_orders_category,
       CAST(SUM(quantity) AS BIGINT) AS daily_items_sold
FROM fact GROUP BY order_date, category
ORDER BY order_date, daily_gmv_category DESC"""),
)
def agg_daily_category(spark, sf_dir):
    return R.daily_category_report(_model(spark, sf_dir))


@register(
    "agg_city",
    O.with_model(f"""
SELECT city, {O.money_sum('total_item_value')} AS total_gmv_city,
       {O.money_avg('total_amount')} AS aov_city,
       COUNT(DISTINCT user_id) AS unique_customers
FROM fact GROUP BY city ORDER BY total_gmv_city DESC"""),
)
def agg_city(spark, sf_dir):
    return R.city_sales(_fact(spark, sf_dir))


@register(
    "win_rank_topn",
    O.with_model(f"""
SELECT city, category, gmv_per_category, rank FROM (
  SELECT city, category, gmv_per_category,
         CAST(rank() OVER (PARTITION BY city ORDER BY gmv_per_category DESC) AS INTEGER) AS rank
  FROM (SELECT city, category, {O.money_sum('total_item_value')} AS gmv_per_category
        FROM fact GROUP BY city, category)) WHERE rank <= 3"""),
)
def win_rank_topn(spark, sf_dir):
    return R.top_categories_per_city(_fact(spark, sf_dir))


@register("agg_user_metrics", O.with_model(O.USER_METRICS))
def agg_user_metrics(spark, sf_dir):
    return R.user_report(_model(spark, sf_dir))


@register(
    "agg_user_metrics_order_grain",
    O.with_model(f"""
SELECT u.user_id, u.name, u.city, m.user_total_spending, m.user_total_orders, m.user_avg_order_value
FROM users_c u JOIN (
  SELECT user_id, {O.money_sum('total_amount')} AS user_total_spending,
         COUNT(order_id) AS user_total_orders, {O.money_avg('total_amount')} AS user_avg_order_value
  FROM orders_c WHERE order_id IN (SELECT order_id FROM items_c) GROUP BY user_id) m
ON u.user_id = m.user_id""", fact=False),
)
def agg_user_metrics_order_grain(spark, sf_dir):
    return R.user_metrics_order_grain(R.prepared(spark, sf_dir))


@register(
    "win_dense_rank",
    O.with_model(f"""
SELECT *, CAST(dense_rank() OVER (ORDER BY user_total_spending DESC) AS INTEGER) AS user_rank
FROM ({O.USER_METRICS})"""),
)
def win_dense_rank(spark, sf_dir):
    return R.ranked_users(None, _user_report(spark, sf_dir))


@register(
    "win_cumulative",
    O.with_model("""
SELECT order_date, CAST(gmv AS DOUBLE) AS gmv_daily,
       CAST(SUM(gmv) OVER (ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS cumulative_gmv
FROM (SELECT order_date, SUM(CAST(total_item_value AS DECIMAL(18,2))) AS gmv
      FROM fact GROUP BY order_date)"""),
)
def win_cumulative(spark, sf_dir):
    return R.cumulative_gmv(_fact(spark, sf_dir))


@register(
    "win_top10",
    O.with_model(f"""
SELECT user_id, name, city, user_total_orders, user_total_spending, user_avg_order_value, user_rank
FROM (SELECT *, CAST(dense_rank() OVER (ORDER BY user_total_spending DESC) AS INTEGER) AS user_rank
      FROM ({O.USER_METRICS})) WHERE user_rank <= 10"""),
)
def win_top10(spark, sf_dir):
    return R.top_customers(None, metrics=_user_report(spark, sf_dir))


@register(
    "fn_tenure_segment",
    O.with_model("""
SELECT user_id, signup_date, order_date_max_per_user,
       CAST(user_tenure_days AS INTEGER) AS user_tenure_days, tenure_segment
FROM users_s""", fact=False),
)
def fn_tenure_segment(spark, sf_dir):
    return R.user_segments(R.prepared(spark, sf_dir))


@register(
    "agg_max",
    O.with_model("SELECT user_id, order_date_max_per_user FROM last_order", fact=False),
)
def agg_max(spark, sf_dir):
    orders = R.clean(R.load_model(spark, sf_dir)).orders
    return A.grouped_max(orders, ["user_id"], "order_date", "order_date_max_per_user")


@register(
    "fn_order_flag",
    O.with_model(f"""
SELECT order_id, total_amount,
       CASE WHEN total_amount > {TEST_HIGH_VALUE_THRESHOLD} THEN 'high_value' ELSE 'normal' END
         AS order_value_flag
FROM orders_c""", fact=False),
)
def fn_order_flag(spark, sf_dir):
    m = R.prepared(spark, sf_dir, high_value_threshold=TEST_HIGH_VALUE_THRESHOLD)
    return m.orders.select("order_id", "total_amount", "order_value_flag")


@register(
    "fn_gmv",
    O.with_model(
        "SELECT order_id, product_id, quantity, price, total_item_value FROM items_c", fact=False
    ),
)
def fn_gmv(spark, sf_dir):
    items = R.prepared(spark, sf_dir).order_items
    return items.select("order_id", "product_id", "quantity", "price", "total_item_value")


@register(
    "agg_sum",
    O.with_model(f"""
SELECT category, {O.money_sum('total_item_value')} AS gmv FROM fact GROUP BY category"""),
)
def agg_sum(spark, sf_dir):
    return A.aggregate(_fact(spark, sf_dir), ["category"], {"gmv": S.money_sum("total_item_value")})


@register(
    "agg_avg",
    O.with_model(f"""
SELECT category, {O.money_avg('total_amount')} AS avg_order_value FROM fact GROUP BY category"""),
)
def agg_avg(spark, sf_dir):
    return A.aggregate(
        _fact(spark, sf_dir), ["category"], {"avg_order_value": S.money_avg("total_amount")}
    )


@register(
    "agg_count_distinct",
    O.with_model("""
SELECT category, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT user_id) AS customers
FROM fact GROUP BY category"""),
)
def agg_count_distinct(spark, sf_dir):
    return A.count_distinct_each(_fact(spark, sf_dir), ["category"], {"orders": "order_id", "customers": "user_id"})


@register(
    "agg_dict",
    """
SELECT o_custkey AS customer_id, CAST(SUM(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(18,2)))
       AS DOUBLE) AS total_purchase_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""",
)
def agg_dict(spark, sf_dir):
    items = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    purchases = items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"),
        (F.col("l_quantity").cast("int") * S.money("l_extendedprice")).alias("total_price"),
    )
    out = A.agg_dict(purchases, ["customer_id"], {"total_price": "sum"},
                     names={"total_price": "total_purchase_amount"})
    return out.withColumn("total_purchase_amount", F.col("total_purchase_amount").cast("double"))


@register(
    "sort_multi",
    O.with_model(
        "SELECT order_id, user_id, order_date, total_amount FROM orders_c "
        "ORDER BY order_date, total_amount DESC, order_id",
        fact=False,
    ),
)
def sort_multi(spark, sf_dir):
    orders = R.clean(R.load_model(spark, sf_dir)).orders
    return G.sort_by(orders, [("order_date", "asc"), ("total_amount", "desc"), ("order_id", "asc")])


@register(
    "limit_n",
    O.with_model(
        "SELECT order_id, user_id, order_date, total_amount FROM orders_c "
        "ORDER BY total_amount DESC, order_id LIMIT 10",
        fact=False,
    ),
)
def limit_n(spark, sf_dir):
    orders = R.clean(R.load_model(spark, sf_dir)).orders
    return G.top_k(orders, [("total_amount", "desc"), ("order_id", "asc")], 10)


@register(
    "agg_count",
    "SELECT event_type AS gt, COUNT(*) AS count FROM events GROUP BY event_type",
)
def agg_count(spark, sf_dir):
    """Grouped count on a bounded table (E5); the streaming form is st_count_by_key."""
    return A.grouped_count(T.activity(spark, sf_dir), ["gt"])


@register(
    "agg_cube",
    """
SELECT gt, "User", avg("Index") AS "avg_Index", avg("User") AS "avg_User",
       CAST(SUM(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / COUNT(value) AS avg_value,
       CAST(GROUPING(gt) * 2 + GROUPING("User") AS BIGINT) AS grouping_id
FROM (SELECT event_id AS "Index", user_id AS "User", event_type AS gt, value FROM events)
GROUP BY CUBE (gt, "User")""",
)
def agg_cube(spark, sf_dir):
    """cube(gt, User).avg() over every numeric column, with the grouping id
    that tells a subtotal null from a real null (E7)."""
    act = T.activity(spark, sf_dir).select("gt", "User", "Index", S.money("value").alias("value"))
    return A.cube_avg(act, ["gt", "User"], with_grouping_id=True)
