"""ANSI SQL (DuckDB dialect) for the correctness oracle.

The CTEs restate the logical-model mapping and the cleaning rules of
``tidemark.plans.retail`` independently, in SQL, over the raw test tables.
Money sums go through DECIMAL(28,6) and a mean is that sum over the count, so
both engines produce identical doubles.
"""

from __future__ import annotations


def money_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,6))) AS DOUBLE)"


def money_avg(x: str) -> str:
    return f"({money_sum(x)} / COUNT({x}))"


USERS_CTE = """
users_raw AS (
  SELECT c.c_custkey AS user_id, c.c_name AS name, n.n_name AS city,
         CAST(DATE '1995-01-01' + CAST((c.c_custkey * 7) % 2400 AS INTEGER) AS DATE) AS signup_date
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
users_c AS (
  SELECT user_id, name, city, signup_date FROM (
    SELECT user_id, name, trim(lower(city)) AS city, signup_date,
           row_number() OVER (PARTITION BY user_id ORDER BY name, trim(lower(city)), signup_date) AS rn
    FROM users_raw WHERE user_id IS NOT NULL) WHERE rn = 1
)"""

PRODUCTS_CTE = """
products_c AS (
  SELECT product_id, product_name, category, price FROM (
    SELECT p_partkey AS product_id, p_name AS product_name, trim(lower(p_type)) AS category,
           CAST(p_retailprice AS DOUBLE) AS price,
           row_number() OVER (PARTITION BY p_partkey
                              ORDER BY p_name, trim(lower(p_type)), p_retailprice) AS rn
    FROM part WHERE p_partkey IS NOT NULL) WHERE rn = 1
)"""

ORDERS_CTE = """
orders_c AS (
  SELECT order_id, user_id, order_date, total_amount FROM (
    SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
           CAST(o_totalprice AS DOUBLE) AS total_amount,
           row_number() OVER (PARTITION BY o_orderkey
                              ORDER BY o_custkey, CAST(o_orderdate AS DATE), o_totalprice) AS rn
    FROM orders WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL) WHERE rn = 1
)"""

ITEMS_CTE = """
items_c AS (
  SELECT order_id, product_id, quantity, price, quantity * price AS total_item_value FROM (
    SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DOUBLE) AS price,
           row_number() OVER (PARTITION BY l_orderkey, l_partkey
                              ORDER BY l_linenumber, l_suppkey, CAST(l_quantity AS INTEGER),
                                       l_extendedprice, l_shipdate) AS rn
    FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL) WHERE rn = 1
)"""


def user_features_cte(threshold: float = 500000) -> str:
    return """
last_order AS (
  SELECT user_id, max(order_date) AS order_date_max_per_user FROM orders_c GROUP BY user_id
),
users_f AS (
  SELECT u.user_id, u.name, u.city, u.signup_date, l.order_date_max_per_user,
         datediff('day', u.signup_date, l.order_date_max_per_user) AS user_tenure_days
  FROM users_c u LEFT JOIN last_order l ON u.user_id = l.user_id
),
users_s AS (
  SELECT *, CASE WHEN user_tenure_days <= 30 THEN 'new'
                 WHEN user_tenure_days > 30 AND user_tenure_days <= 180 THEN 'mature'
                 WHEN user_tenure_days > 180 THEN 'loyal'
                 ELSE 'no_order' END AS tenure_segment
  FROM users_f
)"""


FACT_CTE = """
fact AS (
  SELECT o.order_id, o.user_id, o.order_date, o.total_amount, i.product_id, i.quantity,
         i.price, i.total_item_value, p.product_name, p.category, p.price AS list_price,
         u.name, u.city, u.signup_date
  FROM orders_c o
  JOIN items_c i ON o.order_id = i.order_id
  JOIN products_c p ON i.product_id = p.product_id
  JOIN users_s u ON o.user_id = u.user_id
)"""


def with_model(body: str, threshold: float = 500000, fact: bool = True) -> str:
    ctes = [USERS_CTE, PRODUCTS_CTE, ORDERS_CTE, ITEMS_CTE, user_features_cte(threshold)]
    if fact:
        ctes.append(FACT_CTE)
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n" + body


USER_METRICS = f"""
SELECT user_id, name, city,
       {money_sum('total_amount')} AS user_total_spending,
       COUNT(DISTINCT order_id) AS user_total_orders,
       {money_avg('total_amount')} AS user_avg_order_value
FROM fact GROUP BY user_id, name, city"""
