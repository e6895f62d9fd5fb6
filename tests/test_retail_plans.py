"""Aggregation before joins, distinct counts without row expansion, bucketed joins."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import aggregate as A
from tidemark.operators import copartition as P
from tidemark.operators import joins as J
from tidemark.operators.control import session_conf
from tidemark.plans import retail as R

NO_BROADCAST = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def same(a, b):
    key = lambda r: tuple((v is None, v) for v in r)
    return sorted(a.collect(), key=key) == sorted(b.select(*a.columns).collect(), key=key)


def faulty_model(spark):
    """Orders without items, items without order, product or amount, users unknown."""
    rnd = random.Random(4)
    day = F.lit("2024-01-01").cast("date")
    users = spark.range(20).select(F.col("id").alias("user_id"), F.concat(F.lit("n"), "id").alias("name"),
                                   F.when(F.col("id") % 4 > 0, (F.col("id") % 3).cast("string")).alias("city"), day.alias("signup_date"))
    orders = spark.createDataFrame(
        [(k, rnd.randrange(25), rnd.choice([None, 1.25, 7.5, 1000.0])) for k in range(120)], "order_id long, user_id long, total_amount double"
    ).withColumn("order_date", F.date_add(day, (F.col("order_id") % 5).cast("int")))
    products = spark.range(15).select(F.col("id").alias("product_id"), F.lit("p").alias("product_name"),
                                      F.when(F.col("id") > 1, (F.col("id") % 4).cast("string")).alias("category"), F.lit(1.0).alias("price"))
    rows = [(rnd.randrange(140) if rnd.random() < 0.7 else 3, rnd.randrange(18), rnd.choice([None, 1, 5]), rnd.choice([0.01, 3.333333, None])) for _ in range(900)]
    items = spark.createDataFrame(rows, "order_id long, product_id long, quantity int, price double")
    return R.add_features(R.clean(R.RetailModel(users, products, orders, items)), tenure=False)


@pytest.mark.parametrize("made", [False, True])
def test_reports_from_order_partials_equal_those_from_the_fact(spark, made):
    model = faulty_model(spark) if made else R.prepared(spark, SF_SMALL, tenure=False)
    fact = R.fact_table(model)
    assert same(R.user_spending(fact), R.user_report(model))
    assert same(R.category_days(fact), R.daily_category_report(model))


def test_items_are_shuffled_three_times_at_most(spark):
    model = R.prepared(spark, SF_SMALL, skew_safe_joins=True, tenure=False)
    with session_conf(spark, NO_BROADCAST):
        fact = J.plan_text(R.fact_table(model), "simple")
        # their de-duplication, the join by product and the join by order (each with its other side)
        assert fact.count("Exchange hashpartitioning") == 5
        users = J.plan_text(R.user_report(model), "simple")
    # orders join the partials where the partials lie: by order, without another shuffle of them
    below_orders = users[users.index("HashAggregate(keys=[order_id"):]
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+L, \d+\)", below_orders)) == 2 and "Expand" not in users


def test_distinct_counts_of_several_columns(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, "a", "b", "c"]), rnd.choice([None, *range(40)]), rnd.choice([None, "x", "y"])) for _ in range(2000)]
    df = spark.createDataFrame([*rows, ("only nulls", None, None)], "g string, v int, w string")
    got = A.count_distinct_each(df, ["g"], {"vs": "v", "ws": "w", "again": "v"})
    assert "Expand" not in J.plan_text(got, "simple")
    want = df.groupBy("g").agg(F.countDistinct("v").alias("vs"), F.countDistinct("w").alias("ws"), F.countDistinct("v").alias("again"))
    assert same(want, got)
    whole = A.count_distinct_each(df, [], {"vs": "v", "ws": "w"}).collect()
    assert [tuple(r) for r in whole] == [(40, 2)]


def test_mean_of_a_decimal_is_not_cut(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, None)], "g string, v int").withColumn("v", F.col("v").cast("decimal(28,6)"))
    got = {(r.g, r.grouping_id): r.avg_v for r in A.cube_avg(df, ["g"], with_grouping_id=True).collect()}
    assert got == {("a", 0): 1.5, ("b", 0): 2.0, (None, 0): None, (None, 1): 5 / 3}


def test_bucketed_join_moves_no_row(spark):
    left = spark.range(3000).select((F.col("id") % 700).alias("k"), "id")
    right = spark.range(500).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("k"), (F.col("id") * 2).alias("v"))
    a, b = P.write_buckets(left, "k", 8, "a"), P.write_buckets(right, "k", 8, "b")
    assert not a.hot and not b.hot
    with session_conf(spark, NO_BROADCAST):
        joined = P.join_buckets(spark, a, b)
        assert "Exchange" not in J.plan_text(joined, "simple")
        assert same(left.join(right, "k"), joined)
        assert same(left.join(right, "k", "left"), P.join_buckets(spark, a, b, "left"))
    with pytest.raises(ValueError):
        P.join_buckets(spark, a, P.write_buckets(right, "v", 8, "c"))


def test_a_hot_bucket_is_named_and_joined_by_shuffle(spark):
    left = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v"))
    a, b = P.write_buckets(left, "k", 32, "a"), P.write_buckets(right, "k", 32, "b")
    hot = left.where("k = 7").select(P.bucket_of("k", 32).alias("b"))
    assert list(a.hot) == [hot.first().b] and not b.hot
    rows = {r.bucket: r["rows"] for r in P.bucket_rows(left, "k", 32).collect()}
    assert sum(rows.values()) == 4000 and rows[a.hot[0]] > 1334
    with session_conf(spark, NO_BROADCAST):
        joined = P.join_buckets(spark, a, b)
        assert J.plan_text(joined, "simple").count("Exchange hashpartitioning") == 2  # which AQE can split
        assert same(left.join(right, "k"), joined)
    empty = P.write_buckets(left.limit(0), "k", 32, "none")
    assert not empty.hot and P.join_buckets(spark, empty, b).count() == 0
