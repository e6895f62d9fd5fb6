"""Scale rules as tests: plan shapes of every registered batch query, the
lost-executor/shared-folder rule, and a hot key holding a third of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.conftest import SF_SMALL
from tidemark.operators import cleaning as C
from tidemark.operators import joins as J
from tidemark.operators import windows as W
from tidemark import session

# Streaming queries return their sink's output read back (a plain scan); their
# own plans are covered by the streaming tests.
STREAMING = ("st_", "src_stream_json", "topk_window_struct")
# The only single-partition steps allowed, each over one row per sort partition
# (offsets of ranks, positions and running totals).
SINGLE_PARTITION_OK = {"win_cumulative", "win_dense_rank", "op11_importance_resampling"}
ROW_UDF_OK = {"udf_scalar"}  # the reference's row-at-a-time UDF demo


def _batch_keys():
    return sorted(k for k in queries() if not k.startswith(STREAMING))


@pytest.mark.parametrize("key", _batch_keys())
def test_plan_has_no_unbounded_single_task_step(spark, key):
    plan = J.plan_text(queries()[key](spark, SF_SMALL), "simple")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if key not in SINGLE_PARTITION_OK:
        # also rules out unpartitioned windows, which need one partition
        assert "SinglePartition" not in plan
    if key not in ROW_UDF_OK:
        assert "BatchEvalPython" not in plan


def test_dedup_pre_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = J.plan_text(C.dedup_keys(df, ["k"], order_by=["v"]), "simple")
    # one row per key and map task before the exchange, the final pick after
    assert plan.index("Exchange hashpartitioning") < plan.index("row_number(), 1, Partial")


def test_hot_key_holding_a_third_of_rows(spark):
    # key 0 holds a third of all rows; results must be whole and exact
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("v"),
        F.col("id").alias("id"),
    )
    dedup = C.dedup_keys(df, ["k"], order_by=["v", "id"])
    assert dedup.count() == 1 + (n - n // 3)
    hot = dedup.where("k = 0").collect()[0]
    assert (hot.v, hot.id) == (0, 0)
    ranked = {r.id: r.dense_rank for r in W.dense_rank_global(df, "k", partitions=4).collect()}
    ref = {r.id: r.dr for r in df.withColumn(
        "dr", F.dense_rank().over(Window.orderBy(F.col("k").desc()))).collect()}
    assert ranked == ref and len(ranked) == n


def test_scratch_refuses_a_local_folder_on_a_cluster(spark, monkeypatch):
    sc = spark.sparkContext
    monkeypatch.setattr(sc, "getCheckpointDir", lambda: None)
    monkeypatch.setattr(session, "configured_checkpoint_dir", lambda _: None)
    monkeypatch.setattr(sc, "master", "spark://cluster:7077")
    with pytest.raises(RuntimeError):
        session.checkpoint_root(spark)


def test_scratch_uses_the_configured_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "configured_checkpoint_dir", lambda _: "hdfs://nn/ckpt/")
    assert session.checkpoint_root(spark) == "hdfs://nn/ckpt"
    assert session.scratch_path(spark, "x").startswith("hdfs://nn/ckpt/x-")


def test_top_n_per_group_cuts_hot_groups_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 2).alias("city"), F.col("id").alias("gmv"))
    plan = J.plan_text(W.top_n_per_group(df, ["city"], "gmv", 3), "simple")
    # the partial limit keeps n rows per group and map task before the exchange
    assert plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert "WindowGroupLimit" in plan


def test_scale_conf_sizes_partitions():
    tb = 1024 ** 4
    big = session.scale_conf(100 * tb, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000  # capped
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 512 * 1024 ** 2
    small = session.scale_conf(10 * 1024 ** 3, total_cores=64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128  # two waves of cores
    mid = session.scale_conf(1 * tb, total_cores=200)
    assert int(mid["spark.sql.shuffle.partitions"]) == 2048
    # large input: the advisory size drives coalescing; small: parallelism
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert small["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "true"


def test_hot_order_is_split_in_the_star_join(spark, tmp):
    """A third of the order items belong to one order: AQE splits it in the join
    by order, which reads both sides through a fresh shuffle."""
    from tidemark.operators import control
    from tidemark.plans import retail as R

    def pq(df, name):
        df.write.parquet(f"{tmp}/{name}")
        return spark.read.parquet(f"{tmp}/{name}")

    n = 60_000
    items = pq(spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("order_id"),
        F.col("id").alias("product_id"), F.lit(1).alias("quantity"),
        (F.col("id") % 97).cast("double").alias("price")), "items")
    orders = pq(spark.range(5000).select(
        F.col("id").alias("order_id"), (F.col("id") % 500).alias("user_id"),
        F.current_date().alias("order_date"), F.lit(10.0).alias("total_amount")), "orders")
    products = pq(spark.range(n).select(
        F.col("id").alias("product_id"), F.lit("p").alias("product_name"),
        (F.col("id") % 5).cast("string").alias("category"), F.lit(1.0).alias("price")), "products")
    users = pq(spark.range(500).select(
        F.col("id").alias("user_id"), F.lit("n").alias("name"), F.lit("x").alias("city"),
        F.current_date().alias("signup_date")), "users")
    model = R.RetailModel(users=users, products=products, orders=orders, order_items=items)
    tiny = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    results, splits = [], []
    for written in (False, True):
        with control.session_conf(spark, tiny):
            m = R.clean(model)
            if written:
                m = R.materialize_dimensions(m)
            df = R.fact_table(R.add_features(m)).groupBy("category").agg(F.sum("price").alias("p"))
            results.append(sorted(df.collect()))
            splits.append(J.plan_text(df, "simple").count("skew=true"))
    assert results[0] == results[1]
    # orders with their users come to the join by order through a shuffle of their
    # own, so it is split in the plain model as well
    assert min(splits) >= 1
    # the per-user report counts a hot order's items on each task before they meet
    with control.session_conf(spark, tiny):
        m = R.add_features(R.materialize_dimensions(R.clean(model)))
        report = R.user_report(m)
        plan = J.plan_text(report, "simple")
        assert plan.index("Exchange hashpartitioning(order_id") < plan.index("functions=[partial_count(1)]")
        assert sorted(report.collect()) == sorted(R.user_spending(R.fact_table(m)).collect())


def test_skew_safe_model_reads_written_dimensions(spark):
    from tidemark.plans import retail as R
    m = R.prepared(spark, SF_SMALL, skew_safe_joins=True)
    for d in ("products", "orders"):
        assert all("/dim-" in f for f in getattr(m, d).inputFiles())
    plain = R.fact_table(R.prepared(spark, SF_SMALL))
    assert sorted(R.fact_table(m).collect()) == sorted(plain.collect())


def test_materialize_all_writes_concurrently_and_raises_failures(spark):
    from tidemark.operators import control
    good = spark.range(100).select(F.col("id").alias("k"))
    out = control.materialize_all({"a": good, "b": good.where("k < 10")}, "t")
    assert out["a"].count() == 100 and out["b"].count() == 10
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception, match="boom"):
        control.materialize_all({"good": good, "bad": bad}, "t")
