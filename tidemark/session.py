"""Session defaults and the shared scratch/checkpoint folder.

Every session-level setting lives here; jobs do not mutate the session to
steer one query (join preferences are per-query hints instead). The one
exception is ``streaming.runner.state_width``: a stateful stream fixes its
state-store width at first start, so the width is set around the start and
restored right after.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults a job can rely on. ANSI stays on (Spark 4 default): bad casts
# raise, so edges use try_* functions explicitly.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when its output feeds an operator on the same
    # key (a per-user aggregate after the user join): AQE then adds a
    # shuffle after the split instead of leaving the hot key in one task
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# For streams whose state outgrows executor heaps (per-user counters over
# many users, complete-mode cubes): RocksDB keeps state off-heap and on local
# disk, checkpointed incrementally. Slower than the default store for small
# state, so it is opt-in. Fixed per checkpoint: choose it before first start.
LARGE_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
    large_state: bool = False,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``shuffle_partitions`` should be sized so one partition fits executor
    memory at the target scale; AQE coalesces small ones at runtime.
    ``large_state`` selects the RocksDB state store for streaming state.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    if large_state:
        conf.update(LARGE_STATE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scale_conf(
    input_bytes: float,
    total_cores: int,
    shuffle_blowup: float = 2.0,
    split_bytes: int = 512 * 1024 * 1024,
    reduce_bytes: int = 1024 * 1024 * 1024,
    max_shuffle_partitions: int = 100_000,
) -> dict[str, str]:
    """Session settings sized for a job reading ``input_bytes`` on a cluster
    with ``total_cores`` task slots.

    * scan splits of ``split_bytes`` (``maxPartitionBytes``): 100 TB gives
      about 200k scan tasks, each small enough for one task's memory;
    * initial shuffle width from the bytes a shuffle may carry (input times
      ``shuffle_blowup`` for decompressed, joined rows) over ``reduce_bytes``,
      at least two waves of all cores, and at most ``max_shuffle_partitions``:
      shuffle blocks grow as map tasks x reduce partitions, so past the cap
      partitions get larger instead (sort-based shuffle and aggregation
      spill, so a larger partition is slower, not fatal);
    * AQE coalesces small partitions toward half the reduce size and splits
      join partitions skewed beyond twice it; when the shuffle could not
      fill every core at that size, AQE keeps parallelism first instead;
    * a static broadcast only for inputs estimated under 64 MB; larger
      conversions are left to AQE, which sees measured sizes.
    """
    shuffle_bytes = input_bytes * shuffle_blowup
    shuffle_parts = math.ceil(shuffle_bytes / reduce_bytes)
    shuffle_parts = max(2 * total_cores, min(max_shuffle_partitions, shuffle_parts))
    fills_cores = shuffle_bytes >= (reduce_bytes // 2) * total_cores
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(reduce_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": str(not fills_cores).lower(),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * reduce_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir`` as the session or the cluster defaults set it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return configured or None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this must already be set (a shared file system visible to
    every executor). Only when it is unset - local runs and tests - do we
    fall back to a fresh local folder and register it with the context.
    """
    configured = configured_checkpoint_dir(spark)
    ctx_dir = spark.sparkContext.getCheckpointDir()
    if configured:
        if not ctx_dir:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if ctx_dir:
        # setCheckpointDir adds a unique child; reuse its parent as the root.
        return os.path.dirname(ctx_dir.rstrip("/"))
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder (HDFS/S3/...) visible to all executors"
        )
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
