"""Physical control: persistence and per-job settings (M1, M3, M4).

Join strategy is steered per query with hints (``operators.joins``), not by
mutating the session. The few session settings a job may need are applied
through ``session_conf``, which restores the previous values afterwards.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.joins import estimated_bytes

T = TypeVar("T")

LEVELS = {
    "DISK_ONLY": StorageLevel.DISK_ONLY,
    "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
    "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK,
    "MEMORY_AND_DISK_DESER": StorageLevel.MEMORY_AND_DISK_DESER,
}


def persist(df: DataFrame, level: str | StorageLevel = "MEMORY_AND_DISK") -> DataFrame:
    """Persist at a storage level (M1). A frame already persisted keeps its
    first level: Spark ignores a second ``persist`` with another level."""
    lvl = LEVELS[level] if isinstance(level, str) else level
    return df.persist(lvl)


def unpersist(df: DataFrame, blocking: bool = False) -> DataFrame:
    """Drop cached blocks; a no-op for a frame that was never cached."""
    return df.unpersist(blocking)


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back. Later passes (sampling, several joins, several reports)
    scan the files instead of recomputing the plan, and a lost executor
    does not force recomputation from the original sources."""
    from tidemark.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no footer-reading inference job on the way back
    return spark.read.schema(df.schema).parquet(path)


def few_parts(df: DataFrame, like: DataFrame, part_bytes: int = 1 << 18) -> DataFrame:
    """``df`` in no more partitions than a table of the size of ``like`` needs,
    one for each ``part_bytes`` of it. A shuffle is as wide as the session says,
    however little it holds; written like that, a small table becomes many tiny
    files, each with a task, a checksum file and, on Hadoop's local file system,
    started processes. Only the optimizer's estimate of ``like`` is taken, no
    job is run; without one, and for larger tables, ``df`` stays as it is."""
    size = estimated_bytes(like)
    return df if size is None else df.coalesce(max(1, -(-size // part_bytes)))


def run_concurrently(actions: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent Spark actions (writes, materialisations) from one
    driver thread each. Small jobs then fill idle cores instead of queueing
    behind each other; large ones share the cluster. The first failure is
    raised."""
    if len(actions) <= 1:
        return {k: fn() for k, fn in actions.items()}
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = {k: pool.submit(fn) for k, fn in actions.items()}
        return {k: f.result() for k, f in futures.items()}


def materialize_all(frames: Mapping[str, DataFrame], prefix: str = "materialized"
                    ) -> dict[str, DataFrame]:
    """``materialize`` several independent frames with concurrent jobs."""
    return run_concurrently(
        {k: (lambda df=v, name=f"{prefix}-{k}": materialize(df, name)) for k, v in frames.items()}
    )


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in ``spark.checkpoint.dir``
    (shared storage), so a lost executor does not force recomputation from
    the sources."""
    return df.checkpoint(eager)


@contextlib.contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Apply SQL settings for the duration of a block, then restore them.

    Used for AQE on/off in plan tests (M3) and shuffle width (M4). Note that
    a streaming query fixes ``spark.sql.shuffle.partitions`` in its
    checkpoint at the first run; later changes do not apply to it.
    """
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
