"""Streaming sinks.

Every durable sink takes a checkpoint location: the query's offsets and
state live there, so a restarted query resumes where it stopped and, with
the file sink or ``foreachBatch`` by batch number (``sinks.versions`` for results
that replace each other), writes each batch exactly once. The memory sink keeps the whole result on the driver and is
for tests only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.sinks import versions


def _trigger(writer: DataStreamWriter, trigger: Mapping | None) -> DataStreamWriter:
    return writer.trigger(**trigger) if trigger else writer


def as_kafka_record(
    df: DataFrame, key: str | Column | None = None, partition: str | Column | None = None
) -> DataFrame:
    """Project to Kafka's sink columns: ``value`` = JSON of the whole row
    (null fields omitted), optional ``key`` so one user's records stay on one
    partition (B5), optional explicit ``partition``."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key is not None:
        k = F.col(key) if isinstance(key, str) else key
        cols.insert(0, k.cast("string").alias("key"))
    if partition is not None:
        p = F.col(partition) if isinstance(partition, str) else partition
        cols.append(p.cast("int").alias("partition"))
    return df.select(*cols)


def start_kafka(
    df: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str,
    output_mode: str = "append", trigger: Mapping | None = None,
) -> StreamingQuery:
    """Publish a ``value`` (and optional ``key``) frame to a topic."""
    writer = (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
    return _trigger(writer, trigger).start()


def start_files(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
    output_mode: str = "append", trigger: Mapping | None = None,
    partition_by: Sequence[str] = (), query_name: str | None = None,
) -> StreamingQuery:
    """Exactly-once file sink (append only); also the Kafka stand-in."""
    writer = df.writeStream.format(fmt).option("path", path).option(
        "checkpointLocation", checkpoint
    ).outputMode(output_mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


def start_foreach_batch(
    df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
    output_mode: str = "append", trigger: Mapping | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch with a checkpoint."""
    writer = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).outputMode(
        output_mode
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


def append_updates_each_batch(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for update-mode results: append the changed rows
    tagged with the batch id; ``latest_state`` folds them to the end state.
    Re-running a batch after a failure rewrites only that batch's folder."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        # the folder name carries the batch id; readers discover it as a column
        batch.write.mode("overwrite").parquet(f"{path}/update_batch={batch_id}")

    return _write


def latest_state(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold an update log to one row per key: the row of the newest batch.
    ``row_number() = 1`` per key is planned with a partial group limit, so
    each map task keeps one row per key before the shuffle (no global sort).
    A key appears at most once per batch, so the newest row is unique."""
    rest = [c for c in updates.columns if c not in keys and c != "update_batch"]
    w = Window.partitionBy(*keys).orderBy(F.col("update_batch").desc())
    newest = updates.withColumn("_newest", F.row_number().over(w)).where(F.col("_newest") == 1)
    return newest.select(*keys, *rest)


def compact_updates(updates: DataFrame, keys: Sequence[str], snapshot_path: str,
                    keep: int | None = 2) -> int | None:
    """Fold an update log once into a snapshot, so later reads need only the
    batches after it. The snapshot is a version of the table at ``snapshot_path``,
    numbered by the newest batch folded (returned; one number reaches the
    driver) and visible only once it is whole. It starts from the newest
    snapshot there, so batch folders that a snapshot covers are not read again
    and may be retired; older snapshots are deleted but for ``keep``."""
    spark = updates.sparkSession
    before = versions.newest(spark, snapshot_path)
    newer = updates if before is None else updates.where(F.col("update_batch") > before)
    upto = newer.agg(F.max("update_batch")).first()[0]
    if upto is None:
        return before
    newer = newer.where(F.col("update_batch") <= upto)
    state = latest_state(newer if before is None else _on_snapshot(spark, snapshot_path, before, newer), keys)
    return versions.publish(state.withColumn("update_batch", F.lit(int(upto))), snapshot_path, int(upto), keep)


def read_state(spark, updates_path: str, keys: Sequence[str],
               snapshot_path: str | None = None) -> DataFrame:
    """End state of an update log: the newest snapshot (if any) plus only
    the batch folders written after it (pruned by the ``update_batch``
    folder value), folded with ``latest_state``."""
    updates = spark.read.parquet(updates_path)
    upto = versions.newest(spark, snapshot_path) if snapshot_path else None
    if upto is None:
        return latest_state(updates, keys)
    return latest_state(_on_snapshot(spark, snapshot_path, upto, updates.where(F.col("update_batch") > upto)), keys)


def _on_snapshot(spark, snapshot_path: str, upto: int, newer: DataFrame) -> DataFrame:
    snap = versions.read(spark, snapshot_path, version=upto)
    return snap.withColumn("update_batch", F.col("update_batch").cast("int")).unionByName(
        newer.withColumn("update_batch", F.col("update_batch").cast("int")))


def start_console(
    df: DataFrame, output_mode: str = "append", truncate: bool = False, num_rows: int = 20,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Print each batch (B6 append, B7 complete); for debugging only."""
    writer = (
        df.writeStream.format("console").outputMode(output_mode)
        .option("truncate", truncate).option("numRows", num_rows)
    )
    return _trigger(writer, trigger).start()


def start_memory(
    df: DataFrame, name: str, output_mode: str = "complete", checkpoint: str | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Named in-memory table queryable with ``spark.sql`` (B8 complete, B9
    append). The table lives on the driver: tests and small demos only."""
    writer = df.writeStream.format("memory").queryName(name).outputMode(output_mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()
