"""Streaming sources.

Kafka is the production transport. Its connector is not on this
environment's class path, so tests use a *file stand-in*: Parquet files that
carry exactly the Kafka source's envelope columns. Everything downstream of
the source reads the same columns either way.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Columns of the Kafka source (and of the file stand-in).
ENVELOPE_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("timestampType", IntegerType(), True),
])


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str,
    max_files_per_trigger: int | None = None,
    path_glob: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Replayed file stream (A7). A streaming file source needs an explicit
    schema; ``max_files_per_trigger`` throttles how many new files one
    micro-batch takes (I15). Files are taken in modification-time order."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def kafka_options(
    bootstrap_servers: str,
    subscribe: str | Sequence[str] | None = None,
    assign: Mapping[str, Sequence[int]] | None = None,
    starting_offsets: str | Mapping = "latest",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool | None = None,
) -> dict[str, str]:
    """Options for ``readStream.format('kafka')``.

    * ``subscribe``: topic name(s) (A8);
    * ``starting_offsets='earliest'`` reads a topic from the start (A9); the
      position is kept in the query checkpoint, so no consumer group is
      needed (``group_id`` sets ``kafka.group.id`` only where ACLs require it);
    * ``assign={"t": [2]}`` reads chosen partitions, and a dict
      ``{"t": {"2": -2}}`` as ``starting_offsets`` starts them from the
      beginning (A10). Spark never commits offsets back to Kafka.
    """
    if (subscribe is None) == (assign is None):
        raise ValueError("give exactly one of subscribe / assign")
    opts = {"kafka.bootstrap.servers": bootstrap_servers}
    if subscribe is not None:
        opts["subscribe"] = subscribe if isinstance(subscribe, str) else ",".join(subscribe)
    else:
        opts["assign"] = json.dumps({t: list(p) for t, p in assign.items()})
    opts["startingOffsets"] = (
        starting_offsets if isinstance(starting_offsets, str) else json.dumps(starting_offsets)
    )
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if fail_on_data_loss is not None:
        opts["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return opts


EARLIEST, LATEST = -2, -1
Offsets = Mapping[str, Mapping[int, int]]


def offset_range(envelope: DataFrame, starting: Offsets, ending: Offsets | None = None) -> DataFrame:
    """The records of chosen partitions between two offsets (A9-A11), from a
    frame with the envelope columns, bounded or streaming.

    ``starting`` is ``{topic: {partition: offset}}``, its offset included, and
    names all partitions that are read; ``ending`` gives the first offset that
    is not read any more. ``EARLIEST`` and ``LATEST`` leave a side open; a
    partition without an ending is read on. The position of a streaming reader
    is kept in its checkpoint alone: nothing is committed to the topic."""
    wanted = F.lit(False)
    for topic, partitions in starting.items():
        for partition, first in partitions.items():
            last = ((ending or {}).get(topic) or {}).get(partition, LATEST)
            if first == LATEST or last == EARLIEST:
                raise ValueError("a range starts at the latest or ends at the earliest offset")
            here = (F.col("topic") == topic) & (F.col("partition") == partition)
            if first != EARLIEST:
                here = here & (F.col("offset") >= first)
            if last != LATEST:
                here = here & (F.col("offset") < last)
            wanted = wanted | here
    return envelope.where(wanted)


def kafka_range_options(bootstrap_servers: str, starting: Offsets, ending: Offsets | None = None) -> dict[str, str]:
    """Options of a bounded ``spark.read.format('kafka')`` over the same range
    as ``offset_range``. Kafka wants an ending for every partition that starts."""
    full = {t: {p: ((ending or {}).get(t) or {}).get(p, LATEST) for p in parts} for t, parts in starting.items()}
    as_json = lambda offsets: json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in offsets.items()})
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "assign": json.dumps({t: list(parts) for t, parts in starting.items()}),
        "startingOffsets": as_json(starting),
        "endingOffsets": as_json(full),
    }


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Kafka topic as a streaming frame with the envelope columns.
    Needs the spark-sql-kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**dict(options)).load()


def read_envelope_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """File stand-in for a Kafka topic: Parquet files with the envelope
    columns (A11), replayed as a stream."""
    return stream_files(spark, path, "parquet", ENVELOPE_SCHEMA, max_files_per_trigger)
