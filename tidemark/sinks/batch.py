"""Batch sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Parquet output; ``overwrite`` makes re-runs idempotent (B1).

    ``partition_by`` lays files out by column value so later readers prune
    whole directories.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "append",
    truncate: bool = False,
    batch_size: int | None = None,
    num_partitions: int | None = None,
) -> None:
    """Write to a JDBC table (B2). ``truncate`` only matters with overwrite:
    the table is emptied instead of dropped and re-created. Each partition
    writes over its own connection; ``num_partitions`` caps the number of
    concurrent connections."""
    props = dict(properties or {})
    if truncate:
        props["truncate"] = "true"
    if batch_size:
        props["batchsize"] = str(batch_size)
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.mode(mode).jdbc(url, table, properties=props)


def preview(df: DataFrame, n: int = 20) -> pd.DataFrame:
    """A bounded sample as pandas (B11): always through a limit."""
    return df.limit(n).toPandas()
