"""JDBC source.

A plain ``spark.read.jdbc`` pulls the whole table through one connection in
one task. For large tables pass ``partition_column`` with bounds so Spark
issues ``num_partitions`` range queries in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
) -> DataFrame:
    props = dict(properties or {})
    if fetch_size:
        props["fetchsize"] = str(fetch_size)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need bounds and num_partitions")
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound,
            upperBound=upper_bound, numPartitions=num_partitions, properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)
