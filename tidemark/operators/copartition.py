"""Co-partitioned storage: tables written in buckets of a join key, joined without
a shuffle (D1, D6).

Both sides are written once, ``buckets`` files each, dealt and sorted by the key.
A join on it then reads bucket against bucket; no row moves. That pays where the
same tables are joined again and again. What it can't do is split a key: a bucket
is one task, however large, and there is no shuffle that AQE could divide. So the
buckets' rows are counted once, hot ones are named, and a join over hot buckets
falls back to the shuffle join, which is split at runtime.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: A bucket with more than so many times the mean rows of a bucket is hot.
HOT = 4.0


@dataclass(frozen=True)
class Bucketed:
    """A table in buckets: its name in the session's catalog, its files, and the
    key and number of buckets it was written with."""

    name: str
    path: str
    key: str
    buckets: int
    hot: tuple[int, ...]

    def read(self, spark: SparkSession, in_buckets: bool = True) -> DataFrame:
        """Its rows, as a bucketed scan or (``in_buckets=False``) as plain files."""
        return spark.table(self.name) if in_buckets else spark.read.schema(spark.table(self.name).schema).parquet(self.path)


def bucket_of(key: str, buckets: int):
    """The bucket Spark puts a key in."""
    return F.pmod(F.hash(key), F.lit(buckets))


def bucket_rows(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows of every ``bucket`` that has some (map-side counted, at most
    ``buckets`` rows)."""
    return df.groupBy(bucket_of(key, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def hot_buckets(df: DataFrame, key: str, buckets: int, factor: float = HOT) -> list[int]:
    """Buckets with more than ``factor`` times the mean; at most
    ``buckets / factor`` numbers reach the driver."""
    counts = bucket_rows(df, key, buckets)
    mean = F.lit(df.count() / buckets)
    return sorted(r.bucket for r in counts.where(F.col("rows") > mean * factor).collect())


def write_buckets(df: DataFrame, key: str, buckets: int, name: str, factor: float = HOT) -> Bucketed:
    """Write ``df`` in buckets of ``key`` under the shared scratch folder. One
    shuffle by the key first, so that a bucket is one file, not one per task."""
    spark = df.sparkSession
    table, path = f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(spark, f"buckets-{name}")
    (
        df.repartition(buckets, key).write.format("parquet").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )
    written = spark.read.schema(df.schema).parquet(path)
    return Bucketed(table, path, key, buckets, tuple(hot_buckets(written, key, buckets, factor)))


def join_buckets(spark: SparkSession, left: Bucketed, right: Bucketed, how: str = "inner") -> DataFrame:
    """Join two tables written on the same key: bucket by bucket where none is
    hot, as a shuffle join over the plain files where one is."""
    if left.key != right.key or left.buckets != right.buckets:
        raise ValueError("the tables differ in key or buckets")
    in_buckets = not (left.hot or right.hot)
    a, b = left.read(spark, in_buckets), right.read(spark, in_buckets)
    return a.hint("merge").join(b, left.key, how) if in_buckets else a.join(b, left.key, how)
