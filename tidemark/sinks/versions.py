"""Results that become visible whole or not at all.

A versioned table is a folder with one data folder per version and a small
Parquet table of commits. A version's data are written first and its commit row
last; readers take the newest committed version, so a write that dies midway
leaves the former result in place, and a version once committed is never
written again. Everything goes through Spark's readers and writers, so the folder
may be in any store they reach.

A batch table has several outputs that belong together: the commit row of a batch
makes its part of every output visible at once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_COMMITS = "version long"


def _data(path: str, version: int) -> str:
    return f"{path}/data/version={version}"


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_COMMITS).parquet(f"{path}/commits")


def newest(spark: SparkSession, path: str) -> int | None:
    """The newest committed version; one number reaches the driver. Only a
    missing folder means that there is none: any other error is raised."""
    try:
        return _commits(spark, path).agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _commit(spark: SparkSession, path: str, version: int) -> None:
    row = spark.range(1).select(F.lit(version).cast("long").alias("version"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/commits")


def publish(df: DataFrame, path: str, version: int | None = None, keep: int | None = None) -> int:
    """Replace the table at ``path`` by ``df`` and return the version (B1).

    ``version`` is the next one by default. One that is committed already, or
    older than a committed one, is left as it is: a batch that is run again
    after a failure changes nothing. ``keep`` deletes the data of all but the
    newest so many versions afterwards."""
    spark = df.sparkSession
    last = newest(spark, path)
    if version is None:
        version = 0 if last is None else last + 1
    elif last is not None and version <= last:
        return last
    df.write.mode("overwrite").parquet(_data(path, version))
    _commit(spark, path, version)
    if keep:
        retire(spark, path, keep)
    return version


def read(spark: SparkSession, path: str, schema: StructType | str | None = None,
         version: int | None = None) -> DataFrame:
    """The newest committed version (or the one asked for). ``schema`` spares
    the job that reads it from a file."""
    version = newest(spark, path) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no committed version in {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(_data(path, version))


def retire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete the data of all but the newest ``keep`` committed versions and
    return the versions deleted. A reader still on one of those fails, so keep
    as many as a read may last."""
    if keep < 1:
        raise ValueError("keep at least one version")
    kept = _commits(spark, path).distinct().orderBy(F.col("version").desc()).limit(keep)
    oldest = kept.agg(F.min("version")).first()[0]
    if oldest is None:
        return []
    gone = []
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        version = int(name.partition("=")[2]) if name.startswith("version=") else oldest
        if version < oldest:
            fs.delete(status.getPath(), True)
            gone.append(version)
    return sorted(gone)


def replace_each_batch(path: str, keep: int | None = 2) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for complete-mode results: each batch's whole result is
    the table's next version (a distributed write; nothing goes to the driver)."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        publish(batch, path, batch_id, keep)

    return _write


def split_each_batch(path: str, outputs: Mapping[str, Callable[[DataFrame], DataFrame]]
                     ) -> Callable[[DataFrame, int], None]:
    """foreachBatch body that writes several outputs of one batch (I12): the
    batch is computed once and persisted, each output's rows go to its own
    folder, and one commit row makes all of them visible."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = newest(spark, path)
        if last is not None and batch_id <= last:
            return
        batch.persist()
        try:
            for name, rows_of in outputs.items():
                rows_of(batch).write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()
        _commit(spark, path, batch_id)

    return _write


def read_output(spark: SparkSession, path: str, name: str, schema: StructType | str) -> DataFrame:
    """All committed rows of one output, with the number of their ``batch``."""
    declared = schema if isinstance(schema, str) else schema.toDDL()
    rows = spark.read.schema(f"{declared}, batch long").parquet(f"{path}/{name}")
    done = _commits(spark, path).select(F.col("version").alias("batch")).distinct()
    return rows.join(done, "batch", "left_semi")
