"""Batch file sources (A1-A5).

Schema inference costs an extra pass over the input; at scale pass an
explicit schema (``schema=``) and keep inference for exploration.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CSV_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header (A1). Without ``schema`` the types are inferred.

    ``mode`` handles broken lines (A2): PERMISSIVE keeps them with nulls (and
    the raw text in ``corrupt_column`` if that column is in the schema),
    DROPMALFORMED drops them, FAILFAST raises on the first one. A query that
    reads no column (a bare ``count()``) does not parse lines at all, so
    malformed lines are only detected when columns are read.
    """
    if mode not in CSV_MODES:
        raise ValueError(f"mode must be one of {CSV_MODES}")
    reader = spark.read.option("header", header).option("mode", mode)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_json_dir(
    spark: SparkSession, path: str, schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """JSON-lines file or directory (A3); schema inferred unless given.

    Column references resolve case-insensitively (Spark's default), so
    ``Creation_time`` and ``Creation_Time`` name the same field.
    """
    reader = spark.read
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def schema_from_json(doc: str | Mapping[str, Any], spark: SparkSession | None = None) -> StructType:
    """Spark schema JSON document (text, dict, or a file path) -> StructType (A4).

    With ``spark`` a path is read by Spark, so it can be on any file system the
    session reaches; without it, it is a file of the driver's machine. Keys Spark
    does not know (for example a ``"unique"`` flag on a field) are ignored.
    """
    if isinstance(doc, str):
        text = doc
        if not doc.lstrip().startswith("{"):
            text = _document(doc, spark)
        doc = json.loads(text)
    return StructType.fromJson(dict(doc))


def _document(path: str, spark: SparkSession | None) -> str:
    if spark is None:
        with open(path, encoding="utf-8") as fh:
            return fh.read()
    found = spark.read.text(path, wholetext=True).take(2)
    if len(found) != 1:
        raise ValueError(f"{path} is not one schema document")
    return found[0].value


def inline(
    spark: SparkSession, rows: Iterable[tuple], schema: StructType | str | list[str]
) -> DataFrame:
    """Small literal table from tuples with a DDL string, StructType or name
    list (A5). Only for bounded lookup data: it travels from the driver."""
    return spark.createDataFrame(list(rows), schema=schema)
