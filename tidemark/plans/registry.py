"""Registry of named queries: ``key -> (spark, sf_dir) -> DataFrame`` plus the
matching oracle SQL (absent for operators SQL cannot express)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}

_MODULES = (
    "tidemark.plans.q_retail",
    "tidemark.plans.q_cleaning",
    "tidemark.plans.q_joins",
    "tidemark.plans.q_functions",
    "tidemark.plans.q_sources",
    "tidemark.plans.q_streaming",
    "tidemark.plans.q_resume",
)


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _ORACLE[key] = sql
        return fn

    return deco


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(name)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
