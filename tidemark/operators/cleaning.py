"""Projection, typing and cleaning (group C). DataFrame in, DataFrame out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tidemark.functions.scalar import normalize_text, parse_datetime


def select_columns(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Select, optionally renaming: ``{"new": "old"}`` or a list of names."""
    if isinstance(columns, Mapping):
        return df.select(*[F.col(src).alias(dst) for dst, src in columns.items()])
    return df.select(*columns)


def flatten_struct(df: DataFrame, struct_col: str) -> DataFrame:
    """``select('s.*')``: a null struct yields all-null columns."""
    return df.select(f"{struct_col}.*")


def select_expr(df: DataFrame, *exprs: str) -> DataFrame:
    """SQL-expression projection, ``*`` allowed."""
    return df.selectExpr(*exprs)


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = True) -> DataFrame:
    """Cast columns in place (C4). ``safe`` turns bad input into NULL, as Spark 3
    did without ANSI; with ``safe=False`` a bad value fails the query."""
    return df.withColumns(
        {c: (F.col(c).try_cast(t) if safe else F.col(c).cast(t)) for c, t in types.items()}
    )


def to_date_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text/timestamp to date, NULL when unparseable."""
    return df.withColumns({c: F.col(c).try_cast("date") for c in cols})


def to_timestamp_columns(
    df: DataFrame, cols: Iterable[str], pattern: str | None = None
) -> DataFrame:
    """Patterned (C6) or ISO-8601 (C7, ``pattern=None``) text to timestamp.

    Date/timestamp-typed columns are cast, not parsed; unparseable text is NULL.
    """
    out = {}
    for c in cols:
        dtype = dict(df.dtypes)[c]
        if dtype == "string":
            out[c] = parse_datetime(c, pattern)
        else:
            out[c] = F.col(c).cast("timestamp")
    return df.withColumns(out)


def rename_drop(
    df: DataFrame, renames: Mapping[str, str] | None = None, drop: Iterable[str] = ()
) -> DataFrame:
    """Rename and drop; unknown names are silent no-ops."""
    if renames:
        df = df.withColumnsRenamed(dict(renames))
    drop = list(drop)
    return df.drop(*drop) if drop else df


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows where any key is null."""
    return df.dropna(how="any", subset=list(keys))


def keep_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every column is > 0; nulls are dropped."""
    cond: Column | None = None
    for c in cols:
        term = F.col(c) > 0
        cond = term if cond is None else cond & term
    return df.filter(cond)


def normalize_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """lower + trim the given text columns (C11)."""
    return df.withColumns({c: normalize_text(c) for c in cols})


def dedup_keys(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key with a deterministic survivor.

    The survivor is the row whose ``order_by`` columns, then the remaining
    columns, are smallest (nulls first): ``row_number() = 1`` over the key.
    Spark plans it with a partial ``WindowGroupLimit`` before the shuffle, so
    each map task keeps one row per key: a key holding a third of all rows
    costs one row per map task, not a hot reducer. Null keys compare equal,
    as with ``dropDuplicates``. Map-typed columns cannot be ordered; rows
    that differ only there keep an arbitrary survivor.
    """
    keys = list(keys)
    order_by = list(order_by or [])
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if not order_by and not rest:
        return df.select(*keys).distinct()
    types = {f.name: f.dataType for f in df.schema.fields}
    ordering = [F.col(c).asc_nulls_first() for c in order_by + rest
                if not isinstance(types[c], MapType)]
    if not ordering:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_survivor", F.row_number().over(w)).where(
        F.col("_survivor") == 1
    ).drop("_survivor")


def distinct_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropDuplicates(keys)`` as the reference wrote it: survivor arbitrary."""
    return df.dropDuplicates(list(keys))


def filter_where(df: DataFrame, condition: str | Column) -> DataFrame:
    """Boolean-column or SQL-text predicate."""
    return df.where(condition)
