"""Grouped aggregation (group E).

Spark plans every grouped aggregate as partial (map-side) + final hash
aggregation, so a hot key is pre-reduced on each map task before the
shuffle. An exact distinct count is a two-level aggregate keyed on (group, value),
which spreads a hot group as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType

from tidemark.operators import control

_FUNCS = {
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def aggregate(df: DataFrame, keys: Sequence[str | Column], measures: Mapping[str, Column]) -> DataFrame:
    """``groupBy(keys).agg(alias -> expression)``; output columns are named."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in measures.items()])


def count_distinct_each(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str],
                        materialize: bool = True) -> DataFrame:
    """Exact distinct counts of several columns (E3), alias -> column.

    One ``count(DISTINCT)`` is a two-level aggregate on (keys, value) already;
    several in one ``agg`` make Catalyst expand every row once per column.
    Here each column gets its own two levels, and the counts, one row per
    group, are joined on the keys (null keys are a group; a group whose values
    are all null counts 0). The narrow input is read once per column, so by
    default it is written once."""
    keys = list(keys)
    names = list(dict.fromkeys(columns.values()))
    narrow = df.select(*keys, *[F.col(c).alias(f"_v{i}") for i, c in enumerate(names)])
    if materialize and len(columns) > 1:
        narrow = control.materialize(narrow, "distinct-input")
    out = None
    for alias, column in columns.items():
        value = f"_v{names.index(column)}"
        counts = narrow.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias(alias))
        if out is None:
            out = counts
            continue
        if not keys:
            out = out.crossJoin(counts)  # one row each
            continue
        right = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], alias)
        same = [out[k].eqNullSafe(right[f"_k{i}"]) for i, k in enumerate(keys)]
        out = out.join(right, same).drop(*[f"_k{i}" for i in range(len(keys))])
    return out


def grouped_max(df: DataFrame, keys: Sequence[str], col: str, alias: str) -> DataFrame:
    """Latest value per key."""
    return df.groupBy(*keys).agg(F.max(col).alias(alias))


def grouped_count(df: DataFrame, keys: Sequence[str], alias: str = "count") -> DataFrame:
    """Rows per key (E5); works on batch and streaming frames."""
    out = df.groupBy(*keys).count()
    return out if alias == "count" else out.withColumnRenamed("count", alias)


def agg_dict(df: DataFrame, keys: Sequence[str], spec: Mapping[str, str],
             names: Mapping[str, str] | None = None) -> DataFrame:
    """Dictionary-style aggregate ``{"col": "sum"}``.

    Spark names such a column ``sum(col)``; we alias explicitly to
    ``names[col]`` or ``<fn>_<col>``.
    """
    names = dict(names or {})
    exprs = [
        _FUNCS[fn](F.col(c)).alias(names.get(c, f"{fn}_{c}")) for c, fn in spec.items()
    ]
    return df.groupBy(*keys).agg(*exprs)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def cube_avg(df: DataFrame, keys: Sequence[str], with_grouping_id: bool = False,
             prefix: str = "avg_") -> DataFrame:
    """``cube(keys).avg()``: mean of every numeric column, numeric keys
    included, for every subset of the keys (E7 / I4).

    A subtotal null and a real null look the same; ``with_grouping_id`` adds
    the bit mask that tells them apart. Spark's mean of a decimal is cut to a
    few more decimals than the column has, so here it is the exact sum over
    the count, as a double.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def mean(c: str) -> Column:
        if isinstance(types[c], DecimalType):
            return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))
        return F.avg(c)

    exprs = [mean(c).alias(f"{prefix}{c}") for c in numeric_columns(df)]
    if with_grouping_id:
        exprs.append(F.grouping_id().alias("grouping_id"))
    return df.cube(*keys).agg(*exprs)
