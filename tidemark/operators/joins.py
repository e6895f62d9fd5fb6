"""Join operators and join-strategy control (group D, M2).

Strategy is chosen per query with hints, never by mutating session settings.
A side is broadcast only after its row count is proven below a bound; beyond
the bound the join stays a shuffle join and AQE may still convert it at
runtime from measured sizes.
"""

from __future__ import annotations

import contextlib
import io
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# A broadcast side must have at most this many rows and bytes (checked, not
# assumed). Every executor holds a copy, so the byte bound is what matters.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 128 * 1024 * 1024


def join_using(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on shared names; each key appears once in the output."""
    return left.join(right, on=on, how=how)


def join_on(
    left: DataFrame,
    right: DataFrame,
    condition,
    how: str = "inner",
    left_alias: str = "l",
    right_alias: str = "r",
) -> DataFrame:
    """Aliased condition join; both key columns stay until a select.

    ``condition`` is a Column or a callable ``(l, r) -> Column`` given the
    aliased frames' column accessor, e.g. ``lambda l, r: l("k") == r("k")``.
    """
    a = left.alias(left_alias)
    b = right.alias(right_alias)
    if callable(condition) and not isinstance(condition, Column):
        condition = condition(
            lambda c: F.col(f"{left_alias}.{c}"), lambda c: F.col(f"{right_alias}.{c}")
        )
    return a.join(b, condition, how)


def sort_merge_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Force a sort-merge join with a per-query hint."""
    return left.hint("merge").join(right.hint("merge"), on=on, how=how)


def shuffle_hash_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Shuffle-hash join hint: no sort, build side hashed per partition."""
    return left.join(right.hint("shuffle_hash"), on=on, how=how)


def _row_bytes(df: DataFrame) -> Column:
    """Approximate in-memory bytes of a row: 8 per fixed-width column, the
    encoded length of text/binary columns, the JSON length of nested ones."""
    parts = [F.lit(8)]
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(8))
    return reduce(lambda a, b: a + b, parts).cast("long")


#: What Spark takes for the size of a source that tells none.
_UNKNOWN_BYTES = 2**63 - 1


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's estimate of a frame's size: file sizes, carried through
    the plan without running it; None if one of its sources tells no size. An
    upper estimate for joins; a lower one for compressed files, so it can rule
    a broadcast out but prove nothing."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return None if _UNKNOWN_BYTES in sizes else int(plan.stats().sizeInBytes())


def has_bounded_size(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> bool:
    """Proof of a size bound: at most ``max_rows`` rows and ``max_bytes`` bytes.

    A frame whose scans are estimated above the byte bound is ruled out without
    a job, so no large table is ever read for the proof. Otherwise rows and
    bytes are counted on the executors by one partial aggregate; a single row
    reaches the driver.
    """
    if (estimated_bytes(df) or 0) > max_bytes:
        return False
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    checked: bool | None = None,
    max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Broadcast ``right`` if it is proven to hold at most ``max_rows`` rows
    and ``max_bytes`` bytes (D5).

    ``checked=True`` states the bound is known by construction (an inline
    lookup of fixed values); otherwise it is checked by ``has_bounded_size``.
    Beyond the bound a plain (shuffle) join is returned, which AQE may still
    turn into a broadcast from the measured shuffle size.
    """
    small = checked if checked is not None else has_bounded_size(right, max_rows, max_bytes)
    if small:
        return left.join(F.broadcast(right), on=on, how=how)
    return left.join(right, on=on, how=how)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, captured as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_join_strategies(df: DataFrame) -> list[str]:
    """Join operators named in the physical plan (for plan assertions)."""
    plan = plan_text(df, "simple")
    names = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
             "BroadcastNestedLoopJoin", "CartesianProduct")
    return [n for n in names if n in plan]
