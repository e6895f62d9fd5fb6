"""Sort and limit (group G).

A full ``orderBy`` is a range-partitioned distributed sort. ``top_k`` is
``orderBy().limit(k)``, which Spark plans as TakeOrderedAndProject: each
partition keeps its own k best rows and only those reach the final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Order = Sequence[tuple[str, str]]


def _orders(spec: Order) -> list[Column]:
    out = []
    for name, direction in spec:
        c = F.col(name)
        out.append(c.desc() if direction.lower().startswith("desc") else c.asc())
    return out


def sort_by(df: DataFrame, spec: Order) -> DataFrame:
    """Multi-key sort with mixed directions (G1)."""
    return df.orderBy(*_orders(spec))


def top_k(df: DataFrame, spec: Order, k: int) -> DataFrame:
    """First k rows under a total order (G2/G3); order by a unique key last
    so the result is repeatable."""
    return df.orderBy(*_orders(spec)).limit(k)
