"""Window operators (group F), written so no step funnels an unbounded
frame through a single task.

* per-group top-n uses ``rank`` over ``partitionBy`` - Catalyst inserts a
  ``WindowGroupLimit`` so each partition keeps only candidate rows before
  the sort;
* a global dense rank is computed on the *distinct* values with Spark's
  range-partitioned sort: each sort partition numbers its own values,
  partition offsets come from a tiny per-partition count table, and ranks
  join back by value;
* a global row position or running total sorts by range the same way and adds
  what the sort partitions before hold together;
* a global top-n by dense rank takes the n largest distinct values with a
  bounded ``orderBy().limit(n)`` and broadcasts those n rows back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import control

def top_n_per_group(
    df: DataFrame,
    partition_by: Sequence[str],
    order_col: str,
    n: int,
    rank_col: str = "rank",
    ascending: bool = False,
    method: str = "rank",
) -> DataFrame:
    """Rows ranked ``<= n`` inside each group; ties can keep more than n (F1)."""
    order = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    w = Window.partitionBy(*partition_by).orderBy(order)
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    return df.withColumn(rank_col, fn().over(w)).filter(F.col(rank_col) <= n)


# monotonically_increasing_id packs (partition index << 33) + position in partition
_POSITION_BITS = 33


def _parts(tagged: DataFrame, name: str) -> DataFrame:
    """Sorted rows with their ``_id``, written once so that every reader sees
    the same numbering even if a task re-runs, split into ``_part`` (sort
    partition) and ``_pos`` (position in it)."""
    written = control.materialize(tagged, name)
    return written.select(
        *[c for c in written.columns if c != "_id"],
        F.shiftright("_id", _POSITION_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    )


def _offsets(per_part: DataFrame, value: str) -> DataFrame:
    """``_offset``: what all earlier sort partitions hold together. One row per
    sort partition (bounded by the shuffle width): safe to window globally and
    to broadcast."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("_part", F.sum(value).over(before).alias("_offset"))


def _positioned(tagged: DataFrame, name: str) -> DataFrame:
    """Sorted rows with ``_position`` from 1 on: the offset of the row's sort
    partition plus its position inside."""
    rows = _parts(tagged, name)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    return (
        rows.join(F.broadcast(_offsets(counts, "_n")), "_part")
        .withColumn("_position", F.coalesce("_offset", F.lit(0)) + F.col("_pos") + 1)
        .drop("_part", "_pos", "_offset")
    )


def global_position(
    df: DataFrame, order: Sequence[Column], alias: str = "position", materialize_input: bool = True
) -> DataFrame:
    """``row_number() over (order by ...)`` without a single-partition window.

    Spark's range-partitioned sort deals the rows, so rows with equal sort
    keys land in one task: give keys that tell them apart. Sampling the sort's
    ranges reads the input a second time, so by default it is written once."""
    if materialize_input:
        df = control.materialize(df, "position-input")
    tagged = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    # the ids name the sort's partitions, which are gathered only behind them
    return _positioned(control.few_parts(tagged, df), "position-sorted").withColumnRenamed("_position", alias)


def dense_rank_global(
    df: DataFrame,
    value: str,
    rank_col: str = "dense_rank",
    descending: bool = True,
    partitions: int | None = None,
    materialize: bool = True,
) -> DataFrame:
    """``dense_rank() over (order by value)`` without a single-partition window (F2).

    The distinct values are sorted by Spark's range-partitioned sort
    (``orderBy``, or ``partitions`` explicit range partitions), so each task
    sorts one value range and the work per task follows the shuffle width,
    not the data size. Every sorted value is tagged with its partition index
    and its position inside the partition (``monotonically_increasing_id``).
    Offsets come from a table with one row per sort partition (a prefix sum
    over at most ``spark.sql.shuffle.partitions`` rows, broadcast back), and
    ``rank = offset + position + 1``: distinct values make the row position
    the dense rank. Nulls rank last in both directions.

    The tagged values are written once (``control.materialize``) so the
    offsets and the ranks read the same numbering even if a task re-runs.
    The input is read twice (values, then rows), so by default it is
    materialised as well.
    """
    if materialize:
        df = control.materialize(df, "dense-rank-input")
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    vals = df.select(value).distinct()
    if partitions:
        vals = vals.repartitionByRange(partitions, order).sortWithinPartitions(order)
    else:
        vals = vals.orderBy(order)
    ranked_vals = _positioned(
        vals.withColumn("_id", F.monotonically_increasing_id()), "dense-rank-sorted"
    ).select(F.col(value).alias("_v"), F.col("_position").cast("int").alias(rank_col))
    # null-safe equality so null values find their (last) rank
    out = df.join(ranked_vals, df[value].eqNullSafe(F.col("_v")), how="inner")
    return out.drop("_v")


def dense_rank_top_n(
    df: DataFrame,
    value: str,
    n: int,
    rank_col: str = "dense_rank",
    descending: bool = True,
    materialize: bool = True,
) -> DataFrame:
    """Rows whose dense rank is ``<= n``; ties may return more than n rows.

    Only the n best distinct values are ranked (a bounded set), then
    broadcast back: no global sort of all rows. The input is read twice (for
    the n values and for the rows that carry them), so by default it is
    materialised once. A null is a value like any other, ranked where the sort
    order puts it (last when descending).
    """
    if materialize:
        df = control.materialize(df, "top-n-input")

    def order_of(c: str):
        return F.col(c).desc() if descending else F.col(c).asc()

    best = (
        df.select(F.col(value).alias("_best")).distinct().orderBy(order_of("_best")).limit(n)
    )
    best = best.withColumn(rank_col, F.dense_rank().over(Window.orderBy(order_of("_best"))))
    return df.join(F.broadcast(best), F.col(value).eqNullSafe(F.col("_best"))).drop("_best")


def running_total(
    df: DataFrame, order_col: str, value_col: str, alias: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative sum ``rows between unbounded preceding and current row``.

    Without ``partition_by`` the rows are range-sorted and written once; every
    sort partition sums its own rows, and the totals of the partitions before
    it (one row each) are added, so no task sees more than one range. Rows with
    equal order values are summed in the order they are stored, and spread over
    sort partitions like any others; null order values come first. A null value
    adds nothing; rows before the first value have a null total.
    """
    rows_before = (Window.unboundedPreceding, Window.currentRow)
    if partition_by:
        w = Window.partitionBy(*partition_by).orderBy(order_col).rowsBetween(*rows_before)
        return df.withColumn(alias, F.sum(value_col).over(w))
    stored = control.materialize(
        df.withColumn("_tie", F.monotonically_increasing_id()), "running-total-input"
    )
    tagged = stored.orderBy(order_col, "_tie").withColumn("_id", F.monotonically_increasing_id())
    rows = _parts(tagged.drop("_tie"), "running-total-sorted")
    sums = rows.groupBy("_part").agg(F.sum(value_col).alias("_sum"))
    own = F.sum(value_col).over(Window.partitionBy("_part").orderBy("_pos").rowsBetween(*rows_before))
    joined = rows.withColumn("_own", own).join(F.broadcast(_offsets(sums, "_sum")), "_part")
    total = F.when(F.col("_offset").isNull(), F.col("_own")).otherwise(
        F.col("_offset") + F.coalesce("_own", F.lit(0))
    )
    own_type = rows.select(F.sum(value_col).alias("s")).schema["s"].dataType
    return joined.withColumn(alias, total.cast(own_type)).select(*df.columns, alias)
