"""Turn a bounded table into an ordered sequence of files that a file-stream
source replays as micro-batches.

Files are written one after the other, each covering a contiguous range of
the ordering column, so their modification times follow that order and the
stream sees the slices in event-time order (rows inside one slice may be
in any order, so a slice should not be split across micro-batches when
lateness matters). Range bounds come from
``approxQuantile`` (a fixed-size sketch), each file is a filtered write
done by executors; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming import runner

#: Name of the column that says which run a row arrives in.
RUN = "_run"


def write_ordered_files(
    df: DataFrame,
    path: str,
    order_col: str,
    n_files: int,
    fmt: str = "json",
    options: dict | None = None,
) -> int:
    """Write ``df`` as ``n_files`` range slices of ``order_col`` into ``path``.

    ``order_col`` must be numeric (use epoch micros for times). Returns the
    number of slices written.
    """
    bounds = []
    if n_files > 1:
        probs = [i / n_files for i in range(1, n_files)]
        bounds = sorted(set(df.approxQuantile(order_col, probs, 0.001)))
    edges = [None, *bounds, None]
    col = F.col(order_col)
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (col >= F.lit(lo))
        if hi is not None:
            cond = cond & (col < F.lit(hi))
        if lo is None:  # rows without an order value come first
            cond = cond | col.isNull()
        writer = df.where(cond).write.mode("append").format(fmt)
        for k, v in (options or {}).items():
            writer = writer.option(k, v)
        writer.save(path)
    return len(edges) - 1


def files_for(df: DataFrame, least: int) -> int:
    """Files of a replay: one per partition of what it is made of, so that its
    writing is as wide as its reading, and ``least`` for small tables."""
    return max(least, df.rdd.getNumPartitions())


def in_runs(df: DataFrame, order_col: str, n: int, behind: Column | None = None) -> DataFrame:
    """Deal rows to ``n`` runs by equal ranges of the whole-number ``order_col``
    (column ``RUN``, from 0). Rows where ``behind`` holds arrive one run after
    the others of their range: late rows, for a watermark to judge. Rows
    without an order value come in the first run."""
    low, high = df.agg(F.min(order_col), F.max(order_col)).first()
    if low is None:
        return df.withColumn(RUN, F.lit(0))
    scaled, width = (F.col(order_col) - F.lit(low)) * F.lit(n), F.lit(high - low + 1)
    # whole numbers: a double would round some of them over a run's edge
    at = F.coalesce(((scaled - F.pmod(scaled, width)) / width).cast("int"), F.lit(0))
    if behind is not None:
        at = F.least(F.lit(n - 1), at + F.coalesce(behind, F.lit(False)).cast("int"))
    return df.withColumn(RUN, at)


def run_in_turn(
    dealt: DataFrame, n: int, path: str, start: Callable[[], StreamingQuery], fmt: str = "json",
) -> list[StreamingQuery]:
    """Replay the runs of ``in_runs`` through one query that stops and resumes.

    The files of a run are written into ``path`` (as many as the frame has
    partitions), then ``start`` starts the query on that folder, which takes
    them as one micro-batch and ends. Each start must use the same checkpoint:
    offsets, state and watermark cross the restart there. Returns the ended
    queries, one a run."""
    ended = []
    for k in range(n):
        rows = dealt.where(F.col(RUN) == k).drop(RUN)
        rows.write.mode("append").format(fmt).save(path)
        query = start()
        runner.await_all([query])
        ended.append(query)
    return ended
