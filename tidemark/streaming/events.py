"""Event-time transforms shared by batch and streaming frames.

Each function takes a DataFrame and returns a DataFrame; applied to a
bounded table it computes the end state a stream would converge to, applied
to a streaming frame it defines the incremental query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import like, ns_epoch_to_timestamp
from tidemark.operators.aggregate import cube_avg


def with_event_time_from_ns(df: DataFrame, ns_col: str = "Creation_Time",
                            out: str = "event_time") -> DataFrame:
    """``cast(cast(ns as double)/1e9 as timestamp)``."""
    return df.withColumn(out, ns_epoch_to_timestamp(ns_col))


def count_by(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Running count per key (I1, I2); unbounded keys mean unbounded state."""
    return df.groupBy(*keys).count()


def pattern_filter(df: DataFrame, col: str, pattern: str, columns: Sequence[str]) -> DataFrame:
    """Stateless filter on a LIKE pattern + projection, append mode (I3). A null
    matches no pattern."""
    return df.where(like(col, pattern)).select(*columns)


def device_cube(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``cube(keys).avg()`` of every numeric column (I4, complete mode)."""
    return cube_avg(df, list(keys))


def windowed_count(
    df: DataFrame,
    time_col: str,
    window: str,
    slide: str | None = None,
    watermark: str | None = None,
    keys: Sequence[str] = (),
    flatten: bool = True,
) -> DataFrame:
    """Count per event-time window: tumbling (I5) or sliding (I6), with an
    optional watermark (I7 complete / I8 append). Rows with a null event time
    fall in no window. ``flatten`` replaces the window struct by
    ``window_start``/``window_end``."""
    if watermark:
        df = df.withWatermark(time_col, watermark)
    w = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    agg = df.groupBy(w.alias("window"), *keys).count()
    if not flatten:
        return agg
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        "count",
    )


def dedup_then_count(
    df: DataFrame, user_col: str, time_col: str, watermark: str
) -> DataFrame:
    """Watermark -> dropDuplicates([user, event_time]) -> count per user.
    Event time is part of the key, so the watermark frees dedup state."""
    deduped = df.withWatermark(time_col, watermark).dropDuplicates([user_col, time_col])
    return deduped.groupBy(user_col).count()


def dedup_unbounded(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropDuplicates(keys)`` with no watermark: exact, but on a stream its
    state grows forever (I10 as the reference wrote it)."""
    return df.dropDuplicates(list(keys))


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], time_col: str,
                           watermark: str) -> DataFrame:
    """Bounded form of I10: duplicates arriving within the watermark delay
    are dropped and state expires with it. On a bounded frame it equals
    ``dropDuplicates``."""
    if df.isStreaming:
        return df.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def dedup_on_arrival(df: DataFrame, keys: Sequence[str], horizon: str) -> DataFrame:
    """Bounded form of I10 that loses no row: copies processed within ``horizon``
    of the first are dropped. The watermark stands on processing time, so no
    arriving row is ever behind it, however old its event time. On a bounded
    frame it equals ``dropDuplicates``."""
    if not df.isStreaming:
        return df.dropDuplicates(list(keys))
    stamped = df.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", horizon)
    return stamped.dropDuplicatesWithinWatermark(list(keys)).drop("_arrival")
