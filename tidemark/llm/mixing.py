"""Mixing sources to target weights with hash thresholds, without sorting.

Every document has a fixed 60-bit hash. A source whose target is ``c`` whole
times its size and a rest takes each document ``c`` times and, of the rest, the
documents whose hash is below a threshold. The threshold is found by nested
histograms: words are summed by source and leading hash bits, the bucket in
which the budget runs out is found, and only that bucket is split by the next
bits, until one hash value is left. It is taken if that brings the source nearer
to its target. So a source is off by half of one document at most (documents
that are exact repeats share a hash and go together), and no document is taken
more than ``max_repeats`` times, because no target is above that many sizes.

All steps are partial aggregations; the histograms have at most ``2 ** BITS``
rows a source. Sources are a column of labels: one window runs over one row per
source to share out the weights.

Null text: size 0, never counted. Null source: a source of its own, last in
order. A source with no words has target 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.control import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
HASH_BITS = 60
BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(id_col: str, text_col: str) -> Column:
    """60 bits of the MD5 of id and text."""
    name = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """``(source, source_size, target)``: the total shared by weight, no target
    above ``max_repeats`` times its source, the excess shared again by weight."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    every = Window.partitionBy(F.lit(0))
    before = every.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * max_repeats
    per = per.withColumn(
        "level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    ).withColumn("capped", cap < F.col("weight") * F.col("level"))
    free = (F.sum("source_size").over(every) - F.sum(F.when(F.col("capped"), cap).otherwise(0)).over(every)) / F.sum(
        F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))
    ).over(every)
    target = F.when(F.col("capped"), cap.cast("double")).otherwise(F.least(cap.cast("double"), F.col("weight") * free))
    return per.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, times, bound, take_bound)`` of each source with words: every
    document ``times`` times, once more below ``bound``, and at it if told."""
    now = targets.where("source_size > 0").select(
        F.col("source").alias("s"),
        F.floor(F.col("target") / F.col("source_size")).alias("times"),
        (F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("bound"),
        F.lit(0).cast("long").alias("below"),
    )
    used = sizes.where("size > 0").select("source", "size", "hash")
    for depth in range(BITS, HASH_BITS + 1, BITS):
        rest = HASH_BITS - depth
        inside = (F.shiftright("hash", rest + BITS) == F.col("bound")) if depth > BITS else F.lit(True)
        hist = (
            used.join(now, F.col("source").eqNullSafe(F.col("s")) & inside)
            .groupBy("s", "times", "budget", "below", F.shiftright("hash", rest).alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        upto = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        now = (
            hist.withColumn("upto", F.col("below") + F.sum("words").over(upto))
            .withColumn("last", F.max("bucket").over(Window.partitionBy("s")))
            .where("upto - words <= budget AND (upto > budget OR bucket = last)")
            .groupBy("s").agg(F.min(F.struct("bucket", "times", "budget", "upto", "words")).alias("b"))
            .select("s", "b.times", "b.budget", F.col("b.bucket").alias("bound"), (F.col("b.upto") - F.col("b.words")).alias("below"), F.col("b.words").alias("words"))
        )
    return now.select(
        F.col("s").alias("source"), "times", "bound", (F.col("below") + F.col("words") - F.col("budget") <= F.col("budget") - F.col("below")).alias("take_bound")
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Per row of ``docs``: id, ``hash``, ``source``, ``size``, ``source_size``,
    ``target`` and ``times``, how often the mix takes it."""
    sizes = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), document_hash(id_col, text_col).alias("hash")
        ),
        "mix-sizes",
    )
    targets = materialize(source_targets(sizes, weights, max_repeats), "mix-targets")
    bounds = materialize(thresholds(sizes, targets), "mix-thresholds")
    plan = targets.join(bounds.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    plan = plan.withColumnRenamed("source", "s")
    once_more = (F.col("hash") < F.col("bound")) | ((F.col("hash") == F.col("bound")) & F.col("take_bound"))
    times = F.when(F.col("size") > 0, F.col("times") + F.when(once_more, 1).otherwise(0)).otherwise(0)
    return sizes.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("doc_id").alias(id_col), "hash", "source", "size", "source_size", "target", times.cast("long").alias("times")
    )
