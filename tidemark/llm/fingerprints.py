"""Bottom-k sketches of word shingles.

A fingerprint holds the ``k`` smallest distinct hashes of a text's five-word
shingles, in order. Sketches of parts merge into the sketch of the whole (the
``k`` smallest of both), and from two of them come estimates of resemblance,
containment and the number of distinct shingles. Everything is a native column
expression; the order of documents comes from a range sort, so no task sees all.

Equal texts have equal fingerprints. A text of fewer than five words has one
shingle, the whole sequence; an empty or null text has an empty fingerprint,
which is like another empty one (1.0) and unlike all else (0.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_key
from tidemark.llm.shingles import with_hashes, with_words
from tidemark.operators.control import materialize

K = 128
WIDTH = 5


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, width: int = WIDTH) -> DataFrame:
    """``out``: the sketch of ``text`` as an array of longs."""
    df = with_hashes(with_words(df, text, "_words"), "_words", "_hashes", width)
    return df.withColumn(out, F.slice(F.sort_array("_hashes"), 1, k)).drop("_words", "_hashes")


def merged(a: Column | str, b: Column | str, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_by(sketches: DataFrame, by: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch for each group: hashes are pre-aggregated, and a group's
    ``k`` smallest are kept on each task before they meet."""
    rows = sketches.select(*by, F.explode(sketch).alias("h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= k).groupBy(*by).agg(F.array_sort(F.collect_list("h")).alias(sketch))


def resemblance(a: str, b: str, k: int = K) -> Column:
    both = merged(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(F.col(a), F.col(b)), both))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))


def distinct_shingles(sketch: str, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(sketch, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: str, b: str, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has: the shared
    shingles by resemblance and size of both together, over the size of ``a``."""
    union_share = (F.element_at(merged(a, b, k), k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    union = F.when(F.size(merged(a, b, k)) < k, F.size(merged(a, b, k)).cast("double")).otherwise((k - 1) / union_share)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_shingles(a, k)))


def as_text(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def successors(keys: DataFrame) -> DataFrame:
    """``keys (rk, doc_id, n_chars)`` with ``next_rk``, the key of the next row
    by id (null last) and key; the last is followed by the first. Rows are dealt
    by range; ends of ranges are linked through one row for each range."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("rk")]
    parts = keys.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed = materialize(
        keys.repartitionByRange(int(parts), *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()),
        "fingerprint-order",
    )
    inside = placed.withColumn("follow", F.lead("rk").over(Window.partitionBy("part").orderBy("at")))
    heads = placed.groupBy("part").agg(F.min_by("rk", "at").alias("head"))
    ranges = Window.orderBy("part")
    linked = heads.select("part", F.coalesce(F.lead("head").over(ranges), F.first("head").over(ranges)).alias("after"))
    return inside.join(linked, "part").select("rk", "doc_id", "n_chars", F.coalesce("follow", "after").alias("next_rk"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs``: id, ``n_chars``, ``sketch``, the ``edited`` text (the
    last quarter replaced by as many code points from the start of the next
    text), ``edited_sketch`` and ``next_sketch``. Rows equal in id and text count
    as one document in the order, and each gets its result."""
    texts = docs.select(row_key(id_col, text_col).alias("rk"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = docs.select(
        row_key(id_col, text_col).alias("rk"), F.col(id_col).alias("doc_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars")
    ).distinct()
    links = materialize(successors(ids), "fingerprint-links")
    take = F.floor(F.col("n_chars") / 4).cast("int")
    asked = links.select(F.col("next_rk").alias("rk"), F.col("rk").alias("for_rk"), "doc_id", "n_chars", take.alias("take"))
    heads = with_fingerprint(texts.join(asked, "rk"), "text", "next_sketch", k, width).select(
        F.col("for_rk").alias("rk"), "doc_id", "n_chars", "take", F.col("text").substr(F.lit(1), F.col("take")).alias("head"), "next_sketch"
    )
    if docs.count() > links.count():  # some rows are repeated: their heads came more than once
        heads = heads.dropDuplicates(["rk"])
    whole = texts.join(heads, "rk").withColumn(
        "edited", F.concat(F.col("text").substr(F.lit(1), (F.col("n_chars") - F.col("take")).cast("int")), F.col("head"))
    )
    whole = with_fingerprint(with_fingerprint(whole, "text", "sketch", k, width), "edited", "edited_sketch", k, width)
    return whole.select(F.col("doc_id").alias(id_col), "n_chars", "sketch", "edited", "edited_sketch", "next_sketch")
