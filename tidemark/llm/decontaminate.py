"""Benchmark decontamination: short test items inside long documents.

Containment of an item is the share of its five-word shingles that a document
has. Items are partitioned by size; in each partition an item's signature is its
smallest shingle hashes (minima of one random order). With ``q`` shingles and a
containment of ``t`` or more, at most ``q - ceil(t q)`` shingles are missing, so
a document must have one of any ``floor((1 - t) q) + 1`` of them: the length of
the signature follows the upper size of the partition, and no item that is
contained is missed. Long documents keep all their shingle hashes: a sample of
them, as in the usual signatures, would miss short items in long texts.
Candidates are verified on the shingles themselves.

Words are split at ASCII white space, A-Z folded. An item or a document of fewer
than five words is one shingle; without words it has none and matches nothing. So that
an item of one to four words is found inside longer documents, these get their
runs of words of the lengths that occur among the benchmark's short items too
(``short_items=False`` leaves that out: such an item is then found as a whole
document only).
Null ids are kept. Repeats of a document or an item (equal id and text) count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed
from tidemark.llm.shingles import with_hashes, with_short_hashes, with_short_strings, with_strings, with_words
from tidemark.operators.control import few_parts, materialize

WIDTH = 5
CONTAINMENT = 0.8
#: Benchmarks of up to this many shingles (some 60 bytes each) are broadcast; larger ones are shuffled.
BROADCAST_SHINGLES = 500_000


def _signature(containment: float) -> Column:
    size = F.size("hashes")
    upper = F.pow(F.lit(2), F.floor(F.log2(size)) + 1) - 1
    length = F.least(size, (F.floor((1 - containment) * upper + 1e-9) + 1).cast("int"))
    return F.when(size > 0, F.slice(F.sort_array("hashes"), F.lit(1), length))


def contained_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    containment: float = CONTAINMENT, width: int = WIDTH, short_items: bool = True,
) -> DataFrame:
    """``(rk, doc id, item id, n_shared, n_item, containment)`` of every
    document and item with that containment or more; ``rk`` is the document's
    ``common.row_key``. One row for each distinct (id, text) of a document and
    of a benchmark item."""
    items = with_words(benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")), "text", "words", fold=True)
    items = with_strings(with_hashes(items, "words", "hashes", width), "words", "grams", width)
    signed = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), F.size("words").alias("n_words"), _signature(containment).alias("signature"), "grams")
    items = materialize(few_parts(signed.dropDuplicates(["item"]), benchmark), "benchmark-items")
    # at most width - 1 numbers, and the shingles of all items
    short = F.when((F.col("n_words") > 0) & (F.col("n_words") < width), F.col("n_words"))
    about = items.agg(F.collect_set(short).alias("lengths"), F.coalesce(F.sum(F.size("grams")), F.lit(0)).alias("shingles")).first()
    lengths = sorted(about.lengths) if short_items else []
    probes = items.select("item", F.explode("signature").alias("h"))
    grams = items.select("item", "item_id", F.col("grams").alias("item_grams"))
    texts = keyed(docs, id_col, text_col)
    worded = with_words(texts, "text", "words", fold=True)
    # explode_outer: a plain explode would push a test of the array's size below
    # the shingling, and evaluate the words again for every shingle
    hashed = with_short_hashes(with_hashes(worded, "words", "hashes", width), "words", "hashes", lengths)
    if about.shingles <= BROADCAST_SHINGLES:
        # one scan: a document's words stay with its candidates, nothing is shuffled but results
        found = hashed.select("rk", "doc_id", "words", F.explode_outer("hashes").alias("h")).join(F.broadcast(probes), "h")
        whole = with_short_strings(with_strings(found.join(F.broadcast(grams), "item"), "words", "grams", width), "words", "grams", lengths)
    else:
        pairs = materialize(hashed.select("rk", F.explode_outer("hashes").alias("h")).join(probes, "h").select("rk", "item").distinct(), "contained-candidates")
        wanted = pairs.groupBy("rk").agg(F.collect_set("item").alias("items"))
        listed = with_short_strings(with_strings(worded.join(wanted, "rk").dropDuplicates(["rk"]), "words", "grams", width), "words", "grams", lengths)
        whole = listed.select("rk", "doc_id", "grams", F.explode("items").alias("item")).join(grams, "item")
    shared = F.size(F.array_intersect("grams", "item_grams"))
    rows = whole.select("rk", "doc_id", "item", "item_id", shared.cast("long").alias("n_shared"), F.size("item_grams").cast("long").alias("n_item"))
    # few rows of many documents: written, their size is known to what comes after
    found = materialize(rows.where(F.col("n_shared") >= F.col("n_item") * containment - 1e-9), "contained-items")
    return few_parts(found.distinct(), found).select(
        "rk", F.col("doc_id").alias(id_col), F.col("item_id").alias(item_col), "n_shared", "n_item",
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; all their
    columns, null ids and repeated rows stay."""
    from tidemark.llm.common import row_key

    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    bad = contained_items(docs, benchmark, **columns).select(F.col("rk").alias("_contaminated")).distinct()
    return docs.join(bad, row_key(id_col, text_col) == F.col("_contaminated"), "left_anti")
