"""Hard negatives for anchors, by cover trees over blocks of all candidates.

A component x becomes floor(``scale`` * x); a row's score is its integer inner
product with the anchor, higher scores first, ties by smaller id. An anchor's
positives are its first rows of the same label; the hard negatives of a positive
are the first rows of other labels whose score lies in a window of percents of
the positive's.

Candidates are dealt by a hash of their row into blocks of bounded bytes (no key,
label or common vector can fill one), each with its own cover tree, written once.
Anchors are packed into parts of bounded bytes. A task takes one part and one of
``STREAMS`` streams of blocks, sorted behind the part, and carries its best rows
from block to block, so it holds one part, one block and that, at any size of the
table; what it hands on are the best rows of each anchor and window. Positives
are searched first; their scores give the windows of the second search.

Rows with a null label, a null vector, or any null or non-finite component take
no part, nor do rows whose squared norm reaches 2**53 after scaling, as their
products are not exact in doubles. Vectors of different length are never
compared. Repeated rows are rows of their own, each other's candidates and each
an anchor; a null id comes last among ties and is no anchor unless the caller
says so. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import cover_tree
from tidemark.llm.cover_tree import NO_ID, NO_SCORE, Queries, pack, unpack
from tidemark.operators.control import materialize

#: Streams of candidate blocks that a part of anchors meets, each in a task of its own.
STREAMS = 32
#: Bytes of a block of candidates and of a part of anchors, as 32-bit components.
BLOCK_BYTES = PART_BYTES = 1 << 23
#: Exact squared norms, in doubles.
MOST = float(2**53)

_KEY = ("dim", "part", "stream")
_PACKED = "dim int, part int, payload binary"
_FOUND = "anchor_row long, anchor_id long, window int, positive_id long, positive_score long, id long, score long"


def integers(rows: DataFrame, anchor: Column, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """The rows that take part: ``row`` (a number of its own), ``id``, ``label``,
    ``anchor``, ``dim`` and the integer components ``x``."""
    parts = F.transform(F.col(vector_col), lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    sound = ~F.exists(vector_col, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) > 1e15))
    taken = (
        rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(sound)
        .select(
            F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"), F.size(vector_col).alias("dim"), parts.alias("x"),
        )
    )
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    return taken.where(square < MOST).withColumn("row", F.monotonically_increasing_id())


def _arrays(table: pa.Table) -> dict[str, np.ndarray]:
    n, dim = table.num_rows, table.column("dim")[0].as_py()
    x = pa.concat_arrays(table.column("x").chunks).flatten().to_numpy(zero_copy_only=False)
    return {
        "ids": table.column("id").fill_null(NO_ID).to_numpy(),
        "rows": table.column("row").to_numpy(),
        "labels": table.column("label").to_numpy(),
        "vectors": np.ascontiguousarray(x.reshape(n, dim)).astype(np.int32),
    }


def _tree_of(table: pa.Table) -> pa.Table:
    return pa.table({
        "dim": pa.array([table.column("dim")[0].as_py()], pa.int32()),
        "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
        "payload": pa.array([cover_tree.store(**_arrays(table))], pa.binary()),
    })


def index(rows: DataFrame, blocks: int) -> DataFrame:
    """One row per block: ``dim``, ``block`` and its tree."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return dealt.select("dim", "block", "id", "row", "label", "x").groupBy("dim", "block").applyInArrow(_tree_of, "dim int, block int, payload binary")


def _packed(table: pa.Table) -> pa.Table:
    arrays = _arrays(table)
    n = table.num_rows
    if "positives" in table.column_names:
        lists = table.column("positives").to_pylist()
        width = max(map(len, lists))
        score, ids, real = np.zeros((n, width), np.int64), np.full((n, width), NO_ID), np.zeros((n, width), bool)
        for i, found in enumerate(lists):
            for j, p in enumerate(found):
                score[i, j], real[i, j] = p["score"], True
                ids[i, j] = NO_ID if p["id"] is None else p["id"]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        arrays |= {
            "positive_score": score, "positive_id": ids,
            "low": np.where(real, -((-low * score) // 100), 1), "high": np.where(real, (high * score) // 100, 0),
        }
    else:
        arrays |= {"low": np.full((n, 1), NO_SCORE + 1), "high": np.full((n, 1), -NO_SCORE)}
    return pa.table({
        "dim": pa.array([table.column("dim")[0].as_py()], pa.int32()),
        "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
        "payload": pa.array([pack(**arrays)], pa.binary()),
    })


def _rows_found(anchors: dict[str, np.ndarray], q: Queries) -> Iterator[pa.RecordBatch]:
    i, w, k = np.nonzero(q.scores > NO_SCORE)
    nullable = lambda ids: pa.array(ids, mask=ids == NO_ID)
    positive = ("positive_id", "positive_score")
    for at in range(0, len(i), 1 << 16):
        a, b, c = (v[at : at + (1 << 16)] for v in (i, w, k))
        p_id, p_score = (nullable(anchors[p][a, b]) if p in anchors else pa.nulls(len(a), pa.int64()) for p in positive)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors["rows"][a]), nullable(anchors["ids"][a]), pa.array(b.astype(np.int32)), p_id, p_score, nullable(q.ids[a, b, c]), pa.array(q.scores[a, b, c])],
            names=["anchor_row", "anchor_id", "window", "positive_id", "positive_score", "id", "score"],
        )


def _searching(best: int, same_label: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = q = mine = None
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in _KEY))
            for key, is_block, payload in zip(keys, batch.column("is_block").to_pylist(), batch.column("payload")):
                if is_block:
                    # blocks of a length that no anchor has come without a part
                    if key == mine:
                        cover_tree.search(cover_tree.load(payload.as_py()), q, same_label)
                    continue
                if q is not None:
                    yield from _rows_found(anchors, q)
                anchors, mine = unpack(payload.as_py()), key
                q = Queries(anchors["vectors"], anchors["labels"], anchors["rows"], anchors["low"], anchors["high"], best)
        if q is not None:
            yield from _rows_found(anchors, q)

    return run


def _best(parts: DataFrame, tree: DataFrame, n_parts: int, best: int, same_label: bool) -> DataFrame:
    """The first ``best`` rows of every anchor and window, ``rank`` from 1."""
    key = list(_KEY)
    spread = parts.withColumn("stream", F.explode(F.sequence(F.lit(0), F.lit(STREAMS - 1))))
    blocks = tree.withColumn("stream", F.pmod("block", F.lit(STREAMS))).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    both = spread.select(*key, F.lit(False).alias("is_block"), F.lit(-1).alias("block"), "payload").unionByName(
        blocks.select(*key, F.lit(True).alias("is_block"), "block", "payload")
    )
    found = (
        both.repartition(STREAMS * n_parts, *key).sortWithinPartitions(*key, "is_block", "block")
        .select(*_KEY, "is_block", "payload").mapInArrow(_searching(best, same_label), _FOUND)
    )
    first = Window.partitionBy("anchor_row", "window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= best)


def mine(
    rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """Per anchor (rows where ``anchor`` holds), positive and hard negative:
    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``. The window runs from ``low`` to ``high`` percent of the
    positive's score, both included."""
    taken = materialize(integers(rows, anchor, id_col, vector_col, label_col, scale), "mining-rows")
    n, n_anchors, dim = taken.agg(F.count("*"), F.count(F.when(F.col("anchor"), 1)), F.coalesce(F.max("dim"), F.lit(1))).first()
    size = 4 * max(dim, 1)
    tree = materialize(index(taken, max(STREAMS, -(-n * size // BLOCK_BYTES))), "mining-trees")
    n_parts = max(1, -(-n_anchors * size // PART_BYTES))
    anchors = taken.where("anchor").withColumn("part", F.pmod(F.xxhash64("row"), F.lit(n_parts)).cast("int"))
    pack_parts = lambda df: df.groupBy("dim", "part").applyInArrow(_packed, _PACKED)
    columns = ["dim", "part", "id", "row", "label", "x"]
    near = _best(pack_parts(anchors.select(*columns)), tree, n_parts, positives, True)
    near = near.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("positives"))
    near = materialize(near, "mining-positives")
    with_windows = anchors.join(near, anchors.row == near.anchor_row).select(*columns, "positives", F.lit(low).alias("low"), F.lit(high).alias("high"))
    hard = _best(pack_parts(with_windows), tree, n_parts, negatives, False)
    return hard.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
