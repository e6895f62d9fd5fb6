"""Quality classifier: histogram gradient-boosted trees over text statistics.

Statistics of whole texts are computed once, on the executors, for many texts at
a time. Trees are grown on quantile bins of a bounded sample of labelled rows
(``MAX_TRAIN``, the rows with the smallest hash of their id) and kept as flat
arrays in heap order, so a batch walks a tree in ``DEPTH`` vector steps. The
model is a few kilobytes and travels with the tasks.

Labels of rows that are held out (crc32 of the id as text, modulo 5, is 0) are
never read. Labels, language, source and id are no inputs of a score. A null or
empty text has all statistics 0 and is scored like any other. A null id is not
held out and has no label; several labels of one id all count; a null label is
no label. Without labels of both kinds every score is the share of label 1 (0.5
if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rolling, keyed
from tidemark.llm.words import each_buffer
from tidemark.operators.control import materialize

U64 = np.uint64
MAX_TRAIN = 50_000
TREES, DEPTH, RATE, BINS = 150, 4, 0.1, 64
THRESHOLD = 0.3

# classes of bytes, counted per text
_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": [32], "line": [10, 13], "stop": b".,;:", "mark": b"!?",
    "symbol": b"#$%&*+=~^|\\<>@_", "bracket": b"()[]{}\"'/-", "high": range(128, 256),
}
_CLASS = np.zeros(256, np.int64)
for _i, _bytes in enumerate(_CLASSES.values(), 1):
    _CLASS[list(_bytes)] = _i
FEATURES = (
    "log_bytes", *_CLASSES, "log_words", "word_mean", "word_sd", "word_max", "distinct_words", "top_word", "short_words", "long_words",
    "lines", "line_mean", "distinct_lines", "top_line", "stop_words", "distinct_pairs", "capital_words", "entropy",
)


def _grouped(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct values and the largest count of one, by owner."""
    if not len(owner):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((value, owner))
    o, v = owner[order], value[order]
    start = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (v[1:] != v[:-1])])
    size = np.diff(np.r_[start, len(o)])
    most = np.zeros(n)
    np.maximum.at(most, o[start], size)
    return np.bincount(o[start], minlength=n).astype(float), most


def _pieces(rolling: Rolling, prefix: np.ndarray, inside: np.ndarray, ends_of: np.ndarray):
    edge = np.r_[False, inside, False]
    turn = np.flatnonzero(edge[1:] != edge[:-1])
    start, end = turn[::2], turn[1::2]
    return np.searchsorted(ends_of, start, "right"), start, end, rolling.spans(prefix, start, end)


def statistics(rolling: Rolling, texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], float)
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(n), (sizes + 1).astype(np.int64))
    width = len(_CLASSES) + 1
    counts = np.bincount(owner * width + _CLASS[data], minlength=n * width).reshape(n, width)[:, 1:].astype(float)
    counts[:, 4] -= 1  # the line end put behind each text
    hist = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256).astype(float)
    hist[:, 10] -= 1
    share = hist / np.maximum(sizes, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    prefix = rolling.prefix(data)
    who, start, end, word = _pieces(rolling, prefix, (data > 32), ends_of)
    length = (end - start).astype(float)
    words = np.bincount(who, minlength=n).astype(float)
    per = np.maximum(words, 1)
    mean = np.bincount(who, length, n) / per
    sd = np.sqrt(np.maximum(np.bincount(who, length**2, n) / per - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, who, length)
    distinct, top = _grouped(who, word, n)
    pair = np.flatnonzero(who[1:] == who[:-1])
    pairs, _ = _grouped(who[pair], word[pair] * U64(3) + word[pair + 1], n)
    first = data[start] if len(start) else np.zeros(0, np.uint8)
    of_line, _, _, line = _pieces(rolling, prefix, (data != 10), ends_of)
    lines = np.bincount(of_line, minlength=n).astype(float)
    distinct_lines, top_line = _grouped(of_line, line, n)
    some = lambda mask: np.bincount(who[mask], minlength=n) / per
    columns = [
        np.log1p(sizes), *(counts / np.maximum(sizes, 1)[:, None]).T, np.log1p(words), mean, sd, longest, distinct / per, top / per,
        some(length <= 3), some(length >= 12), np.log1p(lines), sizes / np.maximum(lines, 1), distinct_lines / np.maximum(lines, 1), top_line / np.maximum(lines, 1),
        some((length <= 4) & (first >= 97) & (first < 123)), pairs / np.maximum(np.bincount(who[pair], minlength=n), 1), some((first >= 65) & (first < 91)), entropy,
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _with_row_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling = Rolling()
    for batch, texts in each_buffer(batches):
        x = statistics(rolling, texts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column("rk"), batch.column("doc_id"), lists], names=["rk", "doc_id", "x"])


class Trees:
    """Boosted trees as arrays: one heap of nodes per tree."""

    def __init__(self, base: float, feature: np.ndarray, limit: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.limit, self.value = base, feature, limit, value

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, ridge: float = 1.0) -> Trees:
        p = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        base = float(np.log(p / (1 - p)))
        inner, leaves = 2**depth - 1, 2**depth
        if not len(y) or y.min() == y.max():
            return cls(base if len(y) else 0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
        cuts = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
        flat = binned + np.arange(x.shape[1]) * bins
        total = np.full(len(y), base)
        out = [], [], []
        for _ in range(trees):
            prob = 1 / (1 + np.exp(-total))
            grad, hess = y - prob, prob * (1 - prob)
            node = np.zeros(len(y), np.int64)
            feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
            for level in range(depth):
                here, first = 2**level, 2**level - 1
                at = ((node - first) * (x.shape[1] * bins))[:, None] + flat
                size = here * x.shape[1] * bins
                g = np.bincount(at.ravel(), np.repeat(grad, x.shape[1]), size).reshape(here, x.shape[1], bins).cumsum(axis=2)
                h = np.bincount(at.ravel(), np.repeat(hess, x.shape[1]), size).reshape(here, x.shape[1], bins).cumsum(axis=2)
                g_all, h_all = g[:, :, -1:], h[:, :, -1:]
                gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
                gain[(h < 1) | (h_all - h < 1)] = 0
                best = gain.reshape(here, -1).argmax(axis=1)
                won = gain.reshape(here, -1).max(axis=1) > 1e-6
                f, b = best // bins, best % bins
                for k in np.flatnonzero(won):
                    if b[k] < len(cuts[f[k]]):
                        feature[first + k], limit[first + k] = f[k], cuts[f[k]][b[k]]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > limit[node])
            leaf = node - inner
            value = rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + ridge)
            total += value[leaf]
            for o, v in zip(out, (feature, limit, value)):
                o.append(v)
        return cls(base, *(np.array(o) for o in out))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _scored(model: Trees, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("x")
            x = lists.flatten().to_numpy().reshape(len(lists), -1) if len(lists) else np.zeros((0, len(FEATURES)), np.float32)
            score = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rk"), batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["rk", "doc_id", "score", "predicted"]
            )

    return run


def fit(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_train: int = MAX_TRAIN) -> Trees:
    """Trees from at most ``max_train`` labelled rows that aren't held out."""
    known = (
        labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("double").alias("y"))
        .where(F.col("y").isNotNull() & F.col("label_id").isNotNull()).where(~held_out(F.col("label_id")))
        .orderBy(F.xxhash64("label_id"), "label_id", "y").limit(max_train)
    )
    rows = (
        features.join(known, features.doc_id == known.label_id).select("x", "y", "rk")
        .orderBy(F.xxhash64("rk", "y"), "rk").limit(max_train).select("x", "y").toArrow()
    )
    y = rows.column("y").to_numpy()
    x = np.array(rows.column("x").to_pylist(), np.float32).reshape(len(y), len(FEATURES))
    return Trees.fit(x, y)


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_train: int = MAX_TRAIN, threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row of ``docs``: ``rk``, id, ``held_out``, ``score`` and
    ``predicted`` (1 from ``threshold`` on)."""
    texts = keyed(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    features = materialize(texts.mapInArrow(_with_row_statistics, f"rk long, doc_id {id_type}, x array<float>"), "quality-features")
    model = fit(features, labels, id_col, label_col, max_train)
    out = features.mapInArrow(_scored(model, threshold), f"rk long, doc_id {id_type}, score double, predicted int")
    return out.select("rk", F.col("doc_id").alias(id_col), held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

