"""Target-distribution importance resampling over hashed word n-grams.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower
case; features are all runs of 1 to ``width`` consecutive words of one text,
joined by a space, and a feature's bucket is the crc32 of its UTF-8 bytes modulo
``buckets``. A bucket's gain compares its share of the target's features with its
share of the corpus'; a document's weight is the sum of its features' gains, its
score that weight plus a Gumbel noise drawn from its id. The documents with the
highest scores are the sample, in the target's proportions and without
replacement.

A batch of texts is one byte string: the lower-cased texts with an upper-case
letter behind each of them, which no such text can hold. One regular expression
pass finds words and sentinels; ``searchsorted`` against the sentinels gives the
text of every word and masks runs that cross into the next one, before
``bincount`` sums by bucket or by text. The corpus is read twice, once for the
histograms and once for the weights. The driver holds two histograms and the
gains, of ``buckets`` numbers each, whatever the input's size.

Null or empty text: no feature, weight 0. Null id: noise of an empty id, after
equal scores. Repeated rows are rows of their own, with equal scores and ranks
next to each other. Empty corpus: no row; empty target: every feature's gain is
that of a target without features.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import each_buffer
from tidemark.operators.control import materialize, session_conf
from tidemark.operators.windows import global_position

BUCKETS = 10_000
#: Longest run of words that makes a feature.
WIDTH = 1
SEED = 2024
#: Documents with fewer words aren't drawn.
LEAST_WORDS = 20
#: Documents drawn, in percent of those with enough words.
PERCENT = 10
#: Features whose buckets a worker remembers at a time, and the longest of them.
REMEMBERED, REMEMBERED_BYTES = 1 << 16, 64
#: Texts handed to a worker at once, however long they are: the JVM and the worker each hold all of a batch.
_BATCH_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

_SENTINEL = b"A"
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|A")


class _BucketOf(dict):
    """Bucket of each feature met; emptied when full. Long ones aren't kept."""

    def __init__(self, buckets: int):
        super().__init__({_SENTINEL: -1})
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(feature) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
                self[_SENTINEL] = -1
            self[feature] = bucket
        return bucket


def features(texts: list[bytes], width: int, bucket_of: _BucketOf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index and bucket of every feature, and the words of every text."""
    tokens = _TOKEN.findall(_SENTINEL.join([*(t.lower() for t in texts), b""]))
    found = np.fromiter(map(bucket_of.__getitem__, tokens), np.int64, len(tokens))
    ends = np.flatnonzero(found < 0)
    owner = np.searchsorted(ends, np.arange(len(tokens)))
    is_word = found >= 0
    who, what = [owner[is_word]], [found[is_word]]
    words = np.bincount(who[0], minlength=len(texts))
    for n in range(2, width + 1):
        last = len(tokens) - n + 1
        inside = np.flatnonzero((owner[:last] == owner[n - 1 :]) & is_word[n - 1 :]) if last > 0 else ends[:0]
        runs = (b" ".join(tokens[k : k + n]) for k in inside)
        who.append(owner[inside])
        what.append(np.fromiter(map(bucket_of.__getitem__, runs), np.int64, len(inside)))
    return np.concatenate(who), np.concatenate(what), words


def _counting(buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of, total = _BucketOf(buckets), np.zeros(buckets, np.int64)
        for _, texts in each_buffer(batches):
            total += np.bincount(features(texts, width, bucket_of)[1], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    return run


def histogram(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """Features by ``bucket``: every task sums its own rows first."""
    text = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return text.mapInArrow(_counting(buckets, width), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _counts(found: DataFrame, buckets: int) -> np.ndarray:
    rows = found.toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousandth part of each: the logarithm of the smoothed share of the
    target over that of the corpus, rounded down."""
    s, t, n = corpus.astype(float), target.astype(float), float(len(corpus))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _weighing(gain: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = _BucketOf(len(gain))
        for batch, texts in each_buffer(batches):
            who, what, words = features(texts, width, bucket_of)
            n = np.bincount(who, minlength=len(texts))
            weight = np.bincount(who, gain[what].astype(float), len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight.astype(np.int64))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, width: int = WIDTH, seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank`` (from 1; null for rows that aren't drawn)."""
    with session_conf(docs.sparkSession, _BATCH_CONF):
        corpus = _counts(histogram(docs, text_col, buckets, width), buckets)
        gain = gains(corpus, _counts(histogram(target, target_text_col, buckets, width), buckets))
        scored = _scored(docs, gain, id_col, text_col, least_words, width, seed)
    drawn = scored.agg(F.floor(F.count(F.when(F.col("enough"), 1)) * percent / 100).cast("long")).first()[0]
    order = [F.col("enough").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("repeat").asc()]
    placed = global_position(scored, order, "position", materialize_input=False)
    rank = F.when(F.col("enough") & (F.col("position") <= drawn), F.col("position"))
    return placed.select(F.col("doc_id").alias(id_col), "n_words", "n_features", "weight", "score", rank.alias("rank"))


def _scored(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, least_words: int, width: int, seed: int) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scored = (
        texts.mapInArrow(_weighing(gain, width), f"doc_id {id_type}, n_words long, n_features long, weight long")
        .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
        .withColumn("enough", F.col("n_words") >= least_words)
        # repeated rows have equal keys else, and would all be sorted in one task
        .withColumn("repeat", F.monotonically_increasing_id())
    )
    return materialize(scored, "importance-scores")
