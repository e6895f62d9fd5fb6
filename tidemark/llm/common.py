"""Shared helpers: reading the tables, row keys, vectorised text hashing.

``row_key`` names a document row inside an operator. It is a 64-bit hash of
the id and the text, so rows with equal ids but different texts stay apart,
a null id is an ordinary value, and an exact repeat of a row shares the key
of its twin (both get the same result).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only what an operator needs, under its own names: key, id and text
    (null: empty). Any further column of the input is left aside, so names
    can't clash."""
    return docs.select(
        row_key(id_col, text_col).alias("rk"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply), elementwise, in a new array."""
    x = x ^ (x >> U64(31))
    x *= U64(0x7FB5D329728EA185)
    x ^= x >> U64(27)
    x *= U64(0x81DADEF4BC2DD44D)
    x ^= x >> U64(33)
    return x


def mix2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One id for an ordered pair of ids."""
    return mix(a * U64(0x9E3779B97F4A7C15) + mix(b + U64(0x632BE59BD9B4E019)))


class Rolling:
    """Hashes of any substring of a byte buffer from one prefix sum.

    The polynomial is taken modulo 2**64 over random odd byte values and then
    finalised; the power tables grow to the longest buffer seen and are kept.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
        self.power = np.ones(1, U64)
        self.inverse = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if n > len(self.power):
            n = max(n, 1 << 16, 2 * len(self.power))
            inv = pow(self.BASE, -1, 1 << 64)
            for name, base in (("power", self.BASE), ("inverse", inv)):
                p = np.full(n, base, U64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=U64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        s = np.zeros(len(data) + 1, U64)
        np.cumsum(self.table[data] * self.power[: len(data)], out=s[1:])
        return s

    def spans(self, s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each [start, end)."""
        return mix((s[end] - s[start]) * self.inverse[start])

    def grams(self, s: np.ndarray, q: int) -> np.ndarray:
        """Hash of the ``q`` bytes at every position."""
        n = len(s) - q
        if n <= 0:
            return np.zeros(0, U64)
        return mix((s[q:] - s[:-q]) * self.inverse[:n])


def buffers(lengths: list[int], target: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``target`` bytes together;
    a longer text makes a range of its own."""
    first, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > target:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(lengths):
        yield first, len(lengths)


def text_buffers(batch: pa.RecordBatch, target: int = 1 << 17) -> Iterator[tuple[int, int, list[bytes]]]:
    """``buffers`` of the column ``text`` with the UTF-8 bytes of their texts. Only
    one range at a time is made into Python objects, whatever a batch holds."""
    text = batch.column("text")
    raw = text.cast(pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary())
    for a, b in buffers(pc.binary_length(raw).to_pylist(), target):
        yield a, b, raw.slice(a, b - a).to_pylist()
