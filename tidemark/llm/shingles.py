"""Word shingles as native column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
# fixed values: letters that fold
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_words(df: DataFrame, text: str, out: str, fold: bool = False) -> DataFrame:
    """The words of ``text`` as an array; null: no words."""
    col = F.translate(text, _UPPER, _LOWER) if fold else F.col(text)
    return df.withColumn(out, F.array_remove(F.split(F.coalesce(col, F.lit("")), r"[\x20\x09-\x0D]+"), ""))


def with_hashes(df: DataFrame, words: str, out: str, width: int = 5) -> DataFrame:
    """Distinct hashes of all ``width``-word shingles of a word array. Fewer
    words than that are one shingle; no words, none."""
    h = f"_{out}_h"
    df = df.withColumn(h, F.transform(words, lambda w: F.xxhash64(w)))
    each = F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(F.col(h), i + k) for k in range(width)])
    )
    short = F.array(F.xxhash64(F.size(h), F.array_join(F.col(words), " ")))
    hashes = F.when(F.size(h) >= width, F.array_distinct(each)).when(F.size(h) > 0, short).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, hashes).drop(h)


def with_short_hashes(df: DataFrame, words: str, out: str, lengths: Sequence[int]) -> DataFrame:
    """Adds to the hashes in ``out`` those of all runs of words of each of the
    ``lengths``, hashed like a whole text of so few words."""
    for n in lengths:
        df = _with_runs(df, words, out, n, lambda run, n=n: F.xxhash64(F.lit(n), run))
    return df


def with_short_strings(df: DataFrame, words: str, out: str, lengths: Sequence[int]) -> DataFrame:
    """The same for the shingles as texts."""
    for n in lengths:
        df = _with_runs(df, words, out, n, lambda run: run)
    return df


def _with_runs(df: DataFrame, words: str, out: str, n: int, of: Callable[[Column], Column]) -> DataFrame:
    starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
    runs = F.transform(starts, lambda i: of(F.array_join(F.slice(words, i, n), " ")))
    return df.withColumn(out, F.when(F.size(words) >= n, F.array_union(out, runs)).otherwise(F.col(out)))


def with_strings(df: DataFrame, words: str, out: str, width: int = 5) -> DataFrame:
    """Distinct shingles of a word array as texts."""
    each = F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.concat_ws(" ", *[F.get(F.col(words), i + k) for k in range(width)]))
    short = F.array(F.array_join(F.col(words), " "))
    return df.withColumn(
        out, F.when(F.size(words) >= width, F.array_distinct(each)).when(F.size(words) > 0, short).otherwise(F.array().cast("array<string>"))
    )
