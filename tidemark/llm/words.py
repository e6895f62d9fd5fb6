"""Word shingles of a batch of texts, as numpy arrays.

Words are `[^\\x20\\x09-\\x0D]+`, A-Z in lower case. They are found on the UTF-8
bytes of many texts at once; a shingle is the hash of its word hashes in order.
A text with fewer words than the shingle has one shingle, its whole sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.common import Rolling, mix, mix2, text_buffers

U64 = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True


def shingles(rolling: Rolling, texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hash of every distinct shingle, sorted by both."""
    data = _LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    inside = np.r_[False, ~_SPACE[data], False]
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turn[::2], turn[1::2]
    word = rolling.spans(rolling.prefix(data), start, end)
    owner = np.searchsorted(ends_of, start, "right")
    n = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n) - n
    whole = np.flatnonzero(owner[width - 1 :] == owner[: len(owner) - width + 1]) if len(owner) >= width else np.zeros(0, np.int64)
    h = mix(word[whole] + U64(width))
    for i in range(1, width):
        h = mix2(h, word[whole + i])
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        x = np.empty(len(short), U64)
        for at, k in enumerate(short):
            one = mix(word[first[k] : first[k] + 1] + U64(n[k]))
            for i in range(1, n[k]):
                one = mix2(one, word[first[k] + i : first[k] + i + 1])
            x[at] = one[0]
        place = np.searchsorted(owner[whole], short)
        h = np.insert(h, place, x)
    count = np.where(n < width, n > 0, n - width + 1)
    ends = np.cumsum(count)
    for i, j in zip((ends - count).tolist(), ends.tolist()):
        h[i:j].sort()  # many short sorts in place beat one sort by two columns
    own = np.repeat(np.arange(len(texts)), count)
    new = np.ones(len(h), bool)
    new[1:] = (own[1:] != own[:-1]) | (h[1:] != h[:-1])
    return own[new], h[new]


def each_buffer(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for a, b, texts in text_buffers(batch):
            yield batch.slice(a, b - a), texts
