"""Removal of long byte strings that occur twice (suffix buckets).

The unit is the suffix cut at ``min_len`` bytes. Two suffixes are equal when
they are in the same bucket at that depth, and buckets are refined by bucket
pointers: the bucket at depth ``q`` is the q-gram, the bucket at depth ``2q``
is the pair of the buckets at the suffix and at the offset ``q`` behind it,
and each refined identifier is used again for the next doubling. A bucket is
named by a 64-bit hash instead of a rank, so that every task can name it
without a global sort; Spark's shuffles do the sorting.

Not all suffixes are listed. Every string of ``min_len`` bytes has a canonical
q-gram in it (the least hash, leftmost), and consecutive suffixes mostly share
theirs, so a text falls into runs of suffixes, about one for 150 bytes. Equal
strings have equal canonical q-grams at equal distances. Steps:

1. One row per run: its q-gram bucket, and its class, the refined identifier of
   all bytes that the run's suffixes cover.
2. Runs whose class has two or more members are repeats as a whole: a group of
   copies meets in one partially aggregated row, never in pairs.
3. In buckets with several classes, one run of each class lists its single
   suffixes, in slices dealt by (bucket, distance to the q-gram); equal
   identifiers are counted per slice. Only edges of repeats get here.
4. The removed runs of a text are merged and cut out.

Matches never cross texts. Hash identifiers have 64 bits; a false match needs
two different strings with one identifier in the same bucket.
Null text: empty. A repeated row is a document of its own and a repeat of its
twin. A text shorter than ``min_len`` keeps all its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rolling, keyed, mix2, text_buffers
from tidemark.operators.control import materialize

U64 = np.uint64
MIN_LEN = 400
Q = 100
#: Suffixes in a slice of step 3; equal suffixes have equal distances, so slices keep them together.
SLICE = 64
#: Identifiers of whole slices that step 3 compares at once, or those of one slice if that has more.
AT_ONCE = 1 << 20


class _Suffixes:
    """Bucket identifiers of the suffixes of one buffer of whole texts."""

    def __init__(self, rolling: Rolling, texts: list[bytes], min_len: int, q: int):
        self.min_len, self.q = min_len, q
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.gram = rolling.grams(rolling.prefix(data), q)

    def refined(self, pos: np.ndarray) -> np.ndarray:
        """Identifiers at depth ``min_len`` of the suffixes at ``pos``."""
        depth, steps = self.q, []
        while depth < self.min_len:
            steps.append(min(depth, self.min_len - depth))
            depth += steps[-1]

        def at(p: np.ndarray, level: int) -> np.ndarray:
            if level == 0:
                return self.gram[p]
            return mix2(at(p, level - 1), at(p + steps[level - 1], level - 1))

        return at(pos, len(steps))

    def runs(self) -> tuple[np.ndarray, ...]:
        """Text index, first suffix (in its text), number of suffixes, distance
        from the first suffix to the q-gram, bucket and class of every run."""
        first = [np.arange(s, s + n - self.min_len + 1) for s, n in zip(self.starts, self.lengths) if n >= self.min_len]
        if not first:
            return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, U64),) * 2
        pos = np.concatenate(first)
        least = (self.gram & U64(0xFFFFFFFF00000000)) | np.arange(len(self.gram), dtype=U64)
        width, have = self.min_len - self.q + 1, 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        gram_at = (least[pos] & U64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero((gram_at[1:] != gram_at[:-1]) | (pos[1:] != pos[:-1] + 1)) + 1
        lo = np.concatenate(([0], new))
        hi = np.concatenate((new, [len(pos)])) - 1
        n, start, anchor = hi - lo + 1, pos[lo], gram_at[lo]
        bucket = self.gram[anchor]
        shape = (n.astype(U64) << U64(32)) | (anchor - start).astype(U64)
        ends = mix2(self.refined(start), self.refined(pos[hi]))
        text = np.searchsorted(self.starts, start, "right") - 1
        return text, start - self.starts[text], n, anchor - start, bucket, mix2(mix2(ends, shape), bucket)


def _list_runs(min_len: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            rk = batch.column("rk").to_numpy()
            for a, _, texts in text_buffers(batch):
                text, lo, n, dist, bucket, cls = _Suffixes(rolling, texts, min_len, q).runs()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (cls.view(np.int64), bucket.view(np.int64), rk[a + text], lo << 20 | n << 10 | dist)],
                    names=["cls", "bucket", "rk", "run"],
                )

    return run


def _list_suffixes(min_len: int, q: int):
    """The single suffixes of the runs asked for, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            rk = batch.column("rk").to_numpy()
            for a, b, texts in text_buffers(batch):
                suf = _Suffixes(rolling, texts, min_len, q)
                asked = batch.column("runs").slice(a, b - a).to_pylist()
                rows = [(k, r >> 1, r & 1) for k, runs in enumerate(asked) for r in runs]
                text = np.array([r[0] for r in rows], np.int64)
                run_ = np.array([r[1] for r in rows], np.int64)
                whole = [bool(r[2]) for r in rows]
                lo, n, dist = run_ >> 20, run_ >> 10 & 1023, run_ & 1023
                base = suf.starts[text]
                bucket = suf.gram[base + lo + dist]
                out: dict[str, list] = {"slice": [], "rk": [], "lo": [], "whole": [], "ids": []}
                owner = np.repeat(np.arange(len(rows)), n)
                step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                ids = suf.refined(base[owner] + lo[owner] + step)
                d = dist[owner] - step  # distance of each suffix to the q-gram
                cut = np.flatnonzero((owner[1:] != owner[:-1]) | (d[1:] // SLICE != d[:-1] // SLICE)) + 1
                for i, j in zip(np.r_[0, cut].tolist(), np.r_[cut, len(owner)].tolist()):
                    if i == j:
                        continue
                    o = int(owner[i])
                    out["slice"].append(int(bucket[o].view(np.int64)) ^ (int(d[i]) // SLICE))
                    out["rk"].append(int(rk[a + text[o]]))
                    out["lo"].append(int(lo[o] + step[i]))
                    out["whole"].append(whole[o])
                    out["ids"].append(ids[i:j].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["slice"], pa.int64()), pa.array(out["rk"], pa.int64()), pa.array(out["lo"], pa.int64()), pa.array(out["whole"], pa.bool_()), pa.array(out["ids"], pa.binary())],
                    names=list(out),
                )

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of slices in order: runs of suffixes whose identifier occurs twice or more.
    Equal identifiers are in one slice, so a task holds about ``AT_ONCE`` of them
    or one slice, and not all that the shuffle gave its partition."""
    held, size, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("slice").to_numpy()
        begins = np.flatnonzero(np.r_[key[0] != last, key[1:] != key[:-1]])
        if size >= AT_ONCE and len(begins):
            yield from _twice([*held, batch.slice(0, begins[0])])
            held, size, batch = [], 0, batch.slice(begins[0])
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column("ids"))).as_py() >> 3
        last = key[-1]
    yield from _twice(held)


def _twice(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rk, lo, whole, ids = [], [], [], []
    for batch in batches:
        rk.append(batch.column("rk").to_numpy())
        lo.append(batch.column("lo").to_numpy())
        whole.append(batch.column("whole").to_numpy(zero_copy_only=False))
        ids.extend(batch.column("ids").to_pylist())
    if not ids:
        return
    rk, lo, whole = np.concatenate(rk), np.concatenate(lo), np.concatenate(whole)
    n = np.array([len(x) >> 3 for x in ids])
    flat = np.frombuffer(b"".join(ids), U64)
    del ids
    order = np.argsort(flat)
    s = flat[order]
    twice = np.zeros(len(s), bool)
    same = s[1:] == s[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(s), bool)
    hit[order] = twice
    owner = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = np.flatnonzero(hit & ~whole[owner])
    if not len(at):
        return
    new = np.flatnonzero((owner[at[1:]] != owner[at[:-1]]) | (at[1:] != at[:-1] + 1)) + 1
    i, j = at[np.r_[0, new]], at[np.r_[new, len(at)] - 1]
    first = lo[owner[i]] + step[i]
    yield pa.RecordBatch.from_arrays(
        [pa.array(rk[owner[i]]), pa.array(first), pa.array(j - i + 1)], names=["rk", "lo", "n"]
    )


def _cut(min_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_buffers(batch, 1 << 20):
                spans, kept = [], []
                part = batch.slice(a, b - a)
                for text, runs in zip(texts, part.column("runs").to_pylist()):
                    merged: list[list[int]] = []
                    for r in sorted(runs or ()):
                        lo, hi = r >> 24, (r >> 24) + (r & 0xFFFFFF) - 1 + min_len
                        if merged and lo <= merged[-1][1]:
                            merged[-1][1] = max(hi, merged[-1][1])
                        else:
                            merged.append([lo, hi])
                    cuts = [0, *(x for m in merged for x in m), len(text)]
                    kept.append(b"".join(text[cuts[i] : cuts[i + 1]] for i in range(0, len(cuts), 2)))
                    spans.append([{"start": lo, "end": hi} for lo, hi in merged])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    names=["doc_id", "spans", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = MIN_LEN, q: int = Q) -> DataFrame:
    """Per row of ``docs``: id, ``spans`` (maximal removed byte runs, end
    exclusive) and ``kept`` (the remaining bytes). ``min_len`` is at most 1000
    and at least ``2 * q``."""
    if not 2 * q <= min_len <= 1000:
        raise ValueError("min_len is between 2 * q and 1000")
    texts = keyed(docs, id_col, text_col)
    runs = materialize(
        texts.select("rk", "text").mapInArrow(_list_runs(min_len, q), "cls long, bucket long, rk long, run long"),
        "suffix-runs",
    )
    one = runs.groupBy("cls").agg(
        F.count("*").alias("members"), F.first("bucket").alias("bucket"), F.first("rk").alias("rk"), F.first("run").alias("run")
    )
    classes = materialize(
        one.selectExpr("*", "sum(members) OVER (PARTITION BY bucket) AS in_bucket", "count(*) OVER (PARTITION BY bucket) AS classes").where("in_bucket >= 2"),
        "suffix-classes",
    )
    whole = (
        runs.select("cls", "rk", "run")
        .join(classes.where("members >= 2").select("cls"), "cls")
        .selectExpr("rk", "shiftright(run, 20) AS lo", "shiftright(run, 10) & 1023L AS n")
    )
    asked = (
        classes.where("classes >= 2")
        .selectExpr("rk", "shiftleft(run, 1) | CAST(members >= 2 AS LONG) AS run")
        .groupBy("rk").agg(F.collect_list("run").alias("runs"))
    )
    slices = texts.join(asked, "rk").select("rk", "doc_id", "text", "runs").mapInArrow(
        _list_suffixes(min_len, q), "slice long, rk long, lo long, whole boolean, ids binary"
    )
    edges = slices.repartition("slice").sortWithinPartitions("slice").mapInArrow(_repeated, "rk long, lo long, n long")
    removed = (
        whole.unionByName(edges)
        .selectExpr("rk", "shiftleft(lo, 24) | n AS run")
        .groupBy("rk").agg(F.collect_set("run").alias("runs"))
    )
    return (
        texts.join(removed, "rk", "left")
        .select("rk", "doc_id", "text", "runs")
        .mapInArrow(_cut(min_len), f"doc_id {docs.schema[id_col].dataType.simpleString()}, spans array<struct<start:bigint,end:bigint>>, kept binary")
    )
