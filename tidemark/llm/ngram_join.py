"""Jaccard self-join on word n-grams by universe partitions (pigeonhole).

Two sets with Jaccard similarity ``t`` or more differ in at most
``H = (a + b)(1 - t) / (1 + t)`` elements. All possible shingles are dealt by
hash into ``m = H + 1 + s`` segments; then at least ``1 + s`` segments hold the
same subset in both sets. ``m`` and ``H`` are fixed by a band of sizes; a set is
indexed in its own band and in those above that a partner of it can be in.

Keys of a set: the subset in each non-empty segment. Empty segments are equal
between strangers, so they give no key; the slack ``s`` pays for them. How the
differences are allocated follows the cost of the keys, counted over all sets:

* up to ``s`` empty segments: subsets only (difference 0 allowed a segment), and
  of these only the ``H + 1`` rarest. The others are the set's most frequent
  subsets, which would cost the most candidates, and stay out of the index
  (nothing allowed there). Two sets that must meet have the same subset in at
  least one segment more than either of them leaves out; all sets rank subsets by
  the same counts, so what the two leave out of these is one run from the
  frequent end, and a common key is left;
* more: also all subsets with one element left out (difference 1 allowed), which
  is enough while ``2 (m - empty) > H``. This costs a key for each shingle, so
  ``s`` is set to what a band's smallest sets need by a Poisson estimate; nothing
  is left out, which doesn't disturb the rule above for the other set of a pair;
* beyond that (a handful of elements in few segments): every element is a key.

Each case finds every pair that it must, so no link is lost; all candidates are
then verified on the whole sets.

Equal sets are one class, whatever their number. What a document needs is its
component, so not all pairs of a group are listed: the sets of a key are first
compared with two common partners, and then only pairs that aren't in one
component yet, in blocks. These comparisons use parity digests, which can only
underrate a difference; what passes is verified on the whole sets, and if a pair
fails there, what had rested on it is compared again without such shortcuts.

Shingles are compared by 64-bit hashes. Null or empty text: an empty set, linked
with nothing, its component is its own id. A null id links like any other and is
left out of the minimum. A repeated row links with its twin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Rolling, keyed, mix, mix2
from tidemark.llm.components import connected_components
from tidemark.llm.words import each_buffer, shingles
from tidemark.operators.control import materialize, session_conf

U64 = np.uint64
WIDTH = 4
PERCENT = 85
_BAND_RATIO = 1.5
#: Every step is written to the shared folder, so its shuffle files go when it ends
#: and not whenever the driver happens to collect garbage.
_STEP_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@cache
def bands(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least size, segments and greatest difference of each size band."""
    low, segments, differ = [1], [], []
    while low[-1] <= largest:
        low.append(max(low[-1] + 1, int(low[-1] * _BAND_RATIO)))
        least, most = low[-2], low[-1] - 1
        h = 2 * most * (100 - percent) // (100 + percent)
        m = h + 1
        for _ in range(4):
            empty = m * math.exp(-least / m)
            m = h + 1 + (math.ceil(empty + 2 * math.sqrt(empty)) if h else 0)
        segments.append(m)
        differ.append(h)
    return np.array(low[:-1]), np.array(segments), np.array(differ)


def keys_of(own: np.ndarray, h: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Set index and key of all keys of the sets whose sizes are ``n``."""
    return banded_keys(own, h, n, percent)[:2]


def banded_keys(own: np.ndarray, h: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``keys_of`` with each key's band and how many keys its set can spare there."""
    largest = int(n.max(initial=1))
    low, segments, differ = bands(percent, 2 * largest + 4)
    home = np.searchsorted(low, np.maximum(n, 1), "right") - 1
    owners, keys, of_band, spares = [], [], [], []
    for up in range(4):
        band = home + up
        member = (n > 0) & (band < len(low))
        member &= 100 * n >= percent * low[np.minimum(band, len(low) - 1)] if up else True
        if not member.any():
            break
        band = np.where(member, band, 0)
        m, most = segments[band], differ[band]
        pick = member[own]
        o, x = own[pick], h[pick]
        value = mix(x ^ U64(0x5851F42D4C957F2D))
        seg = ((x >> U64(20)) % m[o].astype(U64)).astype(np.int64)
        base = np.cumsum(np.where(member, m, 0)) - np.where(member, m, 0)
        cell = base[o] + seg
        cells = int(np.where(member, m, 0).sum())
        size_of = np.bincount(cell, minlength=cells)
        # sums of 32-bit halves are exact in doubles up to 2**21 elements a cell, and only their last 64 bits count
        total_of = np.bincount(cell, (value & U64(0xFFFFFFFF)).astype(float), cells).astype(U64)
        total_of += np.bincount(cell, (value >> U64(32)).astype(float), cells).astype(U64) << U64(32)
        in_use = np.flatnonzero(size_of)
        so = np.repeat(np.arange(len(n)), np.where(member, m, 0))[in_use]
        ss = in_use - base[so]
        name = mix((band[so].astype(U64) << U64(32)) | ss.astype(U64))
        owners.append(so)
        keys.append(mix2(total_of[in_use], name))
        filled = np.bincount(so, minlength=len(n))
        sparse = member & (m - filled > m - 1 - most)
        spare = np.where(member, np.maximum(filled - 1 - most, 0), 0)
        if sparse.any():
            out = np.flatnonzero(sparse[o] & (size_of[cell] > 1))
            owners.append(o[out])
            keys.append(mix2(total_of[cell[out]] - value[out], mix((band[o[out]].astype(U64) << U64(32)) | seg[out].astype(U64))))
            single = np.flatnonzero((sparse & (2 * filled <= most))[o])
            owners.append(o[single])
            keys.append(mix2(value[single], mix((band[o[single]].astype(U64) << U64(32)) | U64(0xFFFFFFFF))))
        added = owners[len(of_band) :]
        of_band += [band[o] for o in added]
        spares += [spare[o] for o in added]
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(keys), np.concatenate(of_band), np.concatenate(spares)


def _index(width: int):
    """One row per text: size and 64-bit identifier of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch, texts in each_buffer(batches):
            own, h = shingles(rolling, texts, width)
            n = np.bincount(own, minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rk"), batch.column("doc_id"), pa.array(n), pa.array(_set_ids(own, h, n))], names=["rk", "doc_id", "n", "sid"]
            )

    return run


def _set_ids(own: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    one, two = np.zeros(len(n), U64), np.zeros(len(n), U64)
    np.add.at(one, own, mix(h + U64(1)))
    np.add.at(two, own, mix(h ^ U64(0xA5A5A5A5)))
    return mix2(one, two + n.astype(U64)).view(np.int64)


#: ``slot`` is the band in the low 8 bits and what the set can spare there above them.
_KEY_ROW = "sid long, slot long, key long"


def _keys(width: int, percent: int, remember: int = 100_000, names: tuple[str, ...] = ("sid", "slot", "key")):
    """Flat rows of ``_KEY_ROW``, or of the columns named. Copies of a set that a task has
    just listed are not listed again, so a group of copies gives a few rows for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, seen = Rolling(), set()
        for _, texts in each_buffer(batches):
            own, h = shingles(rolling, texts, width)
            n = np.bincount(own, minlength=len(texts))
            sid = _set_ids(own, h, n)
            fresh = np.zeros(len(n), bool)
            for i, x in enumerate(sid.tolist()):
                if x not in seen:
                    fresh[i] = True
                    if len(seen) >= remember:
                        seen.clear()
                    seen.add(x)
            keep = fresh[own]
            who, keys, band, spare = banded_keys(own[keep], h[keep], np.where(fresh, n, 0), percent)
            made = {"sid": lambda: sid[who], "slot": lambda: band + (spare << 8), "key": lambda: keys.view(np.int64)}
            yield pa.RecordBatch.from_arrays([pa.array(made[c]()) for c in names], names=list(names))

    return run


def _digest_bits(n: int) -> int:
    return max(64, 1 << (4 * n - 1).bit_length())


def _digests(width: int):
    """One parity bit for each of 4 to 8 slots an element: two sets differ in
    at least as many elements as their digests differ in bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch, texts in each_buffer(batches):
            own, h = shingles(rolling, texts, width)
            n = np.bincount(own, minlength=len(texts))
            ends = np.r_[0, np.cumsum(n)]
            out = []
            for i in range(len(texts)):
                slots = np.bincount((h[ends[i] : ends[i + 1]] >> U64(24) & U64(_digest_bits(int(n[i])) - 1)).astype(np.int64), minlength=_digest_bits(int(n[i])))
                out.append(np.packbits(slots & 1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array(n), pa.array(out, pa.binary())], names=["sid", "n", "digest"])

    return run


def _folded(digests: list[bytes]) -> np.ndarray:
    """Digests as rows of one width: the longer ones are folded onto themselves."""
    width = min(map(len, digests))
    rows = []
    for d in digests:
        x = np.frombuffer(d, U64)
        while len(x) * 8 > width:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        rows.append(x)
    return np.stack(rows)


def _may_link(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    least = np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)
    near = least * (100 + percent) <= (nx + ny) * (100 - percent)
    return near & (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny))


def _near_pairs(percent: int):
    """Those of the pairs whose digests leave a link possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("dx").to_pylist(), batch.column("dy").to_pylist()
            nx, ny = batch.column("nx").to_numpy(), batch.column("ny").to_numpy()
            keep = np.zeros(len(x), bool)
            for i in range(len(x)):
                pair = _folded([x[i], y[i]])
                keep[i] = _may_link(pair[0], nx[i], pair[1], ny[i], percent)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    return run


def _cell_pairs(percent: int, join_on_the_way: bool):
    """Pairs of one cell (a key's sets, or two blocks of them) with different
    labels whose digests leave a link possible. With ``join_on_the_way`` a pair
    found makes its two labels one, so a group gives fewer pairs than sets."""

    def cell(sid: list, salt: list, labels: list, n: list, digests: list) -> Iterator[tuple[int, np.ndarray]]:
        label = np.unique(np.array(labels), return_inverse=True)[1]
        if label.max() == 0:
            return
        sid, salt, n, rows = np.array(sid), np.array(salt), np.array(n), _folded(digests)
        both = salt.min() != salt.max()
        for i in range(len(sid) - 1):
            other = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
            if both:
                other = other[salt[other] != salt[i]]
            if not len(other):
                continue
            near = other[_may_link(rows[i], n[i], rows[other], n[other], percent)]
            if join_on_the_way:
                found = []
                for j in near:
                    if label[j] != label[i]:
                        found.append(j)
                        label[label == label[j]] = label[i]
                near = np.array(found, np.int64)
            if len(near):
                yield sid[i], sid[near]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        now, columns = None, None
        for batch in batches:
            names = [batch.column(c).to_pylist() for c in ("key", "cell", "sid", "salt", "label", "n", "digest")]
            for key, place, *row in zip(*names):
                if (key, place) != now:
                    if columns and len(columns[0]) > 1:
                        yield from cell(*columns)
                    now, columns = (key, place), [[], [], [], [], []]
                for c, v in zip(columns, row):
                    c.append(v)
        if columns and len(columns[0]) > 1:
            yield from cell(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, others, size = [], [], 0
        for one, near in cells(batches):
            ones.append(np.full(len(near), one))
            others.append(near)
            size += len(near)
            if size >= PAIRS_AT_ONCE:
                yield _pairs_batch(ones, others)
                ones, others, size = [], [], 0
        if size:
            yield _pairs_batch(ones, others)

    return run


def _pairs_batch(ones: list[np.ndarray], others: list[np.ndarray]) -> pa.RecordBatch:
    x, y = np.concatenate(ones), np.concatenate(others)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch, texts in each_buffer(batches):
            own, h = shingles(rolling, texts, width)
            ends = np.r_[0, np.cumsum(np.bincount(own, minlength=len(texts)))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("sid"), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))], names=["sid", "items"]
            )

    return run


class _Corpus:
    """The texts of one document of each set, for what needs whole sets."""

    def __init__(self, texts: DataFrame, index: DataFrame, width: int, percent: int):
        self.texts, self.width, self.percent = texts, width, percent
        self.one = index.where("n > 0").groupBy("sid").agg(F.min("rk").alias("rk"))

    def of(self, sids: DataFrame) -> DataFrame:
        chosen = sids.distinct().join(self.one, "sid")
        return self.texts.join(chosen, "rk").dropDuplicates(["sid"]).select("sid", "text")

    def digests(self, sids: DataFrame) -> DataFrame:
        return materialize(self.of(sids).mapInArrow(_digests(self.width), "sid long, n long, digest binary"), "ngram-digests")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """``pairs (a, b)`` with ``linked``, counted on the whole sets."""
        ends = pairs.select(F.col("a").alias("sid")).union(pairs.select("b"))
        sets = materialize(self.of(ends).mapInArrow(_sets(self.width), "sid long, items array<long>"), "ngram-sets")
        left = sets.select(F.col("sid").alias("a"), F.col("items").alias("x"))
        right = sets.select(F.col("sid").alias("b"), F.col("items").alias("y"))
        common = F.size(F.array_intersect("x", "y"))
        linked = common * (100 + self.percent) >= (F.size("x") + F.size("y")) * self.percent
        return materialize(
            pairs.join(left, "a").join(right, "b").select("a", "b", linked.alias("linked")), "ngram-verified"
        )


def _near(pairs: DataFrame, digests: DataFrame, percent: int) -> DataFrame:
    left = digests.select(F.col("sid").alias("a"), F.col("n").alias("nx"), F.col("digest").alias("dx"))
    right = digests.select(F.col("sid").alias("b"), F.col("n").alias("ny"), F.col("digest").alias("dy"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "nx", "ny", "dx", "dy").mapInArrow(_near_pairs(percent), "a long, b long")


#: Sets of a key that one task compares at once, and elements in them (a digest has
#: at most a byte an element); larger groups are dealt in blocks.
BLOCK, BLOCK_ELEMENTS = 4096, 1 << 25
#: Pairs that a task gathers before it hands them on: a block can have millions.
PAIRS_AT_ONCE = 1 << 16


def _allocated(listed: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """``sid``, ``key``, ``least`` and ``most`` (sets of the key) of the keys that
    stay in the index and that more than one set has. ``listed`` are rows of
    ``_KEY_ROW``, repeats allowed, ``counted`` the same without the owners; they
    are made twice, as keeping them takes more than making them. Counts are
    partial aggregates, so a frequent key is never one task's alone. They are
    written, so the shuffle files of all counted keys go before those of all
    listed keys come. Most keys are one set's only: the keys of several are the
    small side of a hash join, and the rows of all keys are not sorted for it."""
    counts = (listed if counted is None else counted).groupBy("key").agg(F.count("*").alias("uses"))
    uses = materialize(counts.where("uses > 1"), "ngram-uses")
    common = listed.join(uses.hint("shuffle_hash"), "key").distinct()
    costly = F.row_number().over(Window.partitionBy("sid", "slot").orderBy(F.col("uses").desc(), "key"))
    kept = materialize(common.withColumn("place", costly).where("place > shiftright(slot, 8)").select("sid", "key"), "ngram-kept")
    ends = kept.groupBy("key").agg(F.min("sid").alias("least"), F.max("sid").alias("most")).where("least != most")
    return kept.join(ends, "key").select("sid", "key", "least", "most")


def _still_apart(keys: DataFrame, labels: DataFrame, digests: DataFrame, percent: int, join_on_the_way: bool) -> DataFrame:
    """Pairs that share a key, aren't in one component and may be linked."""
    of = labels.select(F.col("id").alias("sid"), "label")
    sizes = digests.select("sid", F.col("n").alias("elements"))
    at = keys.select("sid", "key").join(of, "sid", "left").join(sizes, "sid").withColumn("label", F.coalesce("label", "sid"))
    mixed = (
        at.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.count("*").alias("size"), F.sum("elements").alias("elements"))
        .where("l0 != l1").select("key", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("elements") / BLOCK_ELEMENTS)).alias("blocks"))
    )
    rows = (
        at.join(mixed, "key")
        .withColumn("salt", F.pmod(F.xxhash64("sid"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("cell", F.least("salt", "other") * F.col("blocks") + F.greatest("salt", "other"))
        .join(digests, "sid")
    )
    return (
        rows.select("key", "cell", "sid", "salt", "label", "n", "digest")
        .repartition("key", "cell").sortWithinPartitions("key", "cell", "sid")
        .mapInArrow(_cell_pairs(percent, join_on_the_way), "a long, b long").distinct()
    )


def _labelled_sets(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The set of each row, and the component of each set that is linked, both written."""
    texts = keyed(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    index = materialize(texts.mapInArrow(_index(width), f"rk long, doc_id {id_type}, n long, sid long"), "ngram-index")
    corpus = _Corpus(texts, index, width, percent)
    plain = texts.select("rk", "text")
    listed = plain.mapInArrow(_keys(width, percent), _KEY_ROW)
    counted = plain.mapInArrow(_keys(width, percent, names=("key",)), "key long")
    keys = materialize(_allocated(listed, counted), "ngram-keys")
    digests = corpus.digests(keys.select("sid"))
    stars = (
        keys.where("sid != least").selectExpr("least AS a", "sid AS b")
        .union(keys.where("sid != most").selectExpr("sid AS a", "most AS b")).distinct()
    )
    likely = materialize(_near(stars, digests, percent), "ngram-likely")
    labels = connected_components(likely)
    likely = materialize(likely.union(_still_apart(keys, labels, digests, percent, True)).distinct(), "ngram-likely")
    tried = corpus.verified(likely)
    edges = tried.where("linked").select("a", "b")
    labels = connected_components(edges)
    if not tried.where("NOT linked").isEmpty():
        # a pair that digests let pass was no link: nothing may rest on it
        left = materialize(_still_apart(keys, labels, digests, percent, False), "ngram-left")
        more = corpus.verified(left.join(tried.select("a", "b"), ["a", "b"], "left_anti"))
        labels = connected_components(edges.union(more.where("linked").select("a", "b")))
    return index, labels


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``rk`` (see ``common.row_key``), id, ``n_shingles``,
    ``component_id``, the smallest id reachable over links of Jaccard similarity
    ``percent`` / 100 or more, the row's own included, and ``component``, which
    names the component: its smallest set id, never null. Ids can be null or
    repeated, so unlinked rows may share a ``component_id``; they never share a
    ``component``, except for rows without shingles, whose set is the same."""
    with session_conf(docs.sparkSession, _STEP_CONF):
        index, labels = _labelled_sets(docs, id_col, text_col, width, percent)
    found = labels.select(F.col("id").alias("sid"), "label")
    labelled = index.select("rk", "doc_id", "n", "sid").join(found, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    least = labelled.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    return labelled.join(least, "label", "left").select(
        "rk",
        F.col("doc_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("label").alias("component"),
    )

