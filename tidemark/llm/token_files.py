"""Token ids in seekable files of independent zstandard frames.

A file holds documents in order. Layout, all numbers little-endian:

* frames: each a whole zstandard frame of the ids of consecutive documents, as
  unsigned 16-bit integers if the vocabulary allows, else 32-bit;
* the document table: one zstandard frame of five 64-bit numbers a document: its
  frame, its first id in the frame, its number of ids, its own integer id, and 1
  if it has one (0: null);
* the seek table: for every frame offset, compressed and raw size (64 bits each)
  and the CRC-32 of the compressed bytes; the last entry is the document table;
* footer: number of entries, bytes of an id, version, magic (32 bits each).

A reader opens the footer and the tables and then decompresses only the frames
of the documents it wants, checking each frame's CRC.

Documents are dealt by ranges of their id, so each task writes the file of its
range and all files together are in order. The attempt that commits is the one
whose file name is in the manifest; a lost executor's file is never read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rolling, row_key
from tidemark.operators.control import materialize
from tidemark.session import scratch_path

MAGIC, VERSION = 0x544D4B5A, 1
_ENTRY = struct.Struct("<QQQI")
_FOOTER = struct.Struct("<IIII")
#: Ids in a frame before it is closed; a longer document has a frame to itself.
FRAME_IDS = 1 << 17
END_ID = 2


class FrameWriter:
    def __init__(self, sink, id_bytes: int, frame_ids: int = FRAME_IDS, level: int = 3):
        self.sink, self.dtype, self.frame_ids = sink, np.dtype(f"<u{id_bytes}"), frame_ids
        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.pending: list[np.ndarray] = []
        self.held, self.at = 0, 0
        self.entries: list[tuple[int, int, int, int]] = []
        self.table: list[tuple[int, int, int, int, int]] = []

    def add(self, ids: np.ndarray, doc_id: int | None) -> None:
        if self.held and self.held + len(ids) > self.frame_ids:
            self._close_frame()
        self.table.append((len(self.entries), self.held, len(ids), doc_id or 0, int(doc_id is not None)))
        self.pending.append(ids.astype(self.dtype))
        self.held += len(ids)

    def _frame(self, raw: bytes) -> None:
        packed = self.zip.compress(raw)
        self.sink.write(packed)
        self.entries.append((self.at, len(packed), len(raw), zlib.crc32(packed)))
        self.at += len(packed)

    def _close_frame(self) -> None:
        if self.pending:
            self._frame(np.concatenate(self.pending).tobytes())
            self.pending, self.held = [], 0

    def finish(self) -> None:
        self._close_frame()
        self._frame(np.array(self.table, "<i8").reshape(-1, 5).tobytes())
        for e in self.entries:
            self.sink.write(_ENTRY.pack(*e))
        self.sink.write(_FOOTER.pack(len(self.entries), self.dtype.itemsize, VERSION, MAGIC))


class FrameReader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        n, id_bytes, version, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not a token file")
        self.dtype = np.dtype(f"<u{id_bytes}")
        seek = self._at(size - _FOOTER.size - n * _ENTRY.size, n * _ENTRY.size)
        self.entries = list(_ENTRY.iter_unpack(seek))
        self.table = np.frombuffer(self._frame(n - 1), "<i8").reshape(-1, 5)
        self._cached: tuple[int, np.ndarray] | None = None

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def _frame(self, i: int) -> bytes:
        offset, packed, raw, crc = self.entries[i]
        data = self._at(offset, packed)
        if zlib.crc32(data) != crc:
            raise ValueError(f"frame {i} is damaged")
        return zstandard.ZstdDecompressor().decompress(data, max_output_size=raw)

    def __len__(self) -> int:
        return len(self.table)

    def document(self, i: int) -> np.ndarray:
        frame, first, n = self.table[i, :3].tolist()
        if self._cached is None or self._cached[0] != frame:
            self._cached = frame, np.frombuffer(self._frame(frame), self.dtype)
        return self._cached[1][first : first + n]


class Encoder:
    """Ids of whole texts through a cache of the ids of their pieces.

    The tokenizer composes and lower-cases a text and cuts it into words, single
    digits and runs of marks, which it encodes one by one. Texts of ASCII and the
    common Latin letters are composed already; they are cut here in the same way,
    a group of texts at once, and pieces are looked up by a 64-bit hash. Those not
    met yet are encoded many at once, joined by spaces; each ends in the one id
    that carries the end-of-word mark. If the numbers of pieces and marks differ,
    each piece is encoded by itself.

    Other texts are cut at spaces and line ends, which the tokenizer drops and
    never joins across, and their new chunks are encoded one by one. Texts that
    hold a special token are encoded whole.
    """

    #: ASCII and U+00C0 to U+017F without the signs for times and divide and the
    #: capital I with a dot, which lower-cases to two characters
    _LATIN = re.compile("[\x00-\x7F\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F]*")
    _SPACE, _LETTER, _DIGIT, _MARK = range(4)
    #: fixed values: endings that the tokenizer takes as one piece with an apostrophe before them
    _ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
    _JOINED = 512
    _SECTION = 1 << 21

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.full.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.special = [t.content.lower() for t in self.full.get_added_tokens_decoder().values()]
        suffix = self.full.model.end_of_word_suffix
        vocabulary = self.full.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.kind = np.full(256, self._MARK, np.uint8)
        self.kind[[0x20, *range(0x09, 0x0E)]] = self._SPACE
        self.kind[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = self._LETTER
        self.kind[ord("0") : ord("9") + 1] = self._DIGIT
        self.rolling, self.most = Rolling(), most
        self.chunks: dict[str, np.ndarray] = {}
        self._forget()

    def _forget(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    @staticmethod
    def _encoded(tokenizer, texts: list[str]) -> list[np.ndarray]:
        encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        return [np.array(e.ids, np.uint32) for e in encode(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        ids, count = [self.ids], [self.count]
        joined = [pieces[i : i + self._JOINED] for i in range(0, len(pieces), self._JOINED)]
        for group, found in zip(joined, self._encoded(self.plain, [" ".join(g) for g in joined])):
            counts = np.diff(np.flatnonzero(self.last[found]), prepend=-1)
            if len(counts) != len(group):
                each = self._encoded(self.full, group)
                found, counts = np.concatenate(each), np.array([len(x) for x in each])
            ids.append(found)
            count.append(counts)
        self.ids, self.count = np.concatenate(ids), np.concatenate(count)
        self.first = np.cumsum(self.count) - self.count
        rows = np.arange(len(self.count) - len(keys), len(self.count))
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.rows = np.insert(self.keys, at, keys[order]), np.insert(self.rows, at, rows[order])

    def _cut(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every piece; ``data`` ends in three spaces or line ends."""
        kind = self.kind[data]
        start = kind != self._SPACE
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == self._DIGIT)
        quote = np.flatnonzero(start & (data == ord("'")))
        for ending in self._ENDINGS:
            hit = quote[np.all([data[quote + 1 + k] == ord(c) for k, c in enumerate(ending)], axis=0)]
            start[hit + 1] = False
            after = hit + 1 + len(ending)
            start[after] = kind[after] != self._SPACE
        edges = np.flatnonzero(start | (kind == self._SPACE))
        begins = np.flatnonzero(start[edges])
        return edges[begins], edges[begins + 1]

    def _latin(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of lower-case texts of Latin letters."""
        raw = [t.encode() for t in texts]
        buffer = b"\n".join([*raw, b"\n\n"])
        data = np.frombuffer(buffer, np.uint8)
        start, end = self._cut(data)
        codes, keys = pd.factorize(self.rolling.spans(self.rolling.prefix(data), start, end))
        if len(self.keys) > self.most:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        new = np.flatnonzero(np.append(self.keys, np.uint64(0))[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            seen = np.zeros(len(keys), np.int64)
            seen[codes[::-1]] = np.arange(len(codes))[::-1]
            self._learn(keys[new], [buffer[i:j].decode() for i, j in zip(start[seen[new]].tolist(), end[seen[new]].tolist())])
        row = self.rows[np.searchsorted(self.keys, keys)][codes]
        count = self.count[row]
        below = np.cumsum(count) - count
        ids = self.ids[np.repeat(self.first[row] - below, count) + np.arange(count.sum())]
        ends = np.searchsorted(start, np.cumsum([len(r) + 1 for r in raw]))
        return np.split(ids, np.append(below, len(ids))[ends])[: len(texts)]

    def _long(self, texts: list[str]) -> Iterator[np.ndarray]:
        """As ``_latin``, a section up to a space at a time: memory stays bounded."""
        for text in texts:
            at, ids = 0, []
            while at < len(text):
                end = text.find(" ", at + self._SECTION) + 1 or len(text)
                ids += self._latin([text[at:end]])
                at = end
            yield np.concatenate(ids)

    def _by_chunks(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.chunks) > self.most:
            self.chunks.clear()
        chunked = [t.replace("\n", " ").split(" ") for t in texts]
        new = list(set().union(*chunked).difference(self.chunks))
        self.chunks.update(zip(new, self._encoded(self.full, new)))
        return (np.concatenate([self.chunks[c] for c in chunks]) for chunks in chunked)

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        ways, of = [], ([], [], [], [])
        for text in texts:
            low = text.lower()
            way = 0 if any(t in low for t in self.special) else 1 if not self._LATIN.fullmatch(text) else 2 if len(text) <= self._SECTION else 3
            of[way].append(low if way > 1 else text)
            ways.append(way)
        found = [iter(f(t) if t else ()) for f, t in zip((partial(self._encoded, self.full), self._by_chunks, self._latin, self._long), of)]
        return (next(found[way]) for way in ways)


@cache
def encoder_of(path: str) -> Encoder:
    """One encoder for a Python worker: later tasks start with its cache."""
    return Encoder(path)


def _groups(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size > most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _write(folder: str, vocabulary: str, end_id: int, id_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = None
        first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = encoder_of(vocabulary)
                fs, path = pafs.FileSystem.from_uri(folder)
                name = f"{path}/{uuid.uuid4().hex}.tokens"
                fs.create_dir(path, recursive=True)
                sink = fs.open_output_stream(name)
                writer = FrameWriter(sink, id_bytes)
                first = batch.column("part")[0].as_py()
            doc_ids = iter(batch.column("doc_id").to_pylist())
            for group in _groups(batch.column("text").to_pylist()):
                for x in encoder(group):
                    writer.add(np.append(x, np.uint32(end_id)), next(doc_ids))
        if writer is not None:
            writer.finish()
            sink.close()
            total = sum(row[2] for row in writer.table)
            yield pa.RecordBatch.from_pylist(
                [{"part": first, "file": name.rsplit("/", 1)[1], "n_docs": len(writer.table), "n_ids": total}],
                schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

    return run


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds ``start``, the sum of ``n_ids`` over all smaller ``part`` numbers.

    Sums are made for every aligned range of 1, 2, 4, ... parts; the parts below
    a number are one such range for each of its binary ones. So no task has to
    see all files in order.
    """
    at = F.expr("shiftright(part, level)")
    ranges = manifest.select("part", "n_ids", F.expr("explode(sequence(0, 30)) AS level")).groupBy("level", at.alias("range")).agg(F.sum("n_ids").alias("ids"))
    wanted = manifest.select("part", F.expr("explode(filter(sequence(0, 30), i -> shiftright(part, i) % 2 = 1)) AS level")).select("part", "level", (at - 1).alias("range"))
    starts = wanted.join(ranges, ["level", "range"]).groupBy("part").agg(F.sum("ids").alias("start"))
    return manifest.join(starts, "part", "left").withColumn("start", F.coalesce("start", F.lit(0).cast("long")))


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, vocabulary_size: int = 49_408) -> DataFrame:
    """Encode whole texts and write them in id order under ``folder``, a URI all
    executors share. Returns the manifest ``(part, file, n_docs, n_ids, start)``,
    one row a file; ``start`` counts the ids of all files before.

    Ids of documents are integers. Null text: empty, only the end id. Null ids come last; equal ids are ordered
    by their text. An empty table has an empty manifest.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("rk")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), row_key(id_col, text_col).alias("rk"))
    ranged = texts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    manifest = materialize(
        ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(
            _write(folder, vocabulary, end_id, 2 if max(vocabulary_size, end_id + 1) <= 1 << 16 else 4), "part int, file string, n_docs long, n_ids long"
        ),
        "token-manifest",
    )
    return with_starts(manifest)


def _read(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{path}/{row['file']}") as source:
                    reader = FrameReader(source)
                    at = row["start"]
                    n = reader.table[:, 2]
                    starts = at + np.cumsum(n) - n
                    for a in range(0, len(reader), 4096):
                        crc = [zlib.crc32(reader.document(i).astype("<u4").tobytes()) for i in range(a, min(a + 4096, len(reader)))]
                        b = a + len(crc)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(reader.table[a:b, 3], mask=reader.table[a:b, 4] == 0), pa.array(starts[a:b]), pa.array(n[a:b]), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return run


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read back
    from the files, about one task for each."""
    files = manifest.select("file", "start")
    return files.repartition(max(1, files.count())).mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark) -> str:
    path = scratch_path(spark, "token-files")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
