"""Token counts that follow edits.

A tokenizer first cuts a text into pre-tokens, and each pre-token is encoded by
itself. A document's tree has blocks of consecutive pre-tokens as leaves and
keeps characters and tokens of every subtree. An edit re-encodes from the last
pre-token that cannot see the edit up to where the new cuts meet an old one
again; leaves outside stay as they are, and only the sums above the touched
leaves are renewed.

Trees are kept as a table (``build_trees``: the text, characters and tokens of
every leaf). ``edit_trees`` takes such rows with edits and returns the counts and
the new tree, so a later round of edits starts from the stored sums: no leaf
that it doesn't touch is cut or encoded again.

Why that is exact: a cut depends only on the text from it on, and a pre-token on
no more than ``CONTEXT`` characters behind its end. So what ends that far before
an edit stays, and from a common cut behind the edit everything is as it was.

Edits of a document are (start, end, replacement) in code points of the text
before any edit. They are applied from the last to the first; an edit that
overlaps a later one, or lies outside the text, is an error. Null text: empty,
0 tokens. Null edits: none. Repeated rows are counted one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.secrets import pattern_spans
from tidemark.operators.control import materialize

#: Characters behind a pre-token's end that its cut may depend on.
CONTEXT = 2
LEAF = 64


class Counter:
    """Pre-token cuts and the number of tokens of a pre-token, cached."""

    def __init__(self, ranks_path: str, pattern: str, most: int = 500_000):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.known, self.most = regex.compile(pattern), {}, most

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        new = {p for p in pieces if p not in known}
        if new:
            if len(known) > self.most:
                known.clear()
                new = set(pieces)
            for p in new:
                known[p] = len(self.encoding.encode_ordinary(p))
        return list(map(known.__getitem__, pieces))


@cache
def counter_of(ranks_path: str, pattern: str) -> Counter:
    """One counter for a Python worker: later tasks start with its cache."""
    return Counter(ranks_path, pattern)


class TokenTree:
    """Pre-tokens of one text in leaves under a heap of sums.

    With ``stored`` (characters and tokens of each leaf, as ``leaf_sums`` gave
    them) nothing is encoded, and a leaf is cut only when an edit comes to it."""

    def __init__(self, counter: Counter, text: str, stored: tuple[list[int], list[int]] | None = None):
        self.counter, self.reencoded, self.origin = counter, 0, text
        self.leaves: list[list[str] | None]
        if stored is None:
            pieces = counter.cut(text)
            self.leaves = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
            counts = counter.counts(pieces)
            stored = [sum(map(len, leaf)) for leaf in self.leaves], [sum(counts[i : i + LEAF]) for i in range(0, len(pieces), LEAF)] or [0]
        else:
            if sum(stored[0]) != len(text) or len(stored[0]) != len(stored[1]):
                raise ValueError("a stored tree that is not the text's")
            self.leaves = [None] * len(stored[0])
        self.at = np.cumsum([0, *stored[0]])
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars = np.zeros(2 * self.size, np.int64)
        self.tokens = np.zeros(2 * self.size, np.int64)
        self.chars[self.size : self.size + len(self.leaves)], self.tokens[self.size : self.size + len(self.leaves)] = stored
        for s in (self.chars, self.tokens):
            low = self.size
            while low > 1:
                s[low // 2 : low] = s[low : 2 * low : 2] + s[low + 1 : 2 * low : 2]
                low //= 2

    def _leaf(self, i: int) -> list[str]:
        """The leaf's pre-tokens. One not edited yet is cut out of the first text:
        from its start on the cuts are the text's."""
        if self.leaves[i] is None:
            start, end, pieces = int(self.at[i]), int(self.at[i + 1]), []
            while start < end:
                m = self.counter.pattern.match(self.origin, start)
                pieces.append(m.group())
                start = m.end()
            self.leaves[i] = pieces
        return self.leaves[i]

    def leaf_sums(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of each leaf: empty leaves left out, leaves grown
        to more than twice ``LEAF`` cut up."""
        chars, tokens = [], []
        for i, leaf in enumerate(self.leaves):
            if leaf is not None and len(leaf) > 2 * LEAF:
                counts = self.counter.counts(leaf)
                for k in range(0, len(leaf), LEAF):
                    chars.append(sum(map(len, leaf[k : k + LEAF])))
                    tokens.append(sum(counts[k : k + LEAF]))
            elif self.chars[self.size + i]:
                chars.append(int(self.chars[self.size + i]))
                tokens.append(int(self.tokens[self.size + i]))
        return chars or [0], tokens or [0]

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def text(self) -> str:
        parts = (self.origin[self.at[i] : self.at[i + 1]] if leaf is None else "".join(leaf) for i, leaf in enumerate(self.leaves))
        return "".join(parts)

    def _leaf_at(self, position: int) -> tuple[int, int]:
        """Leaf that holds the character (the last one behind the end), and the characters before it."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if position - before >= self.chars[node]:
                before += int(self.chars[node])
                node += 1
        leaf = min(node - self.size, len(self.leaves) - 1)
        return leaf, before if leaf == node - self.size else int(self.chars[1] - self.chars[self.size + leaf])

    def _set_leaf(self, i: int, pieces: list[str], tokens: int) -> None:
        self.leaves[i] = pieces
        node = self.size + i
        self.chars[node], self.tokens[node] = sum(map(len, pieces)), tokens
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int, end: int, replacement: str) -> None:
        first, at = self._leaf_at(max(0, start - CONTEXT - 1))
        skip = 0  # pre-tokens of the first leaf that cannot see the edit
        for piece in self._leaf(first):
            if at + len(piece) > start - CONTEXT:
                break
            at += len(piece)
            skip += 1
        pieces, last = self._leaf(first)[skip:], first
        length = sum(map(len, pieces))
        need = end - at + 1
        while True:
            while length < need and last + 1 < len(self.leaves):
                last += 1
                pieces = pieces + self._leaf(last)
                length += int(self.chars[self.size + last])
            whole = last + 1 == len(self.leaves)
            old = "".join(pieces)
            new = old[: start - at] + replacement + old[end - at :]
            shift = len(replacement) - (end - start)
            cuts = set((np.cumsum([0, *map(len, pieces)]) + shift).tolist())
            fresh, met = [], None
            for m in self.counter.pattern.finditer(new):
                if m.start() >= start - at + len(replacement) and m.start() in cuts:
                    met = m.start() - shift
                    break
                if not whole and m.end() + CONTEXT > len(new):
                    break
                fresh.append(m.group())
            else:
                met = length if whole else None
            if met is not None:
                break
            need = length + 1
        kept, seen = len(pieces), length
        while seen > met:
            kept -= 1
            seen -= len(pieces[kept])
        merged = self._leaf(first)[:skip] + fresh + pieces[kept:]
        self.reencoded += len(fresh)
        before = int(self.tokens[self.size + first : self.size + last + 1].sum())
        counts = self.counter.counts(fresh + pieces[:kept])
        self._set_leaf(first, merged, before + sum(counts[: len(fresh)]) - sum(counts[len(fresh) :]))
        for i in range(first + 1, last + 1):
            self._set_leaf(i, [], 0)


_SUMS = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("leaf_chars", "leaf_tokens")]
_COUNTS = [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_edits", "n_tokens_edited", "n_reencoded")]


def _built(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(ranks_path, pattern)
        for batch in batches:
            sums = [TokenTree(counter, text).leaf_sums() for text in batch.column("text").to_pylist()]
            lists = [pa.array([s[k] for s in sums], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "leaf_chars", "leaf_tokens"])

    return run


def _edited(ranks_path: str, pattern: str, keep_trees: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(ranks_path, pattern)
        for batch in batches:
            out: dict[str, list] = {"n_tokens": [], "n_edits": [], "n_tokens_edited": [], "n_reencoded": []}
            trees: dict[str, list] = {"text": [], "leaf_chars": [], "leaf_tokens": []}
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "leaf_chars", "leaf_tokens", "edits")))
            for text, chars, tokens, edits in rows:
                edits, limit = sorted(edits or (), key=lambda e: (e["start"], e["end"])), len(text)
                tree = TokenTree(counter, text, (chars, tokens)) if edits else None
                for e in reversed(edits):
                    if not 0 <= e["start"] <= e["end"] <= limit:
                        raise ValueError("edits overlap or leave the text")
                    limit = e["start"]
                    tree.edit(e["start"], e["end"], e["replacement"] or "")
                before = sum(tokens)
                for c, v in zip(out, (before, len(edits), tree.total if tree else before, tree.reencoded if tree else 0)):
                    out[c].append(v)
                if keep_trees:
                    for c, v in zip(trees, (tree.text(), *tree.leaf_sums()) if tree else (text, chars, tokens)):
                        trees[c].append(v)
            arrays = [batch.column("doc_id"), *(pa.array(v, pa.int64()) for v in out.values())]
            if keep_trees:
                arrays += [pa.array(trees["text"], pa.string()), *(pa.array(trees[c], pa.list_(pa.int32())) for c in ("leaf_chars", "leaf_tokens"))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *out, *(trees if keep_trees else ())])

    return run


def build_trees(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``text`` (null: empty), ``leaf_chars`` and
    ``leaf_tokens``. Write it to keep it."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _with_trees(rows, ranks_path, pattern).withColumnRenamed("doc_id", id_col)


def _with_trees(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    return rows.mapInArrow(_built(ranks_path, pattern), T.StructType([*rows.schema.fields, *_SUMS]))


def edit_trees(trees: DataFrame, edits: Column, ranks_path: str, pattern: str, id_col: str = "doc_id", keep_trees: bool = True) -> DataFrame:
    """Per row of ``trees`` (of ``build_trees`` or an earlier ``edit_trees``): id,
    ``n_tokens`` before the ``edits`` (array of start, end, replacement),
    ``n_edits``, ``n_tokens_edited``, ``n_reencoded`` (pre-tokens encoded again)
    and, with ``keep_trees``, the tree of the edited text. A tree whose
    characters are not its text's is an error."""
    rows = trees.select(F.col(id_col).alias("doc_id"), "text", "leaf_chars", "leaf_tokens", edits.alias("edits"))
    schema = T.StructType([rows.schema["doc_id"], *_COUNTS, *([rows.schema["text"], *_SUMS] if keep_trees else ())])
    out = rows.mapInArrow(_edited(ranks_path, pattern, keep_trees), schema)
    return out.withColumnRenamed("doc_id", id_col)


def redactions(text_col: str, pattern: str, replacement: str) -> Column:
    """Edits that replace every match of ``pattern``."""
    return F.transform(pattern_spans(text_col, pattern, 0), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(replacement).alias("replacement")))


def edited_counts(
    docs: DataFrame, edits: Column, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """The counts of ``edit_trees`` for trees of ``docs``, which are written
    first; ``edits`` are of the columns of ``docs``. With ``keep_text`` the
    ``edited`` text comes along."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), edits.alias("edits"))
    trees = materialize(_with_trees(rows, ranks_path, pattern), "token-trees")
    out = edit_trees(trees, F.col("edits"), ranks_path, pattern, "doc_id", keep_trees=keep_text)
    return out.drop("leaf_chars", "leaf_tokens").withColumnsRenamed({"text": "edited", "doc_id": id_col})
