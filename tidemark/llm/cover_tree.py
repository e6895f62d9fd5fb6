"""A cover tree over one block of integer vectors, as numpy arrays.

Candidates are augmented by one component to a common norm, so all lie on a
sphere; a query is augmented by zero, which leaves inner products as they are.
Each level covers the block by centres taken farthest first, and holds for every
centre the largest angle to a point below it. With the angle between query and
centre that bounds all inner products below a node from above and below.

A node of one point repeated any number of times has radius zero and is a leaf of
any size. Bounds are widened by ``SLACK``; leaves are verified exactly: integers,
whose products and sums stay below 2**53.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

#: Points of a leaf, children of a node, ratio of a level's radius to the next one's.
LEAF, FAN, BASE = 128, 16, 1.3
#: Levels after which what is left becomes a leaf as it is.
MAX_LEVELS = 40
#: Radians by which a covering radius is widened; points within it are one.
SLACK = 1e-6
#: Leaves verified at a time.
TOGETHER = 8

NO_SCORE = -(2**62)
NO_ID = 2**63 - 1


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return {k: found[k] for k in found.files}


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _children(points: np.ndarray, members: np.ndarray, centre: int, radius: float) -> list[tuple[int, np.ndarray, float]]:
    """Centres taken farthest first until all members are within ``radius`` or
    there are ``FAN``, each with the members nearest to it and its own radius."""
    here = points[members]
    near = _angle(here @ points[centre])
    of, centres = np.zeros(len(members), np.int64), [centre]
    while len(centres) < FAN and near.max() > radius:
        next_ = int(near.argmax())
        away = _angle(here @ here[next_])
        away[next_] = 0.0
        closer = away < near
        near[closer], of[closer] = away[closer], len(centres)
        centres.append(members[next_])
    kept = ((c, of == k) for k, c in enumerate(centres))
    return [(c, members[mine], float(near[mine].max())) for c, mine in kept if mine.any()]


def build(vectors: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """The tree's arrays: ``order`` of the points by leaf, ``starts`` of the
    leaves in it, ``norm`` of the sphere and, for all levels one behind another
    (``sizes`` nodes each), ``centre``, ``radius``, ``parent`` (in the level
    before) and ``marks`` (a bit for each label below, labels modulo 64)."""
    x = vectors.astype(float)
    squares = np.einsum("ij,ij->i", x, x)
    norm = float(np.sqrt(squares.max())) if len(x) else 0.0
    points = np.concatenate([x, np.sqrt(np.maximum(norm**2 - squares, 0))[:, None]], axis=1)
    points /= norm or 1.0
    if not norm:
        points[:, -1] = 1.0  # zero vectors only: one point of the sphere
    first = int((points @ points.mean(axis=0)).argmax())
    everyone = np.arange(len(x))
    level = [(first, everyone, float(_angle(points @ points[first]).max()))]
    parents = [np.zeros(1, np.int64)]
    levels = [level]
    inner = lambda node: len(node[1]) > LEAF and node[2] > SLACK
    while any(map(inner, level)) and len(levels) < MAX_LEVELS:
        below, parent = [], []
        for k, node in enumerate(level):
            found = _children(points, node[1], node[0], node[2] / BASE) if inner(node) else [node]
            below += found
            parent += [k] * len(found)
        level = below
        levels.append(level)
        parents.append(np.array(parent))
    bit = np.uint64(1) << (labels % 64).astype(np.uint64)
    nodes = [node for each in levels for node in each]
    return {
        "order": np.concatenate([m for _, m, _ in level]),
        "starts": np.cumsum([0] + [len(m) for _, m, _ in level]),
        "norm": np.array(norm),
        "sizes": np.array([len(each) for each in levels]),
        "centre": np.array([c for c, _, _ in nodes]),
        "radius": np.array([r for _, _, r in nodes]) + SLACK,
        "parent": np.concatenate(parents),
        "marks": np.array([np.bitwise_or.reduce(bit[m]) for _, m, _ in nodes], np.uint64),
    }


@dataclass
class Queries:
    """Query vectors with their own label and row, windows of scores (``low`` to
    ``high``, both included, per query and window) and the best found so far of
    each window, higher scores and then smaller ids first."""

    vectors: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    best: int

    def __post_init__(self):
        shape = (*self.low.shape, self.best)
        self.scores = np.full(shape, NO_SCORE, np.int64)
        self.ids = np.full(shape, NO_ID, np.int64)

    def needed(self) -> np.ndarray:
        """Least score that can still enter each window."""
        return np.maximum(self.low, self.scores[..., -1])


def _enter(q: Queries, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
    for w in range(q.low.shape[1]):
        of_window = (scores >= max(q.low[i, w], q.scores[i, w, -1])) & (scores <= q.high[i, w])
        if of_window.any():
            all_scores = np.concatenate([q.scores[i, w], scores[of_window]])
            all_ids = np.concatenate([q.ids[i, w], ids[of_window]])
            first = np.lexsort((all_ids, -all_scores))[: q.best]
            q.scores[i, w], q.ids[i, w] = all_scores[first], all_ids[first]


def search(block: dict[str, np.ndarray], q: Queries, same_label: bool, at_a_time: int = 256) -> None:
    """Enter the block's points of the query's label (or of any other label)
    into the windows. The query's own row takes no part.

    ``block``: the tree's arrays, and in leaf order ``vectors``, ``labels``,
    ``rows`` and ``ids``."""
    for at in range(0, len(q.rows), at_a_time):
        _search(block, q, same_label, np.arange(at, min(at + at_a_time, len(q.rows))))


def _search(block: dict[str, np.ndarray], q: Queries, same_label: bool, some: np.ndarray) -> None:
    vectors, norm = block["float"], float(block["norm"])
    x = q.vectors[some].astype(float)
    lengths = np.sqrt(np.einsum("ij,ij->i", x, x)) * norm
    own = np.uint64(1) << (q.labels[some] % 64).astype(np.uint64)
    keep, at = np.ones((len(some), 1), bool), 0
    for size in block["sizes"]:
        level = slice(at, at + size)
        at += size
        cosine = (x @ vectors[block["place"][block["centre"][level]]].T) / np.where(lengths > 0, lengths, 1)[:, None]
        angle, radius = _angle(cosine), block["radius"][level][None, :]
        upper = np.where(angle <= radius, 1.0, np.cos(angle - radius)) * lengths[:, None] + 0.5
        lower = np.cos(np.minimum(angle + radius, np.pi)) * lengths[:, None] - 0.5
        keep = keep[:, block["parent"][level]]
        if same_label:
            keep = keep & ((own[:, None] & block["marks"][level][None, :]) != 0)
        open_ = np.zeros_like(keep)
        for low, high in zip(q.needed()[some].T, q.high[some].T):
            open_ |= (lower <= high[:, None]) & (upper >= low[:, None])
        keep = keep & open_
    starts = block["starts"]
    for k, i in enumerate(some):
        leaves = np.flatnonzero(keep[k])
        leaves = leaves[np.argsort(-upper[k, leaves], kind="stable")]
        for first in range(0, len(leaves), TOGETHER):
            few = leaves[first : first + TOGETHER]
            need = q.needed()[i]
            reach = (lower[k, few, None] <= q.high[i]) & (upper[k, few, None] >= need) & (need <= q.high[i])
            few = few[reach.any(axis=1)]
            if not len(few):
                if not (upper[k, leaves[first]] >= need).any():
                    break
                continue
            members = np.concatenate([np.arange(starts[f], starts[f + 1]) for f in few])
            fits = (block["labels"][members] == q.labels[i]) == same_label
            members = members[fits & (block["rows"][members] != q.rows[i])]
            scores = np.rint(vectors[members] @ x[k]).astype(np.int64)
            _enter(q, i, scores, block["ids"][members])


def load(data: bytes) -> dict[str, np.ndarray]:
    """A stored block, with its vectors as doubles and the place of each point
    in leaf order."""
    block = unpack(data)
    block["float"] = block["vectors"].astype(float)
    block["place"] = np.argsort(block["order"])
    return block


def store(ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> bytes:
    """A block's tree and points, in leaf order, as bytes."""
    tree = build(vectors, labels)
    order = tree["order"]
    return pack(**tree, ids=ids[order], rows=rows[order], labels=labels[order], vectors=vectors[order])
