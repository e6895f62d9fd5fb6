"""Statistics and the split of a tree of the quality classifier against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np

from tidemark.llm import quality
from tidemark.llm.common import Rolling


def plain(t):
    words, lines, n = re.findall(rb"[^\x00-\x20]+", t), [x for x in t.split(b"\n") if x], max(len(t), 1)
    lengths, w, k = [len(x) for x in words], max(len(words), 1), max(len(lines), 1)
    mean = sum(lengths) / w
    share = lambda test: sum(map(test, words)) / w
    out = {name: sum(t.count(bytes([b])) for b in of) / n for name, of in quality._CLASSES.items()}
    return out | {
        "log_bytes": math.log1p(len(t)), "log_words": math.log1p(len(words)), "word_mean": mean,
        "word_sd": math.sqrt(max(sum(x * x for x in lengths) / w - mean**2, 0)), "word_max": max(lengths, default=0),
        "distinct_words": len(set(words)) / w, "top_word": max(Counter(words).values(), default=0) / w,
        "short_words": share(lambda x: len(x) <= 3), "long_words": share(lambda x: len(x) >= 12),
        "lines": math.log1p(len(lines)), "line_mean": len(t) / k, "distinct_lines": len(set(lines)) / k,
        "top_line": max(Counter(lines).values(), default=0) / k, "stop_words": share(lambda x: len(x) <= 4 and 97 <= x[0] < 123),
        "distinct_pairs": len(set(zip(words, words[1:]))) / max(len(words) - 1, 1), "capital_words": share(lambda x: 65 <= x[0] < 91),
        "entropy": -sum(c / n * math.log2(c / n) for c in Counter(t).values()),
    }


def test_statistics_as_plain_python_counts_them():
    rnd = random.Random(2)
    parts = ["the ", "Word ", "é", "\n", "\n\n", "1234", " extraordinarily", ". ", "?!", "$", "(x)", "\t", "a ", "\r\n"]
    texts = ["", " ", "\n", "a", "the the the"] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 300))) for _ in range(80)]
    texts = [t.encode() for t in texts]
    got = quality.statistics(Rolling(), texts)
    want = np.array([[plain(t)[f] for f in quality.FEATURES] for t in texts])
    np.testing.assert_allclose(got, want, rtol=1e-5, atol=1e-5)


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for _ in range(10):
        x = rng.integers(0, 12, (200, 5)).astype(np.float32)
        y = (x[:, int(rng.integers(5))] + rng.normal(0, 2, 200) > 6).astype(float)
        tree = quality.Trees.fit(x, y, trees=1, depth=1, rate=0.1, bins=16, ridge=1.0)
        p = y.mean()
        grad, hess = y - p, p * (1 - p)

        def gain(right):
            parts = [(grad[m].sum(), hess * m.sum()) for m in (~right, right, right | ~right)]
            if min(parts[0][1], parts[1][1]) < 1:
                return 0.0
            a, b, whole = (g * g / (h + 1) for g, h in parts)
            return a + b - whole

        every = [gain(x[:, j] > c) for j in range(5) for c in np.unique(np.quantile(x[:, j], np.arange(1, 16) / 16))]
        right = x[:, tree.feature[0, 0]] > tree.limit[0, 0]
        assert math.isclose(gain(right), max(every), rel_tol=1e-9)
        for side, value in zip((~right, right), tree.value[0]):
            assert math.isclose(value, 0.1 * grad[side].sum() / (hess * side.sum() + 1), rel_tol=1e-9)
