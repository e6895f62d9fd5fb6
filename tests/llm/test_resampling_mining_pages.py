"""Importance resampling, hard negatives and main text against brute force, and
their edge cases: nulls in any column, empty and long inputs, ties, repeated rows,
empty tables, extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import cover_tree, hard_negatives, importance, main_text
from tidemark.llm.main_text import extract

DOCS = "doc_id long, text string, bucket string, n long, score string, position int"


def docs(spark, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "b", None, "s", 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# --- importance resampling -------------------------------------------------------------


def expected_sample(texts, ids, target, width, buckets, percent, least):
    def words(t):
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def found(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[k : k + n]).encode()) % buckets for n in range(1, width + 1) for k in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for x in texts:
        s.update(found(x))
    for x in target:
        t.update(found(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * float(S + buckets) / (float(s[b] + 1) * float(T + buckets)))) for b in range(buckets)]
    out = []
    for x, i in zip(texts, ids):
        f = found(x)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, len(words(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = enough[: percent * len(enough) // 100]
    return out, drawn


@pytest.mark.parametrize("width", [1, 3])
def test_resampling_by_brute_force(spark, width):
    rnd = random.Random(3)
    names = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(60)] + ["A", "Z9", "ß", "12"]
    sep = [" ", "\n", "-", "A ", " \x00", "_"]
    text = lambda n: "".join(rnd.choice(names) + rnd.choice(sep) for _ in range(n))
    texts = [None, "", " ", "one", *(text(rnd.randint(1, 60)) for _ in range(80)), text(30_000)]
    texts += [texts[10]] * 3 + ["x " * 25] * 4
    ids = [*range(len(texts) - 6), None, None, 5, 5, 5, 7]
    target = [None, "", "w1 w2 w3 w4", *(text(8) for _ in range(5))]
    got = importance.resample(
        docs(spark, texts, ids), docs(spark, target), percent=30, least_words=9, buckets=500, width=width
    ).collect()
    want, drawn = expected_sample(texts, ids, target, width, 500, 30, 9)
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    ranked = sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(r[0], r[4]) for r in drawn]


def test_resampling_of_empty_tables(spark):
    some, none = docs(spark, ["a b c"] * 30), docs(spark, [])
    assert importance.resample(none, some).collect() == []
    got = importance.resample(some, none, least_words=1).collect()
    assert len(got) == 30 and sum(r.rank is not None for r in got) == 3


def test_runs_of_words_end_with_their_text():
    bucket_of = importance._BucketOf(10_000)
    who, what, words = importance.features([b"a B", b"", b"c", b"AA"], 2, bucket_of)
    crc = lambda b: zlib.crc32(b) % 10_000
    assert sorted(zip(who, what)) == sorted([(0, crc(b"a")), (0, crc(b"b")), (0, crc(b"a b")), (2, crc(b"c")), (3, crc(b"aa"))])
    assert words.tolist() == [2, 0, 1, 1]


def test_a_full_memory_of_buckets_gives_the_same(monkeypatch):
    monkeypatch.setattr(importance, "REMEMBERED", 3)
    texts = [b"a b c d e f g a b c", b"long" * 40 + b" a"]
    want = importance.features(texts, 1, importance._BucketOf(97))
    got = importance.features(texts, 1, importance._BucketOf(97))
    assert all((a == b).all() for a, b in zip(want, got))
    assert (want[1] == [zlib.crc32(w) % 97 for t in texts for w in t.split()]).all()


# --- hard negatives --------------------------------------------------------------------


def expected_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    taken = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        if sum(c * c for c in x) < 2**53:
            taken.append((i, x, label))
    out = Counter()
    order = lambda r: (-r[1], r[0] is None, r[0])
    for k, (i, q, label) in enumerate(taken):
        if not is_anchor(i):
            continue
        scored = [(j, sum(a * b for a, b in zip(q, x)), lab) for m, (j, x, lab) in enumerate(taken) if m != k and len(x) == len(q)]
        for p in sorted((r for r in scored if r[2] == label), key=order)[:positives]:
            fits = [r for r in scored if r[2] != label and low * p[1] <= 100 * r[1] <= high * p[1]]
            for rank, n in enumerate(sorted(fits, key=order)[:negatives], 1):
                out[(i, p[0], rank, n[0], p[1], n[1])] += 1
    return out


def mined(spark, rows, is_anchor, **args):
    schema = "vec_id long, embedding array<float>, label int, row string, dim string, block int"
    table = spark.createDataFrame([(*r, "r", "d", 1) for r in rows], schema)
    got = hard_negatives.mine(table, is_anchor, **args).collect()
    return Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


def vectors(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] + rng.normal(size=dim) * rng.choice([0.1, 0.7, 2.0])
        out.append((i, [float(x) for x in np.float32(v / rng.choice([1.0, 3.0, 10.0]))], label))
    return out


def test_negatives_by_brute_force(spark):
    rows = vectors(700, 6, 1)
    rows += [(1000 + k, rows[k % 3][1], k % 3) for k in range(150)]  # one vector many times, over labels
    rows += [(7, rows[7][1], rows[7][2])] * 3 + [(100, rows[100][1], rows[100][2])] * 2  # repeated rows, an anchor among them
    rows += [(None, rows[5][1], 1), (2000, None, 1), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (2002, rows[3][1], None)]
    rows += [(2100, [float("nan")] * 6, 1), (2200, [float("inf")] + [0.0] * 5, 1), (2300, [0.0] * 6, 2), (2400, [1e30] * 6, 2), (2500, [], 1), (2600, [], 2)]
    rows += [(3000 + k, [0.3, -0.2], k % 2) for k in range(7)]  # shorter ones are compared among themselves
    got = mined(spark, rows, F.col("vec_id") % 50 == 0)
    want = expected_negatives(rows, lambda i: i is not None and i % 50 == 0)
    assert len(want) > 300 and got == want


def test_negatives_of_every_row_over_small_parts(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PART_BYTES", 400)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 200)
    rows = vectors(160, 3, 2, labels=3)
    got = mined(spark, rows, F.lit(True), positives=2, negatives=3, low=50, high=100)
    assert got == expected_negatives(rows, lambda i: True, 2, 3, 50, 100)


def test_negatives_of_empty_tables_and_without_anchors(spark):
    assert not mined(spark, [], F.lit(True))
    assert not mined(spark, vectors(20, 3, 2), F.lit(False))
    assert not mined(spark, [(1, [1.0], 1)], F.lit(True))


@pytest.mark.parametrize("seed", range(4))
def test_tree_bounds_hold_for_every_node(seed):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(900, 5)) * rng.choice([1, 30, 400], size=(900, 1))).astype(np.int32)
    x[:300] = x[0]
    tree = cover_tree.build(x, rng.integers(0, 99, 900))
    assert sorted(tree["order"]) == list(range(900)) and tree["starts"][-1] == 900
    norm = float(tree["norm"])
    unit = np.concatenate([x, np.sqrt(np.maximum(norm**2 - (x.astype(float) ** 2).sum(1), 0))[:, None]], axis=1) / norm
    at, below = len(tree["centre"]), [tree["order"][a:b] for a, b in zip(tree["starts"], tree["starts"][1:])]
    for size in tree["sizes"][::-1]:
        at -= size
        for k, members in enumerate(below):
            angle = np.arccos(np.clip(unit[members] @ unit[tree["centre"][at + k]], -1, 1))
            assert (angle <= tree["radius"][at + k]).all()
        parent, above = tree["parent"][at : at + size], {}
        for k, members in enumerate(below):
            above.setdefault(parent[k], []).append(members)
        below = [np.concatenate(above[k]) for k in sorted(above)]


def test_search_leaves_nodes_out(monkeypatch):
    """Nodes that can't reach a window aren't verified."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 8)) * 200
    x = (centres[np.arange(8000) % 40] + rng.normal(size=(8000, 8))).astype(np.int32)
    labels = np.arange(8000) % 40
    block = cover_tree.load(cover_tree.store(np.arange(8000), np.arange(8000), labels, x))
    verified = []
    enter = cover_tree._enter
    monkeypatch.setattr(cover_tree, "_enter", lambda q, i, scores, ids: (verified.append(len(scores)), enter(q, i, scores, ids)))
    q = cover_tree.Queries(x[:20], labels[:20], np.arange(20), np.full((20, 1), cover_tree.NO_SCORE + 1), np.full((20, 1), -cover_tree.NO_SCORE), 5)
    cover_tree.search(block, q, same_label=True)
    assert sum(verified) < 20 * 2000
    for i in range(20):
        score = x.astype(np.int64) @ x[i].astype(np.int64)
        mine = [j for j in np.lexsort((np.arange(8000), -score)) if j != i and labels[j] == labels[i]][:5]
        assert q.ids[i, 0].tolist() == mine


# --- main text -------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p><article>x</article>";</script></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- note <p>no</p> -->
<div class="cookie-notice">We use cookies on this site, quite a long notice that has as much text as any paragraph of the article has.</div>
<div class="ad">Buy now, a long advert with more words in it than the article itself has in its shortest paragraphs.</div>
<article><header><h1>Head &amp; line</h1><p>By someone</p></header><p>First   para
 with <b>bold<i> text</b> and &lt;tags&gt;.<br>Next line.<p>Second.</p>Loose text<ul><li>One<li>Two</ul>
<table><tr><td>a<td>b</table><form><p>Sign up</p><input></form><p class="share-links">Share this</p><p>Last &copy &#8364; end.</p>
<section id="comments"><p>Great article, a long comment by a reader who has a lot to say about all of it, and more.</p></section></article>
<aside><p>More stories for you, with long teasers that go on and on and on for a while.</p></aside>
<footer>&copy; someone</footer></body></html>"""


def test_page_with_all_kinds_of_boilerplate():
    assert extract(PAGE).split("\n") == [
        "Head & line", "First para with bold text and <tags>. Next line.", "Second.", "Loose text", "One", "Two", "a", "b", "Last © € end.",
    ]


def test_pages_without_an_article_take_the_clusters_of_text():
    para = "Words of the story that go on for a line or two, as they do in prose. " * 3
    links = "".join(f'<div><a href="/{i}">L{i}</a> <a href="/x">x</a> <a href="/y">y</a></div>' for i in range(30))
    page = f'<body><div>{links}</div><div id="story"><h2>Title</h2><div>{para}</div><div>{para}</div><p>Short.</p><div>{para}</div></div><div>{links}</div></body>'
    got = extract(page).split("\n")
    assert got.count(para.strip()) == 3 and not any(line.startswith("L") for line in got)
    assert extract(f"<main><p>{para}</p><p>Short.</p></main><div>{para}</div>").split("\n") == [para.strip(), "Short."]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("   \n", ""), ("plain words", "plain words"), ("<nav>only a menu</nav>", ""),
        ("<article></article>", ""), ("<article><p>a", "a"), ("<article><p>a</p></div></span></article>", "a"),
        ("<article><p>a &amp b &am &nbsp; c</p></article>", "a & b &am c"), ("<article><p>x<![foo</p></article>", "x"),
        ("<article>a<b>b</b>c<em> d</em></article>", "abc d"), ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
        ("<article><pre>a\n  b</pre><blockquote><p>q</p></blockquote></article>", "a b\nq"),
    ],
)
def test_small_and_broken_pages(page, want):
    assert extract(page) == want


def by_hand(html):
    """The given pages by regular expressions: headline and paragraphs of the one article."""
    import html as entities

    article = re.search(r"<article>(.*?)</article>", html, re.S)
    blocks = re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", article[1]))
    return "\n".join(t for t in (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks) if t)


def test_given_pages_by_hand(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: by_hand(r.html) for r in pages.collect()}
    got = main_text.main_text(pages).collect()
    assert len(got) == len(want)
    assert all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)


def test_pages_table_with_nulls_repeats_and_a_long_page(spark):
    long = "<article>" + "<p>Some words.</p>" * 60_000 + "</article>"
    rows = [(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (None, None, None, None, None), (2, None, "", "", 0), (3, "v", long, "t", 9)]
    got = main_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")).collect()
    assert got[0] == got[1] and got[0].text == extract(PAGE)
    assert (got[2].page_id, got[2].url, got[2].text, got[2].n_chars) == (None, None, "", 0)
    assert got[4].n_chars == 60_000 * len("Some words.\n") - 1
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert main_text.main_text(empty).collect() == []
