"""Each stage of the pipeline, and the whole, against brute force on a small
table with null and repeated ids, repeated rows, empty texts and extra columns
whose names clash with the operators' own."""

import hashlib
import math
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_operators import NAMES, WORD, shingle_set
from tidemark.llm import ngram_join, quality
from tidemark.llm.common import row_key

COLUMNS = ["doc_id", "text", "source", "rk", "label", "hash", "size", "times", "n", "component"]
SCHEMA = "doc_id long, text string, source string, rk long, label string, hash string, size int, times int, n long, component string"


def random_text(rnd, n):
    return " ".join(rnd.choice(NAMES) for _ in range(n))


def passage_replaced(rnd, text, n):
    words = text.split()
    at = rnd.randint(0, len(words) - n)
    return " ".join(words[:at] + [f"new{rnd.random()}" for _ in range(n)] + words[at + n :])


def documents():
    """(id, text, source); about a third of the ids are null, some are repeated."""
    rnd = random.Random(9)
    out = [(None, None, "a"), (None, "", "a"), (1, " \n", "b"), (1, " \n", "b"), (None, "short text", "c"), (None, "short text", "c")]
    for i in range(8):
        text = random_text(rnd, 100 + 50 * i)
        group = [text] + [passage_replaced(rnd, text, max(1, len(text.split()) * k // 100)) for k in (2, 5, 9, 10, 13)]
        out += [(None if k % 3 == i % 3 else 100 - 10 * i + k, t, "abc"[k % 3]) for k, t in enumerate(group)]
    out += [(None, random_text(rnd, 60), rnd.choice(["a", "b", None])) for _ in range(12)]
    out += [(500, random_text(rnd, 60), rnd.choice("ab")) for _ in range(5)]
    out += [out[8], out[-1], out[-8]]
    rnd.shuffle(out)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", "y", 3, 2, None, "z") for r in rows], SCHEMA)


def rows_of(df):
    assert df.columns == COLUMNS
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def keys(spark, rows):
    got = frame(spark, rows).select("doc_id", "text", row_key().alias("k")).collect()
    return {(r.doc_id, r.text): r.k for r in got}


def groups(rows, width=5, percent=80):
    """Lists of linked (id, text)."""
    worded = list({r[:2]: None for r in rows if WORD.search(r[1] or "")})
    sets, label = [shingle_set(t, width) for _, t in worded], list(range(len(worded)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= percent * len(a | sets[j]) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    return [[w for w, x in zip(worded, label) if x == k] for k in sorted(set(label))]


def without_near(spark, rows):
    key = keys(spark, rows)
    first = {min(g, key=lambda w: (w[0] is None, w[0] or 0, key[w])) for g in groups(rows)}
    wordless = [r for r in rows if not WORD.search(r[1] or "")]
    return Counter(wordless) + Counter({r for r in rows if r[:2] in first})


def test_near_copies_of_the_stage_are_five_words_and_80_percent(spark):
    rnd = random.Random(4)
    rows, between = [], 0
    for i in range(12):
        text = random_text(rnd, 300 + 20 * i)
        other = passage_replaced(rnd, text, len(text.split()) * 9 // 100)
        rows += [(2 * i, text, "a"), (2 * i + 1, other, "a")]
        near = lambda w: len(shingle_set(text, w) & shingle_set(other, w)) / len(shingle_set(text, w) | shingle_set(other, w))
        between += near(5) >= 0.8 and near(4) < 0.85
    assert between == 12
    got = rows_of(corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), ""))
    assert got == without_near(spark, rows) == Counter(rows[::2])


def test_keys_meet_at_80_percent():
    rng = np.random.default_rng(2)
    for n in [1, 2, 4, 5, 6, 9, 10, 14, 20, 33, 60, 150, 400]:
        for _ in range(20):
            a = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
            fresh = rng.integers(1, 2**63, int(rng.integers(0, 0.22 * n + 1)), dtype=np.uint64)
            b = np.unique(np.concatenate([a[: len(a) - int(rng.integers(0, 0.22 * n + 1))], fresh]))
            common = len(np.intersect1d(a, b))
            if 100 * common < 80 * (len(a) + len(b) - common):
                continue
            sizes = np.array([len(a), len(b)])
            who, found = ngram_join.keys_of(np.repeat([0, 1], sizes), np.concatenate([a, b]), sizes, 80)
            assert set(found[who == 0]) & set(found[who == 1])


def test_unlinked_documents_with_null_or_equal_ids_all_stay(spark):
    rnd = random.Random(6)
    rows = [(d, random_text(rnd, 50), "a") for d in (None, None, None, None, 7, 7, 7, 8)]
    got = rows_of(corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), ""))
    assert got == Counter(rows)
    found = ngram_join.similar_components(frame(spark, [*rows, rows[0]])).collect()
    assert len({r.component for r in found}) == len(rows) and all(r.component is not None for r in found)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    rows = documents()
    got = rows_of(corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), ""))
    assert got == without_near(spark, rows)
    assert sum(got.values()) < len(rows) - 20 and sum(d is None for d, *_ in got.elements()) > 15


def scored(spark, rows, labels):
    key = keys(spark, rows)
    good = {r.rk for r in quality.score(frame(spark, rows), labels).where("predicted = 1").collect()}
    return [r for r in rows if key[r[:2]] in good]


def contaminated(text, items):
    for q in items:
        n = len(WORD.findall(q or ""))
        a = shingle_set(q, 5)
        b = shingle_set(text, 5) | (shingle_set(text, n) if 0 < n < 5 else set())
        if a and len(a & b) >= 0.8 * len(a):
            return True
    return False


def mixed(rows):
    """Every row as often as the mix takes it, by sorting."""
    words = lambda t: len(WORD.findall(t or ""))
    size = Counter()
    for _, t, s in rows:
        size[s] += words(t)
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted({r[2] for r in rows}, key=lambda s: (s is None, s or "")))}
    capped = set()
    while True:
        free = [s for s in weight if s not in capped]
        level = (sum(size.values()) - sum(3 * size[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if 3 * size[s] < weight[s] * level}
        if not more:
            break
        capped |= more
    out = Counter()
    for s in weight:
        if not size[s]:
            continue
        target = 3.0 * size[s] if s in capped else min(3.0 * size[s], weight[s] * level)
        times = math.floor(target / size[s])
        budget, below, by_hash = target - times * size[s], 0, {}
        for r in rows:
            if r[2] == s and words(r[1]):
                name = f"{'' if r[0] is None else r[0]}:{r[1]}"
                by_hash.setdefault(int(hashlib.md5(name.encode()).hexdigest()[:15], 16), []).append(r)
        for h in sorted(by_hash):
            n = sum(words(r[1]) for r in by_hash[h])
            more = below + n <= budget or (below <= budget and below + n - budget <= budget - below)
            below += n
            out.update({r: c * (times + more) for r, c in Counter(by_hash[h]).items()})
    return +out


def digests(spark, rows):
    """(id, start, tokens, checksum), in order of id and row key."""
    from tokenizers import Tokenizer

    whole, key, at, out = Tokenizer.from_file(corpus_pipeline.tokenizer_path()), keys(spark, rows), 0, []
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, key[r[:2]])):
        ids = [*whole.encode(r[1] or "", add_special_tokens=False).ids, 2]
        out.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def found_digests(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents (junk among them), benchmark and labels as files."""
    folder = tmp_path_factory.mktemp("tables")
    rnd, rows = random.Random(3), documents()
    junk = [(None if i % 3 == 0 else 1000 + i, "$$$ #### 111 &&& " * (10 + i), "abc"[i % 3]) for i in range(40)]
    rows += junk
    items = [rows[20][1], random_text(rnd, 20), None, "", " ".join(next(r[1] for r in rows if r[0] == 500).split()[20:23])]
    labels = [(r[0], int(r not in junk), 0) for r in rows if r[0] is not None and r[1] and r[1].strip()] + [(None, 1, 0), (1001, None, 0)]
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return SimpleNamespace(folder=str(folder), rows=rows, junk=junk, items=items, labels=spark.read.parquet(f"{folder}/labels.parquet"))


def test_keep_good(spark, tables):
    got = rows_of(corpus_pipeline.keep_good(spark, frame(spark, tables.rows), tables.folder))
    assert got == Counter(scored(spark, tables.rows, tables.labels))
    assert not set(got) & set(tables.junk) and {r for r in tables.rows if len(r[1] or "") > 200} - set(tables.junk) <= set(got)


def test_drop_contaminated(spark, tables):
    got = rows_of(corpus_pipeline.drop_contaminated(spark, frame(spark, tables.rows), tables.folder))
    assert got == Counter(r for r in tables.rows if not contaminated(r[1], tables.items))
    assert sum(got.values()) < len(tables.rows) - 2


def test_mix_sources(spark, tables):
    got = rows_of(corpus_pipeline.mix_sources(spark, frame(spark, tables.rows), tables.folder))
    assert got == mixed(tables.rows)
    assert len(set(got.values())) > 1


def test_write_token_files(spark, tables):
    pytest.importorskip("public_tokenizers")
    got = found_digests(corpus_pipeline.write_token_files(spark, frame(spark, tables.rows), tables.folder))
    assert got == digests(spark, tables.rows)


def test_run(spark, tables):
    pytest.importorskip("public_tokenizers")
    rows = list(without_near(spark, scored(spark, tables.rows, tables.labels)).elements())
    rows = list(mixed([r for r in rows if not contaminated(r[1], tables.items)]).elements())
    assert any(r[0] is None for r in rows) and any(r[0] == 500 for r in rows)
    assert found_digests(corpus_pipeline.run(spark, tables.folder)) == digests(spark, rows)
