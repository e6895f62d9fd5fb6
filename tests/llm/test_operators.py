"""The operators against brute force on small made-up tables, and edge cases:
nulls in any column, empty and long texts, ties, repeated rows, empty tables,
extra columns with clashing names."""

import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, fingerprints, mixing, ngram_join, quality, queries, revisits, secrets, suffix_dedup, token_counts, token_files

SCHEMA = "doc_id long, text string, source string, lang string, rk long, h long, size int, x string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = [f"w{i}" for i in range(300)]


def table(spark, texts, sources=None):
    rows = [(i, t, (sources or ["a"] * len(texts))[i], None, 7, None, 3, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice(NAMES) for _ in range(n))
    base = [text(rnd.randint(30, 200)) for _ in range(12)]
    out = [None, "", " \n", "one", "one", "two words", base[0], base[0], text(5000)]
    for b in base:
        words = b.split()
        for _ in range(6):
            w = list(words)
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(NAMES)
            out.append(" ".join(w))
    out += [text(50) + " " + base[1] + " " + text(50), "é" * 500, "ab" * 600, "ab" * 600 + "c"]
    return out


def test_repeats_are_cut_as_by_brute_force(spark, corpus):
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(table(spark, corpus)).collect()}
    raw = [(t or "").encode() for t in corpus]
    seen = {}
    for b in raw:
        for i in range(len(b) - 399):
            seen[b[i : i + 400]] = seen.get(b[i : i + 400], 0) + 1
    for k, b in enumerate(raw):
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        assert [(s.start, s.end) for s in got[k].spans] == spans
        assert bytes(got[k].kept) == bytes(c for c, g in zip(b, gone) if not g)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_planted_passages_by_query(spark, tmp):
    """Passages of over 50 words in two documents each: of 400 bytes they go, of
    399 they stay. ``n_bytes`` is the length before, whatever is removed."""
    rnd = random.Random(11)
    text = lambda n: " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(4, 7))) for _ in range(n))
    docs = [text(300), "", None]
    kept = [t or "" for t in docs]
    for n in (399, 400, 401, 900):
        passage = "".join(rnd.choice("abcd ") for _ in range(n))
        assert len(passage.split()) > 50
        for before, after in ("<>", "[]"):
            head, tail = text(rnd.randint(0, 90)) + before, after + text(rnd.randint(0, 90))
            docs.append(head + passage + tail)
            kept.append(head + tail if n >= 400 else docs[-1])
    table(spark, docs).write.parquet(f"{tmp}/documents.parquet")
    got = queries.op1_suffix_dedup(spark, tmp)
    assert got.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    size = lambda t: len((t or "").encode())
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()} == {
        i: (size(t), size(t) - size(k), int(size(t) > size(k)), hashlib.sha256(k.encode()).hexdigest()) for i, (t, k) in enumerate(zip(docs, kept))
    }


def shingle_set(text, width):
    w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in WORD.findall(text or "")]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def test_similar_components_lose_no_link(spark, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_components(table(spark, corpus)).collect()}
    sets = [shingle_set(t, 4) for t in corpus]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]) and label[i] != label[j]:
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    assert got == {i: (len(s), label[i]) for i, s in enumerate(sets)}
    assert len(set(label)) < len(label) - 20
    assert ngram_join.similar_components(empty(spark)).count() == 0


def test_keys_meet_for_every_similar_pair():
    """Pigeonhole: any two sets at the threshold share a key, however sparse."""
    rng = np.random.default_rng(1)
    for n in [1, 2, 3, 5, 6, 7, 8, 12, 13, 14, 20, 33, 60, 150, 400]:
        for _ in range(20):
            a = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
            drop = int(rng.integers(0, 0.16 * n + 1))
            b = a[: len(a) - drop]
            fresh = rng.integers(1, 2**63, int(rng.integers(0, 0.16 * n + 1)), dtype=np.uint64)
            b = np.unique(np.concatenate([b, fresh]))
            common = len(np.intersect1d(a, b))
            if 100 * common < 85 * (len(a) + len(b) - common):
                continue
            sizes = np.array([len(a), len(b)])
            who, keys = ngram_join.keys_of(np.repeat([0, 1], sizes), np.concatenate([a, b]), sizes, 85)
            assert set(keys[who == 0]) & set(keys[who == 1])


@pytest.mark.parametrize("percent", [80, 85])
def test_sets_without_their_most_frequent_subsets_still_meet(percent):
    """Whatever the counts: both leave out the first keys of one common order."""
    rng, left_out = np.random.default_rng(6), 0
    for n in [7, 13, 20, 40, 90, 150, 400]:
        for _ in range(40):
            change = int(rng.integers(0, n * (100 - percent) // 100 + 1))
            a = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[change // 2 :], rng.integers(1, 2**63, change - change // 2, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 100 * common < percent * (len(a) + len(b) - common):
                continue
            sizes = np.array([len(a), len(b)])
            who, keys, band, spare = ngram_join.banded_keys(np.repeat([0, 1], sizes), np.concatenate([a, b]), sizes, percent)
            uses = {k: int(rng.integers(1, 4)) for k in keys.tolist()}
            kept = [set(), set()]
            for own in (0, 1):
                for up in set(band[who == own].tolist()):
                    here = (who == own) & (band == up)
                    order = sorted(set(keys[here].tolist()), key=lambda k: (-uses[k], k))
                    rest = int(spare[here].max())
                    left_out += rest
                    kept[own] |= set(order[rest:])
            assert kept[0] & kept[1]
    assert left_out > 500


def test_the_most_frequent_subsets_stay_out_of_the_index(spark):
    """Texts that share a passage: their common keys cost the most, so those go."""
    rnd = random.Random(12)
    text = lambda n: " ".join(rnd.choice(NAMES) for _ in range(n))
    passage = text(60)
    texts = [text(120) + " " + passage + " " + text(120) for _ in range(60)]
    texts += [t.replace(" w7 ", " w8 ", 1) for t in texts[:20]]
    docs = table(spark, texts)
    listed = ngram_join.keyed(docs).select("rk", "text").mapInArrow(ngram_join._keys(4, 85), ngram_join._KEY_ROW)
    every = {(r.sid, r.key) for r in listed.collect()}
    uses = {}
    for _, k in every:
        uses[k] = uses.get(k, 0) + 1
    kept = {(r.sid, r.key) for r in ngram_join._allocated(listed).collect()}
    assert kept <= every
    pairs = lambda rows: sum(n * (n - 1) for n in _counts(rows).values())
    assert pairs(kept) < pairs({x for x in every if uses[x[1]] > 1})
    got = {r.doc_id: r.component_id for r in ngram_join.similar_components(docs).collect()}
    assert got == {i: i - 60 if i >= 60 else i for i in range(80)}


def test_no_written_step_shuffles_the_keys_twice(spark, corpus, monkeypatch):
    """The shuffle files of a step lie on disk until it is written."""
    steps, write = [], ngram_join.materialize

    def record(df, name):
        steps.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")))
        return write(df, name)

    monkeypatch.setattr(ngram_join, "materialize", record)
    ngram_join.similar_components(table(spark, corpus))
    listings = dict(steps)
    assert listings["ngram-uses"] == listings["ngram-kept"] == 1
    assert max(listings.values()) == 1


def test_groups_in_blocks_of_few_elements(spark, corpus, monkeypatch):
    want = {(r.doc_id, r.component_id) for r in ngram_join.similar_components(table(spark, corpus)).collect()}
    monkeypatch.setattr(ngram_join, "BLOCK_ELEMENTS", 200)
    assert {(r.doc_id, r.component_id) for r in ngram_join.similar_components(table(spark, corpus)).collect()} == want


def _counts(rows):
    out = {}
    for _, k in rows:
        out[k] = out.get(k, 0) + 1
    return out


def test_mix_comes_near_its_targets(spark, corpus):
    sources = [(None, "a", "b", "c", "a")[i % 5] for i in range(len(corpus))]
    rows = mixing.mix(table(spark, corpus, sources)).collect()
    assert len(rows) == len(corpus)
    sizes = {r.doc_id: len(WORD.findall(corpus[r.doc_id] or "")) for r in rows}
    assert all(r.size == sizes[r.doc_id] and 0 <= r.times <= 3 for r in rows)
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        taken, largest = sum(r.size * r.times for r in own), max(r.size for r in own)
        assert abs(taken - own[0].target) <= largest
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(sum(sizes.values()))
    assert mixing.mix(empty(spark)).count() == 0


def test_targets_stop_at_three_times_a_source(spark):
    df = spark.createDataFrame([("a", 10, 1), ("b", 100, 2), ("c", 1000, 3)], "source string, size long, hash long")
    got = {r.source: r.target for r in mixing.source_targets(df, (5, 2, 1), 3).collect()}
    assert got == {"a": 30.0, "b": 300.0, "c": 780.0}


def test_fingerprints_and_their_estimates(spark, corpus):
    rows = {r.doc_id: r for r in fingerprints.edited_fingerprints(table(spark, corpus)).withColumn("near", fingerprints.resemblance("sketch", "next_sketch")).collect()}
    for i, t in enumerate(corpus):
        a, b = t or "", corpus[(i + 1) % len(corpus)] or ""
        k = len(a) // 4
        assert rows[i].edited == a[: len(a) - k] + b[:k]
        x, y = shingle_set(a, 5), shingle_set(b, 5)
        true = len(x & y) / len(x | y) if x | y else 1.0
        assert rows[i].near == pytest.approx(true, abs=0.16)
    assert rows[6].sketch == rows[7].sketch
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0
    parts = spark.createDataFrame([("g", [5, 1, 3]), ("g", [2, 3]), ("h", [])], "g string, s array<long>")
    assert {r.g: r.s for r in fingerprints.merge_by(parts, ["g"], "s", 3).collect()} == {"g": [1, 2, 3]}


def test_repeated_rows_count_as_one_document(spark):
    df = table(spark, ["a b c d e f g", "h i j k l m"]).select("doc_id", "text")
    once = sorted(fingerprints.edited_fingerprints(df).collect())
    assert sorted(fingerprints.edited_fingerprints(df.union(df)).collect()) == sorted(once + once)


def test_contained_items_are_found_in_long_documents(spark, corpus):
    items = [corpus[6], " ".join(corpus[8].split()[1000:1012]), "two words", None, "", "nowhere to be found at all today"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    want = {
        (d, i) for d, t in enumerate(corpus) for i, q in enumerate(items)
        if shingle_set(q, 5) and len(shingle_set(q, 5) & shingle_set(t, 5)) >= 0.8 * len(shingle_set(q, 5))
    }
    docs = table(spark, corpus)
    found = {(r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, bench).collect()}
    assert found == want and (8, 1) in want
    clean = {r.doc_id for r in decontaminate.without_contaminated(docs, bench).collect()}
    assert clean == set(range(len(corpus))) - {d for d, _ in want}
    shuffled = decontaminate.BROADCAST_SHINGLES
    try:
        decontaminate.BROADCAST_SHINGLES = -1
        assert {(r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, bench).collect()} == want
    finally:
        decontaminate.BROADCAST_SHINGLES = shuffled
    assert decontaminate.contained_items(docs, bench.limit(0)).count() == 0
    assert decontaminate.contained_items(empty(spark), bench).count() == 0


def test_short_items_are_found_inside_long_documents(spark, corpus):
    words = corpus[8].split()
    items = ["two words", " ".join(words[700:703]).upper(), words[0], "nowhere", "", None, " ".join(words[10:30]), "one"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    texts = corpus + ["here are two  Words in a long enough text", "two other words in a long enough text", "some two words", "twowords"]

    def has(item, text):
        n = len(WORD.findall(item or ""))
        a = shingle_set(item, 5)
        b = shingle_set(text, 5) | (shingle_set(text, n) if 0 < n < 5 else set())
        return bool(a) and len(a & b) >= 0.8 * len(a)

    want = {(d, i) for d, t in enumerate(texts) for i, q in enumerate(items) if has(q, t)}
    n = len(corpus)
    assert {(n, 0), (n + 2, 0), (8, 1), (8, 2), (8, 6), (3, 7), (5, 0)} <= want and not {(n + 1, 0), (n + 3, 0)} & want
    docs, shuffled = table(spark, texts), decontaminate.BROADCAST_SHINGLES
    try:
        for most in (shuffled, -1):
            decontaminate.BROADCAST_SHINGLES = most
            assert {(r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, bench, short_items=True).collect()} == want
    finally:
        decontaminate.BROADCAST_SHINGLES = shuffled
    clean = decontaminate.without_contaminated(docs, bench, short_items=True)
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_secrets_base_spans_and_ownership(spark):
    key = "AKIA" + "Z9" * 8
    texts = ['x Token = "abcdef12" é password: abc secret=token=q', key, "f" * 24 + "g", None, "", "A1b2C3d4E5f6G7h8I9j0K1" + " é", "Zz1" * 9, "Zz1" * 9]
    df = table(spark, texts, ["a", "a", "a", "a", "b", "b", "a", "b"])
    got = {r.doc_id: r for r in secrets.scan(df, F.col("source"), F.col("source")).collect()}
    assert got[0].base_joined == "assign:2:19,assign:37:51"
    assert got[1].base_joined == "access:0:20" and got[2].base_joined == "hex:0:24"
    assert got[3].joined == got[4].joined == ""
    assert got[5].joined == "owned:0:22"  # one owner
    assert got[6].joined == got[7].joined == ""  # two owners have it
    assert secrets.scan(empty(spark), F.col("source"), F.col("source")).count() == 0


def test_a_key_in_many_repositories_of_one_owner_is_copied(spark):
    many, few, base = "Qq1" * 9, "Zz2" * 9, "f0" * 13
    rows = [(i, f"{many} {base}", "hot", f"l{i % 4}") for i in range(40)] + [(100 + i, few, "hot", f"l{i % 2}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in secrets.scan(df, F.concat_ws("/", "source", "lang"), F.col("source")).collect()}
    for i in range(40):
        assert got[i].joined == got[i].base_joined == "hex:28:54"
        assert [(s.owners, s.repositories, s.live) for s in got[i].base] == [(1, 4, False)]
    assert all(got[100 + i].joined == "owned:0:27" for i in range(6))


def test_quality_learns_and_ignores_held_out_labels(spark):
    texts = [("good words make calm sentences here " * 8) if i % 2 else ("$$$ #### 111 &&& " * 20) for i in range(300)] + [None, ""]
    docs = table(spark, texts)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    labels = spark.createDataFrame([(i, (i % 2) ^ held(i), 0) for i in range(300)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert all(rows[i].held_out == held(i) for i in rows)
    assert all(rows[i].predicted == i % 2 for i in range(300))  # held-out labels are the wrong way round here
    assert 0 <= rows[300].score <= 1 and rows[300].score == rows[301].score
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(empty(spark), labels).count() == 0


def test_trees_walk_like_their_nodes():
    t = quality.Trees(0.0, np.array([[0, 1, 1]]), np.array([[0.5, 1.0, 2.0]]), np.array([[1.0, 2.0, 3.0, 4.0]]))
    x = np.array([[0, 0], [0, 5], [1, 0], [1, 5]], float)
    assert np.allclose(t.score(x), 1 / (1 + np.exp(-np.array([1.0, 2.0, 3.0, 4.0]))))


def test_token_files_round_trip(spark, corpus, tmp):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    texts = corpus + ["It's <|endoftext|> fine, Été; don't! A.B,c  x\tq\r\n1234"]
    folder = f"file://{tmp}/tokens"
    manifest = token_files.write_tokens(table(spark, texts), folder, path)
    got = {r.doc_id: r for r in token_files.read_digests(manifest, folder).collect()}
    whole, at = Tokenizer.from_file(path), 0
    for i, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    none = token_files.write_tokens(empty(spark), f"{folder}-none", path)
    assert token_files.read_digests(none, f"{folder}-none").count() == 0


def test_frames_are_independent_and_checked():
    sink = io.BytesIO()
    w = token_files.FrameWriter(sink, 2, frame_ids=10)
    docs = [np.arange(n, dtype=np.uint32) for n in (3, 4, 30, 0, 5)]
    for i, d in enumerate(docs):
        w.add(d, i)
    w.finish()
    data = bytearray(sink.getvalue())
    r = token_files.FrameReader(io.BytesIO(bytes(data)))
    for i in (4, 2, 0, 3, 1):
        assert r.document(i).tolist() == docs[i].tolist()
    data[r.entries[0][0] + 5] ^= 1
    broken = token_files.FrameReader(io.BytesIO(bytes(data)))
    assert broken.document(2).tolist() == docs[2].tolist()
    with pytest.raises(ValueError, match="damaged"):
        broken.document(0)


def test_counts_follow_edits(spark):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.tiktoken")
    counter, rnd = token_counts.Counter(path, public.PATTERN), random.Random(3)
    letters = ["a", "b", " ", "  ", "\n", "'", "s", "ll", "9", "1", "!", "é", "\t"]
    for k in range(600):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 400 if k % 10 == 0 else 30)))
        tree = token_counts.TokenTree(counter, text)
        for _ in range(3):
            a = rnd.randint(0, len(text))
            b = min(len(text), a + rnd.choice([0, 1, 2, 5, 100]))
            new = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 4)))
            text = text[:a] + new + text[b:]
            tree.edit(a, b, new)
            assert tree.text() == text and tree.total == len(counter.encoding.encode_ordinary(text))
    docs = table(spark, ["call 5551234 now", None, "", "x" * 50_000])
    edits = token_counts.redactions("t", "[0-9]{4,}", "[X]")
    rows = {r.doc_id: r for r in token_counts.edited_counts(docs.withColumn("t", F.coalesce("text", F.lit(""))), edits, path, public.PATTERN).collect()}
    assert rows[0].edited == "call [X] now" and rows[0].n_edits == 1
    assert rows[0].n_tokens_edited == len(counter.encoding.encode_ordinary("call [X] now"))
    assert rows[1].n_tokens == rows[2].n_tokens == 0
    assert token_counts.edited_counts(docs.limit(0), F.lit(None).cast("array<struct<start:int,end:int,replacement:string>>"), path, public.PATTERN).count() == 0


def test_trees_are_kept_and_a_later_edit_encodes_its_region_only(spark, monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.tiktoken")
    counter, rnd = token_counts.Counter(path, public.PATTERN), random.Random(8)
    encode = lambda t: len(counter.encoding.encode_ordinary(t))
    text = " ".join(rnd.choice(NAMES) + rnd.choice(["", "  ", "\n", "'s", "9"]) for _ in range(20_000))
    stored = token_counts.TokenTree(counter, text).leaf_sums()
    for k in range(6):
        fresh = token_counts.Counter(path, public.PATTERN)
        asked = []
        monkeypatch.setattr(fresh, "counts", lambda pieces, c=fresh: asked.extend(pieces) or token_counts.Counter.counts(c, pieces))
        tree = token_counts.TokenTree(fresh, text, stored)
        assert not asked and tree.leaves.count(None) == len(tree.leaves)
        edits = [(1_000 * k, 1_000 * k + 7, "new words"), (40_000, 40_000 + 3 * k, "")] if k < 5 else [(500, 60_000, "x " * 3_000)]
        for a, b, new in sorted(edits, reverse=True):
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
        if k < 5:
            assert len(asked) < 4 * token_counts.LEAF and tree.leaves.count(None) >= len(tree.leaves) - 6
        stored = tree.leaf_sums()
        assert tree.text() == text and tree.total == sum(stored[1]) == encode(text)
        assert sum(stored[0]) == len(text)
    with pytest.raises(ValueError, match="stored tree"):
        token_counts.TokenTree(counter, text + "x", stored)
    # as tables: two rounds of edits, the second one on the written trees of the first
    texts = ["call 5551234 now, or 99887766", None, "", "call 5551234 now, or 99887766", "x" * 3_000 + " 4321 " + "y z " * 2_000]
    docs = table(spark, texts)
    schema = token_counts.build_trees(docs, path, public.PATTERN).schema
    trees = spark.createDataFrame(token_counts.build_trees(docs, path, public.PATTERN).collect(), schema)
    for pattern, new in [("[0-9]{4,}", "[X]"), ("call|y", "é  é")]:
        rows = token_counts.edit_trees(trees, token_counts.redactions("text", pattern, new), path, public.PATTERN).collect()
        texts = [re.sub(pattern, new, t or "") for t in texts]
        got = {r.doc_id: r for r in rows}
        before = {r.doc_id: sum(r.leaf_tokens) for r in trees.collect()}
        for i, t in enumerate(texts):
            assert (got[i].text, got[i].n_tokens, got[i].n_tokens_edited) == (t, before[i], encode(t))
            assert sum(got[i].leaf_tokens) == encode(t) and sum(got[i].leaf_chars) == len(t)
        trees = spark.createDataFrame([(r.doc_id, r.text, r.leaf_chars, r.leaf_tokens) for r in rows], schema)
    assert token_counts.build_trees(empty(spark), path, public.PATTERN).count() == 0


def test_revisits_resolve_to_the_latest_earlier_response(spark):
    rnd = random.Random(2)
    hour = revisits.BLOCK
    urls = ["http://A.com/x?b=2&a=1#f", "http://a.com:80/x?a=1&b=2", "https://a.com/x", None]
    rows = []
    for i in range(200):
        status = rnd.choice([200, 304, 404])
        tag = rnd.choice(['"1"', 'W/"1"', '"2"', None])
        at = rnd.choice([None, *range(0, 5 * hour, hour // 3)])
        headers = {"ETag": tag, "Content-Type": str(i), "Date": str(i)} if tag else {"Content-Type": str(i)}
        rows.append((i, rnd.choice(urls), at, status, headers if i % 9 else None, f"d{i}", i))
    df = spark.createDataFrame(rows, "record_id long, url string, at long, status int, headers map<string,string>, digest string, length long")
    got = {r.record_id: r for r in revisits.resolve(df).collect()}
    same = lambda u: None if u is None else ("https" if u.startswith("https") else "http")
    assert set(got) == {r[0] for r in rows if r[3] == 304}
    for i, url, at, status, headers, *_ in rows:
        if status != 304:
            continue
        earlier = [r for r in rows if r[3] == 200 and url and at is not None and r[2] is not None and same(r[1]) == same(url) and r[2] < at]
        best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        assert got[i].response_id == (best[0] if best else None)
        if not best:
            assert got[i].outcome == "no_response"
            continue
        tag, stored = (headers or {}).get("ETag"), (best[4] or {}).get("ETag")
        strip = lambda t: t and t.removeprefix("W/")
        want = "unvalidated" if tag is None else "resolved" if strip(tag) == strip(stored) else "mismatch"
        assert got[i].outcome == want
        if want == "resolved":
            assert got[i].digest == best[5] and got[i].headers["content-type"] == best[4]["Content-Type"] and got[i].headers["date"] == headers["Date"]
    assert revisits.resolve(df.limit(0)).count() == 0


def test_hashes_of_texts_are_sha256(spark):
    row = fingerprints.edited_fingerprints(table(spark, ["abcdefgh"])).select(F.sha2("edited", 256).alias("s")).first()
    assert row.s == hashlib.sha256(b"abcdefab").hexdigest()


def test_encoder_gives_the_ids_of_whole_texts():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    whole, rnd = Tokenizer.from_file(path), random.Random(5)
    parts = ["don't", "''s", "É", "é", "H̱", "İ", "ß", "Σ", "ſ", "K", "12a", "\t", "\r", "\x1c", "\x85", " ", " ", " ", "\n", "日本", "😀", "<|endoftext|>", "<|EndOfText|>", "_", "...", "'LL", "ª", "²", "a", "Zz", "\x00", "é,", "#%"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(3000)] + ["", " ", "a" * 5000, "é" * 3000]
    texts += ["it's we'll 12, ''re don't'VE " * 40, " ", "x", "", "y's"]
    encoder = token_files.Encoder(path, most=500)
    encoder._SECTION = 150
    for a in range(0, len(texts), 100):
        for text, ids in zip(texts[a : a + 100], encoder(texts[a : a + 100])):
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_starts_are_sums_over_all_files_before(spark):
    rnd = random.Random(7)
    sizes = {p: rnd.randint(0, 9) for p in rnd.sample(range(3000), 400)}
    manifest = spark.createDataFrame([(p, n) for p, n in sizes.items()], "part int, n_ids long")
    for r in token_files.with_starts(manifest).collect():
        assert r.start == sum(n for p, n in sizes.items() if p < r.part)
