"""What a Python worker holds at once is bounded by a range of texts, a slice or a
cell, and not by all that a batch or a partition has."""

import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from tidemark.llm import decontaminate, importance, ngram_join, suffix_dedup
from tidemark.llm.words import each_buffer
from tidemark.operators import control, windows


def peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_texts_of_a_batch_become_objects_range_by_range():
    text = [("é" + str(i) * 4000)[:4000] for i in range(10_000)]
    rk = np.arange(len(text))
    batch = pa.RecordBatch.from_pydict({"rk": rk, "doc_id": rk, "text": text, "runs": pa.array([None] * len(text), pa.list_(pa.int64()))})
    assert b"".join(t for _, texts in each_buffer([batch]) for t in texts) == "".join(text).encode()
    for parts in (each_buffer, suffix_dedup._cut(400)):
        assert peak(lambda: [None for _ in parts([batch])]) < 15_000_000  # all of them are 40 MB, and as many again in UTF-8


def test_slices_are_compared_without_holding_the_partition(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "AT_ONCE", 500, raising=False)
    rnd = random.Random(4)
    rows = sorted((s, rnd.randint(0, 99), 1000 * i, rnd.random() < 0.2, [s << 20 | rnd.randint(0, 40) for _ in range(rnd.randint(1, 8))]) for i, s in enumerate(rnd.randint(0, 150) for _ in range(2000)))
    rows += [(200 + i // 90, i, 0, False, [200 + i // 90]) for i in range(180)]  # slices that go over several batches
    taken = []

    def batches():
        for a in range(0, len(rows), 40):
            taken.append(a)
            s, rk, lo, whole, ids = zip(*rows[a : a + 40])
            yield pa.RecordBatch.from_arrays(
                [pa.array(s), pa.array(rk), pa.array(lo), pa.array(whole), pa.array([np.array(x, np.uint64).tobytes() for x in ids], pa.binary())],
                names=["slice", "rk", "lo", "whole", "ids"],
            )

    got, first = set(), None
    for out in suffix_dedup._repeated(batches()):
        first = first or len(taken)
        got |= {(r["rk"], r["lo"] + k) for r in out.to_pylist() for k in range(r["n"])}
    uses = {}
    for *_, ids in rows:
        for x in ids:
            uses[x] = uses.get(x, 0) + 1
    assert got == {(rk, lo + k) for _, rk, lo, whole, ids in rows for k, x in enumerate(ids) if uses[x] > 1 and not whole}
    assert first < len(rows) / 40 / 2


def cells(rows):
    kinds = {"key": pa.int64(), "cell": pa.int64(), "sid": pa.int64(), "salt": pa.int64(), "label": pa.int64(), "n": pa.int64(), "digest": pa.binary()}
    for a in range(0, len(rows), 700):
        columns = zip(*rows[a : a + 700])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))


def test_pairs_of_a_large_cell_are_handed_on_in_parts():
    rows = [(1, 0, i - 700, 0, i, 20, bytes(16)) for i in range(1000)]
    out = []

    def run():
        for batch in ngram_join._cell_pairs(85, False)(cells(rows)):
            out.append(batch.num_rows)
            assert all(a < b for a, b in batch.slice(0, 50).to_pandas().to_numpy())

    assert peak(run) < 15_000_000  # as tuples they took 82 MB for 1500 sets
    assert sum(out) == 1000 * 999 // 2


def test_pairs_of_cells_by_brute_force():
    rnd = random.Random(6)
    digests = [rnd.randbytes(16) for _ in range(3)]
    rows = sorted((k, 0, rnd.randint(-(10**9), 10**9), rnd.randint(0, 1), rnd.randint(0, 9), 20, rnd.choice(digests)) for k in range(60) for _ in range(rnd.randint(1, 40)))
    pairs = lambda way: [p for b in ngram_join._cell_pairs(85, way)(cells(rows)) for p in zip(*b.to_pydict().values())]
    want = set()
    for k in range(60):
        cell = [r for r in rows if r[0] == k]
        blocks = {r[3] for r in cell}
        for x, y in itertools.combinations(cell, 2):
            if x[4] != y[4] and x[6] == y[6] and (len(blocks) == 1 or x[3] != y[3]):
                want.add((min(x[2], y[2]), max(x[2], y[2])))
    assert sorted(pairs(False)) == sorted(want)
    assert set(pairs(True)) <= want and len(pairs(True)) < len(want)


def test_texts_reach_a_worker_of_importance_by_bytes(spark, monkeypatch):
    def sizes(buckets, width):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([batch.nbytes], pa.int64())], names=["bucket", "n"])

        return run

    seen = []
    monkeypatch.setattr(importance, "_counting", sizes)
    monkeypatch.setattr(importance, "_counts", lambda found, buckets: seen.append(found.agg(F.max("n")).first()[0]) or np.zeros(buckets, np.int64))
    monkeypatch.setattr(importance, "histogram", lambda df, text_col, buckets, width: df.select("text").mapInArrow(importance._counting(buckets, width), "bucket int, n long"))
    long = spark.range(0, 900, 1, 1).selectExpr("id AS doc_id", "repeat('long text ', 3000) AS text")
    assert importance.resample(long, long).count() == 900
    assert len(seen) == 2 and 0 < max(seen) < 6_000_000  # 27 MB in one batch before
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None


def test_remembered_buckets_of_a_worker_are_bounded():
    texts = [b" ".join(b"word%d" % i for i in range(a, a + 5000)) for a in range(0, 300_000, 5000)]
    bucket_of = importance._BucketOf(10_000)
    assert peak(lambda: [importance.features([t], 1, bucket_of) for t in texts]) < 15_000_000  # 38 MB for all of them


WIDE = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def written(monkeypatch, module):
    paths = []
    write = control.materialize
    def kept(df, name="materialized"):
        out = write(df, name)
        paths.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(module, "materialize", kept)
    return paths


def test_a_small_benchmark_is_one_small_table(spark, tmp, monkeypatch):
    names = [f"w{i}" for i in range(400)]
    bench = [(i, " ".join(names[i : i + 7 + i % 5])) for i in range(150)] * 2 + [(200, "w5 w6"), (201, None), (202, " ")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "x " + " ".join(names[20:35]) + " y"), (2, " ".join(names[200:210])), (3, "a w5 w6 b")], "doc_id long, text string")
    paths = written(monkeypatch, decontaminate)
    with control.session_conf(spark, WIDE):
        out = decontaminate.contained_items(docs, spark.read.parquet(f"{tmp}/benchmark.parquet"))
        found, parts = out.collect(), out.rdd.getNumPartitions()
    assert paths[0] == ("benchmark-items", 1) and [n for n, _ in paths[1:]] == ["contained-items"]  # two tables of 60 tasks before
    assert parts == 1  # 60 before

    def share(q, d):
        grams = lambda t, n: {tuple(t.split()[k : k + n]) for k in range(len(t.split()) - n + 1)}
        n = min(5, len(q.split()))
        return len(grams(q, n) & grams(d, n)) / len(grams(q, n))

    want = {(d.doc_id, i) for d in docs.collect() for i, q in bench if q and q.strip() and share(q, d.text) >= 0.8}
    assert {(r.doc_id, r.item_id) for r in found} == want and (3, 200) in want and len(found) == len(want) > 3


def test_sorted_rows_of_a_small_table_are_few_files(spark, tmp, monkeypatch):
    rows = spark.range(0, 3000, 1, 5).select((F.col("id") * 31 % 97).alias("a"), "id")
    paths = written(monkeypatch, control)
    with control.session_conf(spark, WIDE):
        df = control.materialize(rows, "few")
        got = {r.id: r.position for r in windows.global_position(df, [F.col("a").desc(), F.col("id").asc()], materialize_input=False).collect()}
    assert paths[-1] == ("position-sorted", 1)  # 60 before
    assert all(got[i] == n for n, i in enumerate(sorted(range(3000), key=lambda i: (-(i * 31 % 97), i)), 1))


def test_few_parts_follow_the_size(spark, tmp):
    spark.range(0, 3000, 1, 5).write.parquet(f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")
    with control.session_conf(spark, WIDE):
        parts = lambda size: control.few_parts(df.repartition(60), df, size).rdd.getNumPartitions()
        size = control.estimated_bytes(df)
        assert (parts(1 << 18), parts(size // 7), parts(1)) == (1, 8, 60)


def test_documents_are_not_shuffled_to_drop_the_contaminated(spark):
    docs = spark.createDataFrame([(i, f"some text of number {i} here") for i in range(200)] + [(None, None)], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(1, "text of number 7 here"), (2, "number 9")], "doc_id long, text string")
    clean = decontaminate.without_contaminated(docs, bench, item_col="doc_id")
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {r.doc_id for r in clean.collect()} == {None, *range(200)} - {7, 9}
    assert {(r[1], r[2]) for r in decontaminate.contained_items(docs, bench, item_col="doc_id").collect()} == {(7, 1), (9, 2)}  # two columns of one name
