"""One query per operator, at production parameters over whole tables, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate, fingerprints, hard_negatives, importance, main_text, mixing, ngram_join, quality, revisits, secrets, suffix_dedup, token_counts, token_files,
)
from tidemark.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        (F.length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times"
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15)) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
      FROM d GROUP BY source),
l AS (SELECT *, 3 * source_size < w * ((sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER p, 0))
                  / (sum(w) OVER () - coalesce(sum(w) OVER p, 0.0))) AS capped
      FROM s WINDOW p AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
                  ELSE least(CAST(3 * source_size AS DOUBLE), w * ((sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ())
                    / sum(CASE WHEN capped THEN 0.0 ELSE w END) OVER ())) END AS target FROM l),
g AS (SELECT source, h, sum(size) AS words FROM d WHERE size > 0 GROUP BY source, h),
c AS (SELECT g.source, g.h, g.words, sum(g.words) OVER (PARTITION BY g.source ORDER BY g.h) - g.words AS below,
             t.target - floor(t.target / t.source_size) * t.source_size AS budget
      FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source),
k AS (SELECT source, h, below + words <= budget OR (below <= budget AND below + words - budget <= budget - below) AS more FROM c)
SELECT d.doc_id, d.size, t.source_size, t.target,
       CAST(CASE WHEN d.size = 0 THEN 0 ELSE floor(t.target / t.source_size) + CAST(k.more AS INTEGER) END AS BIGINT) AS times,
       CAST(d.size * CASE WHEN d.size = 0 THEN 0 ELSE floor(t.target / t.source_size) + CAST(k.more AS INTEGER) END AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.h = k.h
"""


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text("sketch").alias("fingerprint"),
        fingerprints.as_text("edited_sketch").alias("edited_fingerprint"),
        fingerprints.resemblance("sketch", "edited_sketch").alias("near_edited"),
        fingerprints.resemblance("sketch", "next_sketch").alias("near_next"),
    )


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("rk")


OP5_SQL = r"""
WITH w AS (
  SELECT 0 AS k, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
v AS (SELECT k, id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM w),
u AS (SELECT k, id, text, ws, len(ws) AS nw, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM v),
l AS (SELECT DISTINCT len(ws) AS n FROM v WHERE k = 1 AND len(ws) BETWEEN 1 AND 4),
m AS (SELECT k, id, text, nw, i, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS gram
      FROM u WINDOW o AS (PARTITION BY k, id, text ORDER BY i)),
g AS (SELECT k, id, text, gram FROM m WHERE i <= nw - 4 OR (nw < 5 AND i = 1)
      UNION SELECT k, id, text, array_to_string(ws[i:i + n - 1], ' ') FROM u JOIN l ON k = 0 AND i <= nw - n + 1),
n AS (SELECT id, count(*) AS n_item FROM g WHERE k = 1 GROUP BY id),
p AS (SELECT d.id AS doc_id, b.id AS item_id, d.text, count(*) AS n_shared FROM g d JOIN g b ON d.k = 0 AND b.k = 1 AND d.gram = b.gram GROUP BY d.id, b.id, d.text)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM p JOIN n ON n.id = p.item_id WHERE 5 * n_shared >= 4 * n_item
"""


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is an owner; its languages are its repositories."""
    found = secrets.scan(read(spark, sf_dir, "documents"), F.concat_ws("/", "source", "lang"), F.col("source"))
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda i: count(lambda s: s["kind"] == i)
    return found.select(
        "doc_id",
        *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS)],
        F.sha2("base_joined", 256).alias("base_sha256"),
        F.col("joined").alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_copied"),
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


#: What a clean-up job replaces: long numbers, long hexadecimal strings, mail addresses.
REDACTED = r"[0-9a-f]{24,}|[0-9]{4,}|[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+"


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after redaction."""
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return token_counts.edited_counts(
        docs, token_counts.redactions("text", REDACTED, "[X]"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_text=False
    )


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revisits.resolve(revisits.records_of_pages(read(spark, sf_dir, "pages")))
    return out.withColumn("headers", F.to_json(F.array_sort(F.map_entries("headers"))))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.token_folder(spark)
    manifest = token_files.write_tokens(read(spark, sf_dir, "documents"), folder, tokenizer_path())
    return token_files.read_digests(manifest, folder)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, in the benchmark's proportions."""
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("n_words")


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
           FROM documents),
u AS (SELECT r, unnest(ws) AS w FROM d),
v AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
      FROM benchmark),
x AS (SELECT DISTINCT w, hex(w) AS h FROM (SELECT w FROM u UNION ALL SELECT w FROM v)),
-- crc32 of the word's bytes: take in a byte, then eight shifts (the -1s)
c AS (SELECT w, xor(list_reduce([4294967295::BIGINT] || flatten([[('0x' || substr(h, 2 * i + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR i IN range(0, length(h) // 2)]),
                    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 10000 AS bucket FROM x),
s AS (SELECT bucket, count(*) AS n FROM u JOIN c USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM v JOIN c USING (w) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
                  / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
      FROM (SELECT DISTINCT bucket FROM c) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
f AS (SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM u JOIN c USING (w) JOIN g USING (bucket) GROUP BY r),
k AS (SELECT d.doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN f USING (r)),
o AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM k)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM k WHERE n_features >= 20) THEN place END AS rank FROM o
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth row is an anchor; every seventh has another's label."""
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP12_SQL = r"""
WITH e AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * v::DOUBLE) FOR v IN embedding] AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
      FROM e a JOIN e b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 10
"""


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(read(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_ngram_join": op8_ngram_join,
    "op9_secret_scan": op9_secret_scan,
    "op10_token_output": op10_token_output,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_html_extraction": op13_html_extraction,
}
ORACLE: dict[str, str] = {
    "op2_source_mixing": OP2_SQL, "op5_benchmark_decontamination": OP5_SQL,
    "op11_importance_resampling": OP11_SQL, "op12_hard_negatives": OP12_SQL,
}
