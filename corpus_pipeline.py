"""The training-data pipeline: quality, near duplicates, benchmark items, source
mix, token files. Each stage works on all that the one before it kept; a stage's
result is written to the shared folder and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, ngram_join, quality, token_files
from tidemark.llm.common import read, row_key
from tidemark.llm.queries import tokenizer_path
from tidemark.operators.control import materialize

#: Near duplicates: words of a shingle and least similarity in percent.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    good = quality.score(docs, read(spark, sf_dir, "labels")).where("predicted = 1").select(F.col("rk").alias("_good")).distinct()
    return docs.join(good, row_key() == F.col("_good"), "left_semi")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the smallest id
    (of equal ids the smallest row key, of exact repeats one). A document with
    no words is linked with none; repeats of one are left as they are."""
    found = ngram_join.similar_components(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)
    first = (
        found.where("n_shingles > 0").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rk")).alias("first"))
        .select(F.col("first.rk").alias("_kept"))
        .union(found.where("n_shingles = 0").select("rk").distinct())
    )
    kept = docs.join(first, row_key() == F.col("_kept"), "left_semi").withColumn("_wordless", mixing.word_count(F.col("text")) == 0)
    one = kept.where("NOT _wordless").drop("_wordless")
    return one.dropDuplicates(["doc_id", "text"]).unionByName(kept.where("_wordless").drop("_wordless"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, however short."""
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"), short_items=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken."""
    taken = mixing.mix(docs).where("times > 0").select(F.col("hash").alias("_hash"), F.col("times").alias("_times"), F.col("source").alias("_source")).distinct()
    same = (mixing.document_hash("doc_id", "text") == F.col("_hash")) & F.col("source").eqNullSafe(F.col("_source"))
    return docs.join(taken, same).withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what a reader finds in them."""
    folder = token_files.token_folder(spark)
    return token_files.read_digests(token_files.write_tokens(docs, folder, tokenizer_path()), folder)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_token_files),
]

#: Trees, similarity components and a tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{i}")
    return docs
