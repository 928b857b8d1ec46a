"""The corpus pipeline: language ID, near-dedup, substring dedup, benchmark
decontamination, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.bpe import encode_and_decode
from helixframe.llm.decontaminate import contamination
from helixframe.llm.jaccard import near_duplicates
from helixframe.llm.language import held_out, predict, train
from helixframe.llm.queries import default_tokenizer
from helixframe.llm.shared import written
from helixframe.llm.substrings import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those without text or letters go.

    The profiles are learned from the documents' own lang column, without the held-out quarter."""
    model = train(docs.where(~held_out("doc_id") & F.col("doc_id").isNotNull()))
    return predict(docs, model, keep=COLUMNS[1:]).where("lang_pred <> 'und'").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, linked by a Jaccard similarity of 0.8 or
    more of their five-word shingles, the document of the smallest doc_id.

    Candidates come from SimHash fingerprints by anchor-point covering and from
    bands of minimum hashes for pairs that differ in more bits. Rows that share
    a doc_id are one document, and one of them stays; a group whose ids are all
    null keeps each of its different texts once. Columns other than those of
    documents are not read."""
    docs = docs.select(*COLUMNS)
    first = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    kept = docs.join(first.withColumnRenamed("doc_id", "first"), F.col("doc_id").eqNullSafe(F.col("first")), "left_semi").select(*COLUMNS)
    return kept.withColumn("__text", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).dropDuplicates(["doc_id", "__text"]).drop("__text")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that an earlier document, or the same one earlier, has. A document that loses all its words goes."""
    cut = remove_repeats(docs, spaced=False, keep=("lang", "source")).where("n_words = 0 or n_removed < n_words")
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no 10-word window with a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark, keep=COLUMNS[1:]).where("n_hit = 0").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return encode_and_decode(docs, default_tokenizer())


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

#: SQL has neither the profiles nor the tokenizer: tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
