"""The text pipeline: stages in order, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps with their columns, the last one
the token ids. ``run`` writes each stage's result to the shared folder and reads it again for the next.

* language_id: documents that no learned language fits go (no letter, or a cross-entropy far
  above what the language's own texts have).
* line_dedup: lines that repeat an earlier line go; a document of which nothing but white space is left by
  that goes.
* near_duplicates: of documents with nearly equal sets of word 5-grams (Jaccard of 0.8 or
  more) the one with the smallest id stays.
* decontaminate: documents that hold a benchmark item go.
* encode: ids of every text, with the digest of the bytes that they decode to.

Documents with null or empty text have no letter, so the first stage removes them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from arbolytics.llm import byte_bpe, decontaminate, language_id, line_dedup, ngram_join
from arbolytics.llm.common import ship
from arbolytics.llm.queries import RANK_FILE
from arbolytics.session import stage


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that a language learned from the labelled ones fits."""
    ship(spark)
    model = language_id.train(docs)
    found = language_id.language_column(docs, model, F.col("text").cast("string"))
    return docs.withColumn("_language", found).filter("not _language.rejected").drop("_language")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated lines from the texts, and documents that lose all their words by it."""
    found = line_dedup.line_dedup(docs)
    return found.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates: the one with the smallest id."""
    ship(spark)
    classes = ngram_join.ngram_components(docs, length=5, parts=80)
    return ngram_join.keep_first(docs, classes)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.items_found(benchmark, F.col("text").cast("string"))
    return docs.withColumn("_items", found).filter(F.size("_items") == 0).drop("_items")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    ship(spark)
    return byte_bpe.round_trip(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("encode", encode),
]

# Models, components and tokenizers have no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
