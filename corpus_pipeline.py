"""The corpus pipeline: from raw documents to token digests, one operator a stage.

Every stage takes what the stage before kept, written as Parquet and read again, and all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremeld.llm import chunked_bpe, decontaminate, quality, secret_spans, simhash
from caremeld.llm.queries import quality_labels
from caremeld.llm.shared import free_name, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones outside the held-out fold, accepts."""
    model = quality.fitted(docs, quality_labels(spark, sf_dir))
    return docs.where(quality.scores(F.col("text"), model) >= 0.5)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text and the number of characters counted anew."""
    spans = free_name(docs, "spans")
    found = secret_spans.secret_spans(docs, into=spans)
    cleaned = found.withColumn("text", secret_spans.redacted(F.col("text"), F.col(spans)))
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number and the digests of every document's tokens."""
    together = chunked_bpe.brought_together(docs.select("doc_id", "text"), "text")
    found = chunked_bpe.digests(F.col("text"), public_tokenizers.path("byte_bpe_50k.json"))
    return together.select("doc_id", found.alias("found")).select("doc_id", "found.*")


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", hide_secrets),
    ("BPE encoding and decoding", encode),
]

#: SQL can express neither the classifier, the fingerprints, nor the vocabulary; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
