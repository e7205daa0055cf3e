"""From raw documents to piece ids: five stages, each of one operator.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept, and is written as Parquet before the next one reads it, so a lost
executor costs part of a stage.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.llm import classifier, jaccard, sample, secrets, suffix
from pricefold.llm.shared import public_model, scratch, stage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (operator 7).
    A fifth of the labels, by crc32 of doc_id, is not learned from."""
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = classifier.fit(docs, table(spark, sf_dir, "labels").where(learned))
    return classifier.accept(docs, model)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles with
    a Jaccard similarity of 0.8 or more (operator 6)."""
    return jaccard.keep_one(docs, num=8, den=10, width=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ten words of any benchmark item (operator 3)."""
    return suffix.decontaminate(docs, table(spark, sf_dir, "benchmark"), width=10)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts (operator 9)."""
    return secrets.redact(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document (operator 4)."""
    rows = sample.encode(docs.select("doc_id", "lang", "source", "text"), public_model())
    return rows.drop("text").withColumn("n_pieces", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_per_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("SentencePiece encoding", pieces),
]

#: Trained models, similarity groups and sampled pieces are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, f) in enumerate(STAGES[:-1]):
        docs = stage(f(spark, docs, sf_dir), folder, f"stage{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
