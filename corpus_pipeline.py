"""A training-corpus pipeline over ``documents``: each stage is one of the document operators.

Stages in order: toxic documents go, exact copies go, one document of each group of near copies
stays, documents that hold a benchmark passage go, and what is left is encoded and decoded. Each
stage is judged on its own input; what it returns is written as Parquet and read again as the next
one's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerscope.llm import decontam, exact_dedup, pieces, simhash, toxicity
from ledgerscope.llm.common import remove, table
from ledgerscope.session import ensure_checkpoint_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5; it is fitted on this stage's input and the labels."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one that the exact deduplication keeps."""
    return exact_dedup.drop_exact_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id."""
    return simhash.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the documents that are left."""
    return pieces.digests(pieces.round_trip(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]

#: a classifier that is trained, fingerprints and sub-word ids are beyond SQL; tests hold ``run``
#: against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)  # the next stage's output no longer needs it
        before = path
    return docs
