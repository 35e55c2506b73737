"""Training-corpus pipeline: quality, exact copies, near copies, secrets, packing.

Each stage takes the documents that its predecessor kept and returns documents
with the same columns; the last one returns the packed pieces. A stage's result
is written as a table in the session's shared folder before the next one reads
it, so a lost executor never repeats earlier stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hvault.llm.common import stored, table
from hvault.llm.exact_dedup import drop_copies
from hvault.llm.packing import pack_documents
from hvault.llm.quality_classifier import keep_good
from hvault.llm.secret_scan import redact_secrets
from hvault.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled training rows among ``docs``."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences: see ``pack_documents``."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("secret_scan", secrets),
    ("packing", packing),
]

#: SQL cannot express the classifier, the decoding worklist and the packing; the tests check the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
