"""Registered queries of the training-data operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers

from hvault.llm import bpe_codec
from hvault.llm.centroids import CLUSTER_SQL, cluster_vectors
from hvault.llm.chat_format import CHAT_SQL, chat_lines
from hvault.llm.common import table
from hvault.llm.embedding_neardup import dedup_embeddings
from hvault.llm.exact_dedup import EXACT_SQL, dedup_exact
from hvault.llm.packing import pack_documents
from hvault.llm.quality_classifier import score_documents
from hvault.llm.secret_scan import find_secrets
from hvault.llm.sentencepiece_codec import codec_digest
from hvault.llm.simhash import dedup_simhash
from hvault.llm.substring_dedup import substring_digest
from hvault.llm.suffix_dedup import suffix_digest
from hvault.llm.whitening import whiten


def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


QUERIES = {
    "pipeline": pipeline,
    "op1_embedding_neardup": lambda spark, sf_dir: dedup_embeddings(table(spark, sf_dir, "embeddings")),
    "op2_simhash_bk_trees": lambda spark, sf_dir: dedup_simhash(documents(spark, sf_dir)),
    "op3_substring_dedup": lambda spark, sf_dir: substring_digest(documents(spark, sf_dir)),
    "op4_suffix_dedup": lambda spark, sf_dir: suffix_digest(documents(spark, sf_dir)),
    "op5_chat_tool_calls": lambda spark, sf_dir: chat_lines(table(spark, sf_dir, "conversations")),
    "op6_quality_classifier": lambda spark, sf_dir: score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels")),
    "op7_sentencepiece": lambda spark, sf_dir: codec_digest(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")),
    "op8_exact_dedup": lambda spark, sf_dir: dedup_exact(documents(spark, sf_dir)),
    "op9_packing": lambda spark, sf_dir: pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken")),
    "op10_secret_scan": lambda spark, sf_dir: find_secrets(documents(spark, sf_dir)),
    "op11_embedding_whitening": lambda spark, sf_dir: whiten(table(spark, sf_dir, "embeddings")),
    "op12_bpe": lambda spark, sf_dir: bpe_codec.codec_digest(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")),
    "op13_centroid_clustering": lambda spark, sf_dir: cluster_vectors(table(spark, sf_dir, "embeddings")),
}

ORACLES: dict[str, str] = {"op5_chat_tool_calls": CHAT_SQL, "op8_exact_dedup": EXACT_SQL, "op13_centroid_clustering": CLUSTER_SQL}
