"""Registered queries of the training-data operators: whole tables, production parameters.

Each query is a thin digest over its operator's general interface. Oracle SQL stands beside a
query where SQL can express it over whole tables; the others are tested against brute force.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellar.llm import (
    decontaminate,
    html_text,
    lexical_search,
    merkle,
    minhash,
    ngram_lm,
    pii,
    quality,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    topk,
    url_filter,
)
from cellar.llm.common import table

#: Place of the SentencePiece model; a parameter of the deployment.
PIECE_MODEL_VARIABLE = "CELLAR_PIECE_MODEL"


def piece_model() -> str:
    """Path of the tokenizer model: the environment's, else the installed public vocabulary."""
    if os.environ.get(PIECE_MODEL_VARIABLE):
        return os.environ[PIECE_MODEL_VARIABLE]
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.digest(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentencepiece_codec.encode_documents(docs, piece_model(), keep=["doc_id"])


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(table(spark, sf_dir, "pages"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(table(spark, sf_dir, "pages"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, tuple[Callable, str | None]] = {
    "op1_suffix_dedup": (op1_suffix_dedup, None),
    "op2_pii": (op2_pii, None),
    "op3_lm_scoring": (op3_lm_scoring, None),
    "op4_quality": (op4_quality, None),
    "op5_sentencepiece": (op5_sentencepiece, None),
    "op6_topk": (op6_topk, topk.ORACLE_SQL),
    "op7_decontamination": (op7_decontamination, None),
    "op8_simhash": (op8_simhash, None),
    "op9_url_filter": (op9_url_filter, None),
    "op10_html_text": (op10_html_text, None),
    "op11_lexical_search": (op11_lexical_search, lexical_search.ORACLE_SQL),
    "op12_merkle_manifest": (op12_merkle_manifest, merkle.ORACLE_SQL),
    "op13_minhash": (op13_minhash, None),
}
