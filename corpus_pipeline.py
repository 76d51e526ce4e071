"""A cleaning pipeline over ``documents``: every stage calls one of the training-data operators.

1. quality classifier: documents that it rejects go;
2. SimHash near-duplicates: one document of each group stays;
3. benchmark decontamination: documents that overlap a benchmark item go;
4. personal data: spans are replaced by their kind;
5. SentencePiece: texts are encoded and decoded again; their digests are the result.

A stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and all but the
last return the columns of ``documents``. ``run`` writes each stage as Parquet into the shared
folder and reads it back for the next, so a lost executor never goes back beyond a stage.
Nulls, empty texts, repeated rows and extra columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellar.llm import decontaminate, pii, quality, sentencepiece_codec, simhash
from cellar.llm.common import table
from cellar.llm.queries import piece_model
from cellar.session import scratch_dir

#: Near-duplicates as the SimHash contract has them.
SHINGLE, MAX_BITS = 3, 3


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, SHINGLE, MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keep = [c for c in docs.columns if c != "text"]
    return sentencepiece_codec.encode_documents(docs, piece_model(), keep=keep)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("SimHash near-dedup", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal_data),
    ("SentencePiece encoding and decoding", encode_and_decode),
]

#: SQL can't express the stages; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        place = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
