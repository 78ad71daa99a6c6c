"""The corpus pipeline: five stages over ``documents``, each on all that the one
before kept. Every stage is one operator of ``tidewater.llm``; all but the last
return the columns of documents.

Null and empty texts have no language and leave at the first stage; stages on
an empty table return an empty table; other columns pass through unread.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.bpe import encode
from tidewater.llm.common import shared_folder, table
from tidewater.llm.decontaminate import drop_contaminated
from tidewater.llm.exact_dedup import drop_exact_copies
from tidewater.llm.language import keep_identified, train_language_model
from tidewater.llm.queries import BYTE_RANKS
from tidewater.llm.simhash import RADIUS, SHINGLE, drop_near_copies


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, train_language_model(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, shingle=SHINGLE, radius=RADIUS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode_bytes),
]

#: The language model, SimHash and BPE cannot be stated in SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
