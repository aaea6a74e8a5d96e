"""The corpus pipeline: stages over `documents`, each the input of the next. Part of the subpackage docloom.llm."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docloom.llm import exact_dedup, language_id, minhash, packing, suffix_dedup
from docloom.llm.common import shared_folder, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose text has no letter, or is explained by no language that was learned (a lift of 0 at most)."""
    return language_id.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more over five-word shingles, the smallest doc_id stays."""
    return minhash.keep_representatives(docs, size=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur elsewhere too are cut out of the texts; every document stays, if only with the rest of its text."""
    return suffix_dedup.without_repeats(docs, length=200)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 4096 ids at most."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), length=4096, end_id=2)


STAGES = [("language ID", language), ("exact dedup", exact), ("MinHash near-dedup", near), ("suffix-array dedup", repeats), ("packing", packed)]

#: SQL cannot express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet in the shared folder and read again as the next input."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
