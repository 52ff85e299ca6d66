"""Corpus pipeline: raw documents to token ids. Each stage is written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from abacist.llm import bpe, jaccard_join, mixing, pii, quality
from abacist.llm.queries import table, tokenizer_path, tokenizer_pattern
from abacist.session import shared_dir


MEMORY = 60_000
"""What a tokenizing worker remembers: less than the operator's own bound, as its executor also serves the other stages."""


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal data."""
    return pii.pseudonymise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources come near their target weights."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every drawn text; the ids are decoded again for the digest."""
    return bpe.encode(docs, tokenizer_path(), tokenizer_pattern(), memory=MEMORY)


STAGES = [("quality", keep_good), ("near_duplicates", keep_one), ("pseudonyms", pseudonymise), ("mix", mix), ("tokens", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
