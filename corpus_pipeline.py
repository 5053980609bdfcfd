"""Corpus pipeline over ``documents``: quality, near-dedup, pseudonyms, mixing, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns the columns of ``documents`` (the last: token ids).  ``run``
writes every stage's rows as Parquet to the shared folder and reads them again,
so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passante.llm import bagminhash, bpe, importance, mixing, pii
from passante.llm.common import read_table, written
from passante.llm.queries import PII_KEY, VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample takes; the others are rejected."""
    return importance.Resampler(docs, read_table(spark, sf_dir, "labels")).resample(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return bagminhash.deduplicated(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced within its format; n_chars follows the new text."""
    out = pii.pseudonymise(docs, PII_KEY)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.Mixer(docs).mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens and the digests of packed ids and decoded text, per copy."""
    return bpe.digests(bpe.encode(docs, VOCABULARY, decoded=True))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("pseudonyms", pseudonyms), ("mix", mix), ("token_ids", token_ids)]

#: No stage can be told in SQL alone (sampling noise, signatures, keyed permutation, iterated duals, merges).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
