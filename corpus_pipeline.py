"""A training corpus from raw documents, in stages that are written one after the other.

Rejects documents of low quality, keeps one of each group of near duplicates,
cuts benchmark passages, masks personal data, and encodes what is left. Every
stage works on all documents that the one before kept, and its output is a
Parquet table in the shared folder, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.bindings.registry import table
from landfall.llm import bpe
from landfall.llm.decontaminate import decontaminate
from landfall.llm.jaccard_join import keep_one_of_each
from landfall.llm.personal_data import redacted
from landfall.llm.quality_classifier import keep_good
from landfall.llm.queries import tokenizer_path
from landfall.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score reaches the threshold."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8: that of the smallest id."""
    return keep_one_of_each(docs, n=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those made of them for the most part go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return redacted(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and the digest of the text they decode to."""
    return bpe.round_trip_digests(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", encoding),
]

# Learned scores, exact set joins and byte pairs are beyond SQL; tests compare
# the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
