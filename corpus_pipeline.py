"""A corpus pipeline: each stage is written as Parquet and read again by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, near_dedup, pu_toxicity, secret_links, sentence_wfst
from tidemark.llm.common import documents, stage, table
from tidemark.llm.queries import model_path

#: Words of a shingle in the near_duplicates stage; ``op6_near_duplicates`` has 2 by its contract.
SHINGLE_WORDS = 5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return pu_toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose sets of 5-word shingles are linked at 0.8 or more."""
    return near_dedup.kept_documents(docs, width=SHINGLE_WORDS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a placeholder."""
    return secret_links.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or go as the sources' budgets ask."""
    return mixing.mixed_texts(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the text they decode to."""
    return sentence_wfst.encoded(docs, model_path(), keep=("doc_id", "lang", "source"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("tokens", tokens),
]
#: The classifier's training and the transducer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
