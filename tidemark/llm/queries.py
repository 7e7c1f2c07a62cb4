"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    count_tree, feistel_pii, hidden_markov, host_rules, mixing, near_dedup, pivot_clusters, pivot_search, pu_toxicity,
    secret_links, sentence_wfst, turn_repair, url_filter,
)
from tidemark.llm.common import documents, table
from tidemark.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES", "TOKENIZERS", "model_path"]

#: Folder with the public vocabulary files; a parameter of the sentence queries.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def model_path(folder: str = TOKENIZERS) -> str:
    return os.path.join(folder, "piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_wfst.digests(documents(spark, folder), model_path())


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_links.scan(documents(spark, folder))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return pu_toxicity.scored(documents(spark, folder), table(spark, folder, "labels"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return feistel_pii.counted(documents(spark, folder))


def op5_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.judged(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.with_components(documents(spark, folder)).select("doc_id", "n_shingles", "component_id", "kept")


def op7_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_search.top_k(table(spark, folder, "embeddings"))


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filtered(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    return hidden_markov.scored(documents(spark, folder))


def op11_set_join(spark: SparkSession, folder: str) -> DataFrame:
    return count_tree.with_components(documents(spark, folder)).select("doc_id", "n_shingles", "component_id")


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_clusters.clustered(table(spark, folder, "embeddings"))


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repaired(turn_repair.damaged(table(spark, folder, "conversations")))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


_OPERATORS = (
    op1_sentencepiece, op2_secrets, op3_toxicity, op4_pii, op5_host_rules, op6_near_duplicates, op7_mixture, op8_top_k,
    op9_url_filter, op10_hidden_markov, op11_set_join, op12_centroids, op13_turn_repair,
)
QUERIES = {f.__name__: f for f in _OPERATORS}
if importlib.util.find_spec("corpus_pipeline"):
    QUERIES["pipeline"] = pipeline
