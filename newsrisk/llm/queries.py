"""The operators of this package as queries over the given tables, some with equivalent SQL."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession

from newsrisk.llm import (
    bpe,
    collocations,
    fingerprints,
    jaccard_join,
    licences,
    mixing,
    quality,
    quality_classifier,
    repeated_bytes,
    repeated_words,
    shards,
    spelling,
    toxicity,
)
from newsrisk.llm.common import documents, labels
from newsrisk.llm.oracle import ORACLE


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer files lie; NEWSRISK_TOKENIZERS names another folder."""
    folder = os.environ.get("NEWSRISK_TOKENIZERS")
    if not folder:
        found = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(found.origin) if found else "/opt/tokenizers"
    return os.path.join(folder, name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(documents(spark, sf_dir))


def op2_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words.digest(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), labels(spark, sf_dir))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.documents_by_text(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(documents(spark, sf_dir).select("doc_id", "source", "text"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), tokenizer_file())


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.spans(documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.digest(documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(documents(spark, sf_dir), labels(spark, sf_dir))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_repeated_words": op2_repeated_words,
    "op3_quality_rules": op3_quality_rules,
    "op4_shards": op4_shards,
    "op5_mixing": op5_mixing,
    "op6_bpe": op6_bpe,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_licences": op8_licences,
    "op9_toxicity": op9_toxicity,
    "op10_repeated_bytes": op10_repeated_bytes,
    "op11_spelling": op11_spelling,
    "op12_collocations": op12_collocations,
    "op13_quality_classifier": op13_quality_classifier,
}

__all__ = ["ORACLE", "QUERIES"]
