"""A corpus for training, in five stages: each reads what its predecessor wrote.

1. toxicity: documents scored 0.5 or more go.
2. n-gram Jaccard join: of each group of near duplicates the least doc_id stays.
3. suffix-array dedup: bytes in strings of 200 that occur more than once go.
4. mixing: documents are repeated so that all sources have about as many bytes.
5. BPE: every document's ids and what they decode to.

The first four keep the columns of ``documents``.  Rows without a doc_id that are near
duplicates of others go; one such row of a group without any doc_id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsrisk.llm import bpe, jaccard_join, mixing, repeated_bytes, toxicity
from newsrisk.llm.common import documents, labels, stored
from newsrisk.llm.queries import tokenizer_file


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights, bias = toxicity.learn(docs, labels(spark, sf_dir))
    return toxicity.score(docs, weights, bias).where("predicted = 0").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that repeat the doc_id that stays are told apart by their text; one of them stays."""
    return jaccard_join.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bytes that are left, as text: parts of a character that was cut go too."""
    left = repeated_bytes.drop_repeated(docs, as_text=True)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    left = left.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return left.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.replicate(docs).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, tokenizer_file())


STAGES = [
    ("toxicity", toxic),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]

#: SQL cannot express a learned score, connected components or merges; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"stage{at}")
    return docs
