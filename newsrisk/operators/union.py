"""Bringing the frames of all sources together."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from newsrisk.schema import ARTICLE_COLUMNS


def stamp(articles: DataFrame, source: str) -> DataFrame:
    """Mark every row with the source it came from."""
    return articles.withColumn("source", F.lit(source))


def union_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Bag union by name of all sources, each stamped with its key; duplicates are kept.

    A source that lacks a column has NULLs there, and other columns are left out: one source's
    shape does not stop the rest.  Errors while reading a source are not hidden.
    """

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ARTICLE_COLUMNS])

    return reduce(DataFrame.unionByName, [aligned(stamp(df, name)) for name, df in sources.items()])
