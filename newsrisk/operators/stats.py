"""Run counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def scrape_stats(articles: DataFrame) -> DataFrame:
    """Article counts per (source, category), per source and in total.

    Rows are counted per pair first; the rollup then expands a handful of pre-aggregated
    rows instead of three copies of every article.  ``level`` tells the rows apart: 2 pair,
    1 source, 0 total.
    """
    pairs = articles.groupBy("source", "category").agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.rollup("source", "category")
        .agg(F.sum("n").alias("articles"), F.grouping_id().alias("_g"))
        .select(
            "source",
            "category",
            F.when(F.col("_g") == 0, 2).when(F.col("_g") == 1, 1).otherwise(0).alias("level"),
            "articles",
        )
    )


def page_stats(items: DataFrame, page: Sequence[str], date: str = "article_date") -> DataFrame:
    """Items and oldest date per page, from exploded items."""
    return items.groupBy(*page).agg(
        F.count(F.lit(1)).alias("items"), F.min(date).alias("oldest_date")
    )
