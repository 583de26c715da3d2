"""Silver: clean, one row per link, relevance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsrisk.functions.lexicon import RELEVANCE, RelevanceRule
from newsrisk.functions.match import relevance
from newsrisk.operators.dedup import latest_per_link


def clean(bronze: DataFrame) -> DataFrame:
    """Lower-cased title copy and a DATE, next to the untouched article columns."""
    return bronze.select(
        "title",
        F.lower("title").alias("title_cleaned"),
        "link",
        "category",
        "date_text",
        "source",
        F.col("published_date").cast("date").alias("published_date"),
        "ingest_seq",
    )


def staging(bronze: DataFrame, rule: RelevanceRule = RELEVANCE) -> DataFrame:
    """Cleaned, deduplicated articles with ``is_relevant`` (0/1).

    Lazy; callers that feed several marts from it should ``persist`` it once.
    """
    # Cleaning comes after the dedup: only one copy of each title is sorted and moved.
    return clean(latest_per_link(bronze)).withColumn("is_relevant", relevance("title_cleaned", rule))
