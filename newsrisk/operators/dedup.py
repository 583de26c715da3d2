"""Keeping one row per link, and the newest-first prefix cut."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsrisk.functions.dates import as_date
from newsrisk.operators.skew import join_one_per_key


def _first_by(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    # row_number() = 1 makes Spark keep only the best row per key and task before the
    # shuffle (WindowGroupLimit), so a key that owns a third of the table sends at most one
    # row per map task and never piles up in one reducer.  The hash in front changes no
    # group; links share a long prefix, and sorting by eight bytes that differ is a quarter
    # faster than comparing whole addresses.
    window = Window.partitionBy(F.xxhash64(key), key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def latest_per_link(
    df: DataFrame,
    key: str = "link",
    date: str = "published_date",
    ties: Sequence[str] = ("ingest_seq",),
) -> DataFrame:
    """The row with the latest date per link; ``ties`` make the choice deterministic.

    NULL links form one group, as in SQL.
    """
    return _first_by(df, key, [F.desc(date), *[F.desc(c) for c in ties]])


def last_occurrence(df: DataFrame, key: str = "link", order: str = "ingest_seq") -> DataFrame:
    """The row seen last per link within one run."""
    return _first_by(df, key, [F.desc(order)])


def duplicates_removed(df: DataFrame, key: str = "link") -> DataFrame:
    """One row: rows in, distinct links, rows a per-link dedup removes."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("articles"),
        F.count(F.lit(1)).alias("unique_articles"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_removed"),
    )


def prefix_cut(
    df: DataFrame,
    page: Sequence[str],
    position: str,
    date: str,
    target: Column | dt.date | str,
) -> DataFrame:
    """Rows of each page before the first row dated earlier than ``target``.

    Pages list newest first, so nothing below that row can match.  Rows without a date are
    skipped by the scan and do not end it.  The cut position is a plain MIN per page (partial
    aggregation, one row per page crosses the network), so no page is ever sorted in one
    task as a running window would require.
    """
    cut = (
        df.where(F.col(date) < as_date(target))
        .groupBy(*page)
        .agg(F.min(position).alias("_cut"))
    )
    joined = join_one_per_key(df, cut, page, "left")
    return joined.where(F.col("_cut").isNull() | (F.col(position) < F.col("_cut"))).drop("_cut")
