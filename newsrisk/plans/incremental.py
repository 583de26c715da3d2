"""Refreshing the daily mart without recomputing all of it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newsrisk.operators.skew import join_one_per_key
from newsrisk.plans.marts import daily_mart
from newsrisk.plans.staging import staging
from newsrisk.schema import DAILY
from newsrisk.sources.tables import read_or_empty

EPOCH = dt.date(1970, 1, 1)


# The stored mart has one row per date, so it is partitioned by year: a refresh replaces the
# year or two it touches, and no folder holds a single row.
PARTITION = "mart_year"


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The stored daily mart, columns in schema order; empty before the first refresh."""
    return _stored(spark, path).select(*DAILY.names)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*DAILY.fields, T.StructField(PARTITION, T.IntegerType())])
    return read_or_empty(spark, path, schema)


def _write(daily: DataFrame, path: str, overwrite: str) -> None:
    (
        daily.withColumn(PARTITION, F.year("published_date"))
        .hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .partitionBy(PARTITION)
        .parquet(path)
    )


def full_refresh(bronze: DataFrame, path: str) -> None:
    """Rebuild the mart from all of bronze, dropping dates that no longer occur."""
    full_refresh_from(staging(bronze), path)


def full_refresh_from(staged: DataFrame, path: str) -> None:
    """Rebuild the mart from silver that exists already."""
    _write(daily_mart(staged), path, "static")


def replace_dates(spark: SparkSession, path: str, fresh: DataFrame, dates: DataFrame) -> None:
    """Replace the stored rows of ``dates`` by ``fresh``; all other dates stay as they are.

    Only the years of ``dates`` are rewritten, and they are swapped in when the job commits.
    ``fresh`` and ``dates`` have one row per date, so the list of years and the merged rows
    are bounded by the calendar.
    """
    years = [r[0] for r in dates.select(F.year("published_date")).distinct().collect()]
    kept = (
        _stored(spark, path)
        .where(F.col(PARTITION).isin(years))
        .select(*DAILY.names)
        .join(dates, "published_date", "left_anti")
    )
    merged = kept.unionByName(fresh).persist()
    try:
        filled = {r[0] for r in merged.select(F.year("published_date")).distinct().collect()}
        _write(merged, path, "dynamic")
        _drop_years(spark, path, sorted(set(years) - filled))
    finally:
        merged.unpersist()


def _drop_years(spark: SparkSession, path: str, years: list[int]) -> None:
    # A dynamic overwrite cannot empty a partition, so a year that lost its last date is
    # removed by name.
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for year in years:
        files.delete(hadoop.Path(root, f"{PARTITION}={year}"), True)


def watermark(daily: DataFrame) -> dt.date:
    """The latest stored date, or the epoch for an empty mart."""
    return daily.agg(F.coalesce(F.max("published_date"), F.lit(EPOCH))).first()[0]


def since(bronze: DataFrame, date: dt.date) -> DataFrame:
    """Daily rows for dates from ``date`` on, reading only bronze partitions of those dates.

    The filter belongs after the per-link dedup.  It may run before it because the dedup
    keeps the latest date: a link whose latest row is on or after ``date`` keeps that row
    either way, and any other link has no row left.  Catalyst cannot know this, so it is
    done here; it turns a scan of all history into a scan of the new partitions.
    """
    recent = bronze.where(F.col("published_date") >= F.lit(date))
    return daily_mart(staging(recent))


def refresh_watermark(spark: SparkSession, bronze: DataFrame, path: str) -> None:
    """Recompute the latest stored date and everything after it.

    Older dates are never touched, even when late articles arrive for them.
    """
    _replace_from(spark, since(bronze, watermark(read_daily(spark, path))), path)


def refresh_watermark_from(spark: SparkSession, staged: DataFrame, path: str) -> None:
    """The same from silver that exists already: only its dates from the latest stored one on."""
    recent = staged.where(F.col("published_date") >= F.lit(watermark(read_daily(spark, path))))
    _replace_from(spark, daily_mart(recent), path)


def _replace_from(spark: SparkSession, daily: DataFrame, path: str) -> None:
    fresh = daily.persist()
    try:
        replace_dates(spark, path, fresh, fresh.select("published_date"))
    finally:
        fresh.unpersist()


def affected_dates(batch: DataFrame, bronze: DataFrame) -> DataFrame:
    """Dates whose mart row can change through ``batch`` (already part of ``bronze``).

    A link counts only on its latest date, so for each link of the batch these are its latest
    date now and its latest date before, which the batch may have taken it away from; and the
    dates of the batch, whose rows may be new.
    """
    key = ["link", "published_date"]
    links = batch.select("link").distinct()
    sightings = join_one_per_key(bronze.select(*key), links, ["link"], "left_semi")
    before = join_one_per_key(sightings, batch.select(*key).distinct(), key, "left_anti")
    last = before.groupBy("link").agg(F.max("published_date").alias("published_date"))
    now = sightings.groupBy("link").agg(F.max("published_date").alias("published_date"))
    dates = [d.select("published_date") for d in (last, now, batch)]
    return dates[0].union(dates[1]).union(dates[2]).distinct()


def recompute(bronze: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily rows of exactly ``dates`` (one column ``published_date``).

    Only links seen on one of the dates can count there, so only their sightings are
    deduplicated; and none before the earliest date, which cannot matter (see :func:`since`).
    The dates are collected, there are as many as the calendar has days: they are partition
    filters of the first scan.
    """
    days = sorted(r[0] for r in dates.distinct().collect())
    if not days:
        return daily_mart(staging(bronze.where(F.lit(False))))
    links = bronze.where(F.col("published_date").isin(days)).select("link").distinct()
    recent = bronze.where(F.col("published_date") >= F.lit(days[0]))
    touched = join_one_per_key(recent, links, ["link"], "left_semi")
    return daily_mart(staging(touched).where(F.col("published_date").isin(days)))


def refresh_affected(
    spark: SparkSession, bronze: DataFrame, batch: DataFrame, path: str
) -> None:
    """Recompute the dates ``batch`` touches; the mart then equals a full refresh.

    A date that lost its last article has no recomputed row and disappears.
    """
    dates = affected_dates(batch, bronze).persist()
    fresh = recompute(bronze, dates).persist()
    try:
        replace_dates(spark, path, fresh, dates)
    finally:
        fresh.unpersist()
        dates.unpersist()
