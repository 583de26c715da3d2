"""The append-only bronze table and the guard that keeps loads idempotent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsrisk.operators.skew import join_one_per_key
from newsrisk.schema import RAW_NEWS
from newsrisk.session import discard, scratch_path
from newsrisk.sources.tables import read_or_empty

KEY = ("published_date", "link")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The bronze table at ``path``; empty before the first load."""
    return read_or_empty(spark, path, RAW_NEWS)


def create_bronze(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Declare bronze as a catalog table, partitioned by date, if it does not exist."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_NEWS.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) "
        f"USING parquet PARTITIONED BY (published_date){where}"
    )


def unseen(batch: DataFrame, bronze: DataFrame, load_key: str | None = "load_key") -> DataFrame:
    """Batch rows whose link is not yet in bronze **for the same date**.

    NULL links compare equal.  Files of a batch count as loaded one after another in
    ``load_key`` order: a link of an earlier file hides the same link and date in later
    files, while copies inside one file are all kept (silver removes them).

    Keys of both sides shrink to one row each, map-side first, so a link that fills a third
    of the batch or of bronze costs nothing there.  Bronze is only read for the two key
    columns, and takes part as the file that was loaded before all others: one grouping
    finds the first file of every key, and whether that is bronze.
    """
    loaded = bronze.select(*KEY)
    if load_key is None or load_key not in batch.columns:
        return join_one_per_key(batch, loaded.distinct(), KEY, "left_anti")
    first = (
        batch.select(*KEY, load_key)
        .unionByName(loaded.withColumn(load_key, F.lit("")))
        .groupBy(*KEY)
        .agg(F.min(load_key).alias(load_key))
        .where(F.col(load_key) != "")
    )
    return join_one_per_key(batch, first, (*KEY, load_key), "left_semi")


def append(batch: DataFrame, path: str) -> None:
    """Append by name; columns the batch lacks become NULL, extra ones are refused."""
    extra = set(batch.columns) - set(RAW_NEWS.names) - {"load_key"}
    if extra:
        raise ValueError(f"columns not in bronze: {', '.join(sorted(extra))}")
    aligned = batch.select(
        *[
            (F.col(f.name) if f.name in batch.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in RAW_NEWS.fields
        ]
    )
    (
        aligned.hint("rebalance", "published_date")
        .write.mode("append")
        .partitionBy("published_date")
        .parquet(path)
    )


def dates_of(batch: DataFrame, bronze: DataFrame) -> DataFrame:
    """Bronze restricted to the dates of ``batch``, so other partitions are not read.

    The dates are collected (there are as many as the calendar has days) and reach the scan
    as a partition filter; a straggler far from the rest does not open the span between.
    """
    dates = [r[0] for r in batch.select("published_date").distinct().collect()]
    return bronze.where(F.col("published_date").isin(dates)) if dates else bronze.where(F.lit(False))


def ingest(spark: SparkSession, batch: DataFrame, path: str, cache: bool = True) -> None:
    """Load a stamped batch into the bronze table at ``path``; repeating it changes nothing.

    The dates, the keys and the rows of the batch are all needed, but its files are parsed
    once: a daily batch is cached, a backfill (``cache=False``) is staged as Parquet below
    ``spark.checkpoint.dir`` and the stage is deleted afterwards.
    """
    stage = None
    if cache:
        batch = batch.persist()
    else:
        stage = scratch_path(spark, "stage")
        batch.write.parquet(stage)
        batch = spark.read.schema(batch.schema).parquet(stage)
    try:
        bronze = dates_of(batch, read_bronze(spark, path))
        append(unseen(batch, bronze), path)
    finally:
        if cache:
            batch.unpersist()
        else:
            discard(spark, stage)
