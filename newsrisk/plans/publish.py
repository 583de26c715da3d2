"""Materialising the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsrisk.plans.incremental import (
    full_refresh_from,
    read_daily,
    refresh_watermark_from,
)
from newsrisk.plans.marts import audit_mart, monthly_mart, weekly_mart
from newsrisk.plans.staging import staging


def staging_view(bronze: DataFrame, name: str = "stg_news") -> None:
    """Silver as a view: nothing is stored, every reader sees current bronze."""
    staging(bronze).createOrReplaceTempView(name)


def write_table(df: DataFrame, path: str) -> None:
    """Replace a fully rebuilt table, in files of even size."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def write_audit(audit: DataFrame, path: str) -> None:
    """Replace the audit trail, newest first.

    Ranges over (date, link) sort it without gathering a busy date in one task, and give
    each file a narrow span of dates that readers can skip by statistics.
    """
    order = [F.desc("published_date"), F.col("link")]
    (
        audit.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .parquet(path)
    )


def build_marts(
    spark: SparkSession, bronze: DataFrame, root: str, incremental: bool = False
) -> None:
    """Silver, daily, audit, weekly and monthly tables below ``root``.

    Silver is stored once and read by all that need it, instead of being computed for each.  Weekly and monthly read the small daily mart.  ``incremental`` refreshes the daily
    mart from its latest date on and leaves older dates alone.
    """
    silver = f"{root}/stg_news"
    write_table(staging(bronze), silver)
    staged = spark.read.parquet(silver)
    daily_path = f"{root}/daily"
    if incremental:
        refresh_watermark_from(spark, staged, daily_path)
    else:
        full_refresh_from(staged, daily_path)
    write_audit(audit_mart(staged), f"{root}/audit")
    daily = read_daily(spark, daily_path)
    write_table(weekly_mart(daily), f"{root}/weekly")
    write_table(monthly_mart(daily), f"{root}/monthly")
