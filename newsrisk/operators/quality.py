"""Data-quality checks: all checks of a table in one pass over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _report(totals: DataFrame, checks: Sequence[tuple[str, str]]) -> DataFrame:
    # totals is a single row with one failing-row count per check.
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("failing_rows"),
        )
        for i, (check, column) in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*rows))).withColumn(
        "passed", F.col("failing_rows") == 0
    )


def table_checks(
    df: DataFrame,
    unique: str,
    not_null: Sequence[str] = (),
    minimum: Mapping[str, float] | None = None,
) -> DataFrame:
    """``unique`` / ``not_null`` / ``accepted_range`` results: check, column, failing_rows, passed.

    One grouping on the unique key counts its copies and carries the row-level failures, so
    a duplicated key is pre-aggregated before the shuffle.  ``unique`` reports the number of
    duplicated non-NULL key values; NULLs do not fail a range.
    """
    minimum = dict(minimum or {})
    checks: list[tuple[str, str]] = [("unique", unique)]
    failures: list[Column] = []
    for column in not_null:
        checks.append(("not_null", column))
        failures.append(F.count_if(F.col(column).isNull()))
    for column, low in minimum.items():
        checks.append(("accepted_range", column))
        failures.append(F.count_if(F.col(column) < F.lit(low)))
    per_key = df.groupBy(unique).agg(
        F.count(F.lit(1)).alias("n"), *[f.alias(f"f{i + 1}") for i, f in enumerate(failures)]
    )
    totals = per_key.agg(
        F.count_if((F.col("n") > 1) & F.col(unique).isNotNull()).alias("c0"),
        *[F.sum(f"f{i + 1}").alias(f"c{i + 1}") for i in range(len(failures))],
    )
    return _report(totals, checks)


def daily_checks(daily: DataFrame) -> DataFrame:
    """The constraints declared on the daily mart."""
    return table_checks(
        daily,
        unique="published_date",
        not_null=("published_date", "total_articles", "total_index"),
        minimum={"total_articles": 1, "total_index": 0.0},
    )


def article_checks(
    articles: DataFrame, required: Sequence[str], source: str | Sequence[str] | None = None
) -> DataFrame:
    """Acceptance of a batch: required fields, known source, absolute links, non-empty.

    A required field fails when it is NULL or blank.  ``source`` names the allowed
    value or values.
    """
    checks: list[tuple[str, str]] = [("not_empty", "*")]
    failures = [F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)]
    for column in required:
        checks.append(("required", column))
        value = F.col(column)
        failures.append(F.count_if(value.isNull() | (F.trim(value) == "")))
    if source is not None:
        allowed = [source] if isinstance(source, str) else list(source)
        checks.append(("accepted_values", "source"))
        failures.append(
            F.count_if(F.col("source").isNull() | ~F.col("source").isin(allowed))
        )
    checks.append(("absolute_link", "link"))
    failures.append(
        F.count_if(F.col("link").isNull() | ~F.col("link").rlike("^https?://"))
    )
    totals = articles.agg(*[f.alias(f"c{i}") for i, f in enumerate(failures)])
    return _report(totals, checks)
