"""Gold: daily, weekly, monthly indices and the article audit trail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from newsrisk.functions.lexicon import COMPONENTS, RISK_RULES, KeywordRule
from newsrisk.functions.match import risk_flags, rule_sql
from newsrisk.functions.ratios import index_columns
from newsrisk.schema import COUNT_COLUMNS


TEXT = "_text"


def _matchable(staged: DataFrame) -> DataFrame:
    # Without NULLs the generated code of the rules is almost halved.  That matters: the JVM
    # does not compile methods above 8,000 bytes of bytecode, it interprets them.
    return staged.withColumn(TEXT, F.expr("coalesce(title_cleaned, '')"))


def with_flags(staged: DataFrame, rules: Sequence[KeywordRule] = RISK_RULES) -> DataFrame:
    """Add the five ``is_*`` flags."""
    return _matchable(staged).withColumns(risk_flags(TEXT, rules)).drop(TEXT)


def daily_counts(staged: DataFrame, rules: Sequence[KeywordRule] = RISK_RULES) -> DataFrame:
    """Relevant articles and flagged relevant articles per day.

    Relevance is tested first in each condition, so the keyword lists are only searched for
    rows that can count.  Days without a relevant article keep their row.
    """
    return _matchable(staged).groupBy("published_date").agg(
        F.expr("count_if(is_relevant = 1)").alias("total_articles"),
        *[
            F.expr(f"count_if(is_relevant = 1 AND ({rule_sql(TEXT, rule)}))").alias(
                f"count_{rule.name}"
            )
            for rule in rules
        ],
    )


def daily_mart(staged: DataFrame, rules: Sequence[KeywordRule] = RISK_RULES) -> DataFrame:
    """One row per day: counts, component indices, composite indices."""
    return daily_counts(staged, rules).select(
        "published_date", "total_articles", *COUNT_COLUMNS, *index_columns()
    )


def recover_counts(daily: DataFrame) -> DataFrame:
    """Counts from a daily mart that stores percentages only.

    Exact while a day has fewer than one million articles; our own mart stores the counts.
    """
    return daily.withColumns(
        {
            f"count_{c}": F.expr(f"CAST(round(idx_{c} * total_articles / 100D) AS BIGINT)")
            for c in COMPONENTS
        }
    )


def _rollup(daily: DataFrame, period: str) -> DataFrame:
    # Works on one row per day, so this is small whatever the size of bronze.  Counts are
    # summed before dividing; averaging daily percentages would weight thin days too much.
    if missing := sorted(set(COUNT_COLUMNS) - set(daily.columns)):
        raise ValueError(f"no counts to sum ({', '.join(missing)}); see recover_counts")
    start = f"{period}_start"
    return (
        daily.groupBy(F.trunc("published_date", period).alias(start))
        .agg(
            F.min("published_date").alias(f"first_day_in_{period}"),
            F.max("published_date").alias(f"last_day_in_{period}"),
            # Exact, at most 31 elements, and no second shuffle as COUNT(DISTINCT) needs.
            F.size(F.collect_set("published_date")).cast("bigint").alias("days_with_data"),
            F.sum("total_articles").alias("total_articles"),
            *[F.sum(c).alias(c) for c in COUNT_COLUMNS],
        )
        .select(
            start,
            f"first_day_in_{period}",
            f"last_day_in_{period}",
            "days_with_data",
            "total_articles",
            *index_columns(),
        )
    )


def weekly_mart(daily: DataFrame) -> DataFrame:
    """Rollup to weeks starting on Monday."""
    return _rollup(daily, "week")


def monthly_mart(daily: DataFrame) -> DataFrame:
    """Rollup to calendar months."""
    return _rollup(daily, "month")


def audit_mart(staged: DataFrame, rules: Sequence[KeywordRule] = RISK_RULES) -> DataFrame:
    """Every relevant article with its flags: the evidence behind each index value."""
    relevant = staged.where(F.col("is_relevant") == 1)
    return with_flags(relevant, rules).select(
        "published_date",
        "source",
        "category",
        "link",
        "title",
        "title_cleaned",
        *[f"is_{rule.name}" for rule in rules],
    )


def newest_first(audit: DataFrame) -> DataFrame:
    """Presentation order of the audit trail.

    The link is a second sort key so that one busy day still spreads over several ranges.
    """
    return audit.orderBy(F.desc("published_date"), "link")
