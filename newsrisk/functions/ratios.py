"""Ratio indices: counts are summed first and divided once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from newsrisk.functions.lexicon import COMPONENTS, COMPOSITES


def percentage(counts: Sequence[str], total: str) -> Column:
    """The sum of ``counts`` as a percentage of ``total``, four decimals; NULL for no total.

    Both sides are doubles: the same text on integers and a decimal literal would give a
    DECIMAL in Spark.
    """
    return F.expr(
        f"round(CAST({' + '.join(counts)} AS DOUBLE) * 100D "
        f"/ nullif(CAST({total} AS DOUBLE), 0D), 4)"
    )


def index_columns(total: str = "total_articles") -> list[Column]:
    """The component and composite indices over ``count_*`` columns."""
    indices = {f"idx_{c}": (c,) for c in COMPONENTS} | COMPOSITES
    return [
        percentage([f"count_{p}" for p in parts], total).alias(name)
        for name, parts in indices.items()
    ]
