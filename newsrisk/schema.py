"""Explicit schemas; nothing in the package relies on inference for typed data."""

from __future__ import annotations

from pyspark.sql import types as T

from newsrisk.functions.lexicon import COMPONENTS, COMPOSITES

ARTICLE_COLUMNS = ("title", "link", "category", "date_text", "source")

ARTICLE = T.StructType([T.StructField(c, T.StringType()) for c in ARTICLE_COLUMNS])

# Bronze: articles + the date stamped from the file + the position inside that file.
RAW_NEWS = T.StructType(
    [
        *ARTICLE.fields,
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("published_date", T.DateType()),
    ]
)

COUNT_COLUMNS = tuple(f"count_{c}" for c in COMPONENTS)
INDEX_COLUMNS = tuple(f"idx_{c}" for c in COMPONENTS)
COMPOSITE_COLUMNS = tuple(COMPOSITES)

DAILY = T.StructType(
    [
        T.StructField("published_date", T.DateType()),
        T.StructField("total_articles", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in COUNT_COLUMNS],
        *[T.StructField(c, T.DoubleType()) for c in (*INDEX_COLUMNS, *COMPOSITE_COLUMNS)],
    ]
)
