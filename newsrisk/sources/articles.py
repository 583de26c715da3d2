"""Dated article files: reading batches, and writing a day.

A landing folder holds JSON in one of two formats.  ``lines``: one object (or one array) per
line; large files are split.  ``array``: each file is one array, which may span lines; a batch
reads such files in byte ranges (``sources.arrays``), a stream reads each file whole.
``write_landing`` writes lines, which is the default everywhere.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming import DataStreamReader

from newsrisk.functions.dates import ISO_DATE, as_date
from newsrisk.operators.dedup import last_occurrence
from newsrisk.schema import ARTICLE, ARTICLE_COLUMNS
from newsrisk.sources.arrays import array_objects

FILE_TEMPLATE = "scrape_{date}.json"
FORMATS = ("lines", "array")

_FAIL = {"mode": "FAILFAST"}
_STRING = r'"(?:[^"\\]|\\.)*+"'


def article_rows(
    reader: DataFrameReader | DataStreamReader, path: str, format: str, strict: bool, pattern: str = "*.json"
) -> DataFrame:
    """The article columns plus the name and path of the file each row came from.

    Batches and streams are read by these same expressions, in one pass: text to objects,
    objects to columns.  Malformed JSON raises, an array file with anything behind its array
    raises, and with ``strict`` so does a field that articles do not have.  Array files read in
    a batch also give ``position``, the place of each object in its file.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if format == "array" and isinstance(reader, DataFrameReader):
        return _parsed(array_objects(reader, path, pattern), strict)
    text = (
        reader.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(path, wholetext=format == "array")
        .select("value", "_metadata.file_name", "_metadata.file_path")
        .where(F.trim("value") != "")
    )
    value = F.ltrim(F.col("value"))
    many = F.from_json(value, "array<string>", _FAIL)
    if format == "array":
        # Articles are flat, so without its strings a file has one pair of brackets.
        one = F.regexp_replace(F.col("value"), _STRING, "").rlike(r"^\s*\[[^\[\]]*\]\s*$")
        objects = F.when(one, many).otherwise(_refuse("not one JSON array: "))
    else:
        objects = F.when(value.startswith("["), many).otherwise(F.array("value"))
    return _parsed(text.select("file_name", "file_path", F.explode(objects).alias("object")), strict)


def _parsed(rows: DataFrame, strict: bool) -> DataFrame:
    """Objects (column ``object``) as article columns; the other columns stay behind them."""
    carried = [c for c in rows.columns if c != "object"]
    if strict:
        known = F.array(*[F.lit(c) for c in ARTICLE_COLUMNS])
        unknown = F.array_except(F.json_object_keys("object"), known)
        bad = F.size(unknown) > 0
        rows = rows.where(
            F.when(bad, _refuse("unknown article fields: ", F.array_join(unknown, ", "), F.lit(" in "))).otherwise(True)
        )
    parsed = rows.withColumn("article", F.from_json("object", ARTICLE, _FAIL))
    return parsed.select("article.*", *carried)


def _refuse(*message: str | Column) -> Column:
    parts = [F.lit(m) if isinstance(m, str) else m for m in message]
    return F.raise_error(F.concat(*parts, "file_name"))


def stamp_batch(articles: DataFrame, as_of: Column | dt.date | str) -> DataFrame:
    """Turn the file of each row into ``published_date``, ``ingest_seq`` and ``load_key``.

    The date is the first ``YYYY-MM-DD`` in the file name, else the value of a
    ``published_date=`` folder, else the day before ``as_of``.  ``load_key`` orders files as
    a backfill loads them: by the date in the name (or the name itself), then by path.
    ``ingest_seq`` increases with the position in the file.
    """
    name, path = F.col("file_name"), F.col("file_path")
    named = F.nullif(F.regexp_extract(name, ISO_DATE, 0), F.lit(""))
    folder = F.nullif(
        F.regexp_extract(path, rf"published_date=({ISO_DATE})/", 1), F.lit("")
    )
    return articles.select(
        *ARTICLE_COLUMNS,
        (F.col("position") if "position" in articles.columns else F.monotonically_increasing_id()).alias("ingest_seq"),
        F.coalesce(
            named.try_cast("date"), folder.try_cast("date"), F.date_sub(as_date(as_of), 1)
        ).alias("published_date"),
        F.concat_ws("|", F.coalesce(named, name), path).alias("load_key"),
    )


def read_articles(
    spark: SparkSession,
    path: str,
    as_of: Column | dt.date | str,
    format: str = "lines",
    strict: bool = True,
    pattern: str = "*.json",
) -> DataFrame:
    """All article files below ``path`` (names matching ``pattern``) in one scan, stamped and typed.

    Missing fields become NULL; malformed JSON raises; ``strict`` also refuses unknown fields.
    """
    return stamp_batch(article_rows(spark.read, path, format, strict, pattern), as_of)


def read_day(
    spark: SparkSession,
    root: str,
    target: dt.date | str | None = None,
    as_of: dt.date | None = None,
    format: str = "lines",
    strict: bool = True,
) -> DataFrame:
    """The articles of one day (default: the day before ``as_of``); empty when there are none.

    These are the files in its ``published_date=`` folder, as ``write_landing`` leaves them,
    and files named ``scrape_<day>.json`` anywhere below ``root``.  Files of other days are
    listed but not read.
    """
    if target is None:
        if as_of is None:
            raise ValueError("give a target date or as_of")
        target = as_of - dt.timedelta(days=1)
    rows = article_rows(spark.read, root, format, strict).where(
        (F.col("file_name") == FILE_TEMPLATE.format(date=target))
        | F.col("file_path").contains(f"/published_date={target}/")
    )
    return stamp_batch(rows, as_of or F.date_add(as_date(target), 1))


def write_landing(articles: DataFrame, path: str, order: str | None = None) -> None:
    """Write articles as JSON lines per ``published_date``, replacing only those dates.

    With ``order`` the batch is first reduced to the last occurrence of each link.  The
    rebalance hint makes files of even size: small dates share a task, a date that holds
    much of the batch is spread over several.
    """
    if order is not None:
        articles = last_occurrence(articles, order=order)
    (
        articles.select(*ARTICLE_COLUMNS, "published_date")
        .hint("rebalance", "published_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("published_date")
        .json(path)
    )
