"""From archived pages and sitemaps to a day's landing files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsrisk.schema import ARTICLE_COLUMNS
from newsrisk.session import discard, scratch_path
from newsrisk.sources.articles import write_landing
from newsrisk.sources.listing import accepted, listing_items, parse_listing, rejects
from newsrisk.sources.sitemap import sitemap_articles, sitemap_rejects, sitemap_urls

REJECT_COLUMNS = ("source", "origin", "reason", "title", "link")


def _order(df: DataFrame, origin: int, place: str) -> F.Column:
    """(origin, seq, place) as one long: 1 bit, 38 bits, 24 bits."""
    seq = F.col("seq").cast("long") if "seq" in df.columns else F.lit(0).cast("long")
    return F.lit(origin << 62) + F.shiftleft(seq, 24) + F.coalesce(F.col(place).cast("long"), F.lit(0))


def extract(
    spark: SparkSession,
    target: dt.date | str,
    landing: str,
    reject_path: str,
    pages: DataFrame | None = None,
    sitemaps: DataFrame | None = None,
    as_of: dt.date | str | None = None,
) -> None:
    """Write the articles of ``target`` to ``landing`` and what cannot be one to ``reject_path``.

    ``pages`` has ``source``, ``category``, ``layout``, ``html`` and, if pages were fetched on
    different days, ``fetched_on`` (default: ``as_of``, or the day after ``target``).  ``sitemaps`` has ``source``,
    ``category`` and ``xml``.  Both may have ``seq``, the order in which they were fetched.
    Every page and document is parsed once and its result stored while articles and rejects are
    taken from it.  A link that occurs again keeps its last occurrence: by ``seq``, then by place
    on the page or in the document; sitemaps come after pages.  The order is carried as columns,
    so it does not depend on files or partitions; without ``seq``, occurrences on different pages
    tie and one of them is kept.
    """
    found: list[DataFrame] = []
    refused: list[DataFrame] = []
    stages: list[str] = []

    def once(df: DataFrame) -> DataFrame:
        stages.append(scratch_path(spark, "extract"))
        df.write.parquet(stages[-1])
        return spark.read.schema(df.schema).parquet(stages[-1])

    def reject_rows(df: DataFrame, origin: str) -> DataFrame:
        title = F.col("title") if "title" in df.columns else F.col("news_title")
        link = F.col("link") if "link" in df.columns else F.col("loc")
        return df.select("source", F.lit(origin).alias("origin"), "reason", title.alias("title"), link.alias("link"))

    day = F.lit(str(target)).cast("date")
    try:
        if pages is not None:
            fetched = F.lit(str(as_of)).cast("date") if as_of else F.date_add(day, 1)
            if "fetched_on" in pages.columns:
                fetched = F.coalesce(F.col("fetched_on").cast("date"), fetched)
            items = once(listing_items(parse_listing(pages, fetched, day)))
            found.append(accepted(items).withColumn("_order", _order(items, 0, "pos")))
            refused.append(reject_rows(rejects(items), "page"))
        if sitemaps is not None:
            urls = once(sitemap_urls(sitemaps, "xml"))
            found.append(sitemap_articles(urls, day).withColumn("_order", _order(urls, 1, "position")))
            refused.append(reject_rows(sitemap_rejects(urls), "sitemap"))
        if not found:
            raise ValueError("give pages or sitemaps")
        articles, broken = found[0].select(*ARTICLE_COLUMNS, "_order"), refused[0]
        for more, bad in zip(found[1:], refused[1:], strict=True):
            articles = articles.unionByName(more.select(*ARTICLE_COLUMNS, "_order"))
            broken = broken.unionByName(bad)
        ordered = articles.withColumns({"published_date": day, "ingest_seq": F.col("_order")}).drop("_order")
        write_landing(ordered, landing, order="ingest_seq")
        broken.select(*REJECT_COLUMNS).hint("rebalance").write.mode("overwrite").parquet(reject_path)
    finally:
        discard(spark, *stages)
