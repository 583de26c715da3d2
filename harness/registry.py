"""Every operator of the package as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from harness import adapters as A
from newsrisk.functions.dates import (
    iso_date,
    long_date,
    relative_date,
    stringify_dates,
)
from newsrisk.functions.lexicon import RISK_RULES, Clause, KeywordRule
from newsrisk.functions.match import any_keyword, flag, relevance, rule_flag, whole_word
from newsrisk.functions.text import slug_title
from newsrisk.operators.dedup import (
    duplicates_removed,
    last_occurrence,
    latest_per_link,
    prefix_cut,
)
from newsrisk.operators.quality import article_checks, daily_checks
from newsrisk.operators.stats import page_stats, scrape_stats
from newsrisk.operators.union import union_sources
from newsrisk.operators.upsert import apply_upsert, export_rows, export_spec, plan_upsert
from newsrisk.plans import incremental as inc
from newsrisk.plans.marts import (
    audit_mart,
    daily_counts,
    daily_mart,
    monthly_mart,
    newest_first,
    recover_counts,
    weekly_mart,
    with_flags,
)
from newsrisk.plans.publish import build_marts, staging_view
from newsrisk.plans.staging import clean, staging
from newsrisk.schema import ARTICLE_COLUMNS, COUNT_COLUMNS, INDEX_COLUMNS
from newsrisk.session import scratch_path, spread
from newsrisk.sources.articles import read_articles, read_day, stamp_batch, write_landing
from newsrisk.sources.bronze import append, create_bronze, ingest, read_bronze, unseen
from newsrisk.sources.listing import (
    ListingLayout,
    accepted,
    listing_items,
    parse_listing,
    rejects,
)
from newsrisk.sources.sitemap import read_sitemaps, sitemap_articles, sitemap_rejects, sitemap_urls
from newsrisk.streaming.ingest import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# ---- silver ----------------------------------------------------------------------------


@query("staging_clean")
def q_staging_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean(A.raw_news(spark, sf))


@query("staging_dedup")
def q_staging_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_link(A.raw_news(spark, sf)).drop("date_text")


@query("dedup_last_wins")
def q_dedup_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return last_occurrence(A.event_articles(spark, sf))


@query("dedup_stats")
def q_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates_removed(A.event_articles(spark, sf))


@query("staging")
def q_staging_news(spark: SparkSession, sf: str) -> DataFrame:
    return staging(A.raw_news(spark, sf))


@query("staging_view")
def q_staging_view(spark: SparkSession, sf: str) -> DataFrame:
    staging_view(A.raw_news(spark, sf), "stg_news")
    return spark.sql(
        "SELECT category, count(*) AS articles, sum(is_relevant) AS relevant "
        "FROM stg_news GROUP BY category"
    )


@query("relevance_flag")
def q_relevance_flag(spark: SparkSession, sf: str) -> DataFrame:
    news = clean(A.raw_news(spark, sf))
    return news.select("ingest_seq", relevance("title_cleaned").alias("is_relevant"))


@query("risk_flags")
def q_risk_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = with_flags(clean(A.raw_news(spark, sf)))
    return flagged.select("ingest_seq", *[f"is_{r.name}" for r in RISK_RULES])


# ---- keyword rules on long text --------------------------------------------------------

DOCUMENT_KEYWORDS = ("erth", "ction", "teror", "nato", "straße", "éaux", "&")
DOCUMENT_RULE = KeywordRule(
    "mixed",
    (
        Clause(("ation", "heren"), requires=("ing", "ción"), excludes=("the of the",)),
        Clause(("license",)),
    ),
)


@query("keyword_match")
def q_keyword_match(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(A.table(spark, sf, "documents")).withColumn("t", F.lower("text"))
    hit = any_keyword("t", DOCUMENT_KEYWORDS)
    return docs.select("doc_id", "lang", flag(hit).alias("is_match"))


@query("word_match")
def q_word_match(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(A.table(spark, sf, "documents")).withColumn("t", F.lower("text"))
    return docs.select(
        "doc_id",
        flag(whole_word("t", "as")).alias("has_as"),
        flag(whole_word("t", "the")).alias("has_the"),
    )


@query("keyword_filter")
def q_keyword_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = A.table(spark, sf, "documents").withColumn("t", F.lower("text"))
    return docs.where(any_keyword("t", DOCUMENT_KEYWORDS)).groupBy("lang").agg(F.count(F.lit(1)).alias("documents"))


@query("document_rule")
def q_document_rule(spark: SparkSession, sf: str) -> DataFrame:
    text = F.lower(F.concat_ws(" ", "text", A.headline("doc_id")))
    docs = spread(A.table(spark, sf, "documents")).withColumn("t", text)
    return docs.select(
        "doc_id",
        relevance("t").alias("is_relevant"),
        rule_flag("t", DOCUMENT_RULE).alias("is_mixed"),
        *[rule_flag("t", r).alias(f"is_{r.name}") for r in RISK_RULES],
    )


# ---- gold ------------------------------------------------------------------------------


@query("daily_counts")
def q_daily_count_table(spark: SparkSession, sf: str) -> DataFrame:
    return daily_counts(staging(A.raw_news(spark, sf)))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_mart(staging(A.raw_news(spark, sf)))


@query("daily_mart")
def q_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf)


@query("weekly_mart")
def q_weekly(spark: SparkSession, sf: str) -> DataFrame:
    return weekly_mart(_daily(spark, sf)).orderBy("week_start")


@query("monthly_mart")
def q_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return monthly_mart(_daily(spark, sf)).orderBy("month_start")


@query("weekly_from_percentages")
def q_weekly_from_percentages(spark: SparkSession, sf: str) -> DataFrame:
    return weekly_mart(recover_counts(_daily(spark, sf).drop(*COUNT_COLUMNS))).orderBy("week_start")


@query("recovered_counts")
def q_recovered_counts(spark: SparkSession, sf: str) -> DataFrame:
    stored = _daily(spark, sf).select("published_date", "total_articles", *INDEX_COLUMNS)
    return recover_counts(stored).select("published_date", *COUNT_COLUMNS)


@query("audit_mart")
def q_audit(spark: SparkSession, sf: str) -> DataFrame:
    return newest_first(audit_mart(staging(A.raw_news(spark, sf))))


# ---- incremental -----------------------------------------------------------------------


def _history(bronze: DataFrame) -> DataFrame:
    """What had been loaded before the latest year's load."""
    return bronze.where(F.col("published_date") < F.lit("2001-01-01").cast("date"))


def _late_source(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two sources already loaded, and a third that arrives late for all dates."""
    return bronze.where(F.col("source") != "P"), bronze.where(F.col("source") == "P")


@query("incremental_daily")
def q_incremental_daily(spark: SparkSession, sf: str) -> DataFrame:
    bronze, path = A.raw_news(spark, sf), scratch_path(spark, "daily")
    inc.full_refresh(_history(bronze), path)
    inc.refresh_watermark(spark, bronze, path)
    return inc.read_daily(spark, path)


@query("incremental_late")
def q_incremental_late(spark: SparkSession, sf: str) -> DataFrame:
    bronze, path = A.raw_news(spark, sf), scratch_path(spark, "daily")
    inc.full_refresh(_late_source(bronze)[0], path)
    inc.refresh_watermark(spark, bronze, path)
    return inc.read_daily(spark, path)


@query("incremental_affected")
def q_incremental_affected(spark: SparkSession, sf: str) -> DataFrame:
    bronze, path = A.raw_news(spark, sf), scratch_path(spark, "daily")
    stored, batch = _late_source(bronze)
    inc.full_refresh(stored, path)
    inc.refresh_affected(spark, bronze, batch, path)
    return inc.read_daily(spark, path)


@query("mart_watermark")
def q_mart_watermark(spark: SparkSession, sf: str) -> DataFrame:
    stored = _daily(spark, sf)
    return stored.agg(
        F.coalesce(F.max("published_date"), F.lit(inc.EPOCH)).alias("watermark")
    )


@query("mart_build")
def q_mart_build(spark: SparkSession, sf: str) -> DataFrame:
    """All tables built and stored, and all of them read back."""
    root = scratch_path(spark, "marts")
    build_marts(spark, A.raw_news(spark, sf), root)
    return _stored_marts(spark, root)


def _stored_marts(spark: SparkSession, root: str) -> DataFrame:
    daily = inc.read_daily(spark, f"{root}/daily")
    part = lambda name, df, key, what: df.select(
        F.lit(name).alias("mart"), F.col(key).cast("string").alias("key"), *what
    )
    numbers = [F.col("total_articles"), *[F.col(c) for c in (*INDEX_COLUMNS, "total_index")], F.lit(None).cast("string").alias("link")]
    flags = [F.lit(1).cast("long"), *[F.col(f"is_{r.name}").cast("double") for r in RISK_RULES], F.lit(None).cast("double"), F.col("link")]
    tables = [part("daily", daily, "published_date", numbers)]
    for period in ("week", "month"):
        mart = spark.read.parquet(f"{root}/{period}ly")
        tables.append(part(f"{period}ly", mart, f"{period}_start", numbers))
    tables.append(part("audit", spark.read.parquet(f"{root}/audit"), "published_date", flags))
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out


@query("mart_build_incremental")
def q_mart_build_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """History built first, then all of bronze incrementally: the tables of a full build, as
    no article arrives for an older date."""
    root, bronze = scratch_path(spark, "marts"), A.raw_news(spark, sf)
    recent = bronze.where(F.col("published_date") >= F.lit("1998-01-01").cast("date"))
    fresh = recent.withColumn("link", F.concat(F.lit("new/"), "link"))
    older = bronze.where(F.col("published_date") < F.lit("1998-01-01").cast("date"))
    build_marts(spark, older, root)
    build_marts(spark, older.unionByName(fresh), root, incremental=True)
    return _stored_marts(spark, root)


# ---- export ----------------------------------------------------------------------------


def _delivered_earlier(spark: SparkSession, sf: str) -> DataFrame:
    """The target as an earlier run left it: text dates, totals as text, one source missing."""
    earlier, _ = _late_source(_history(A.raw_news(spark, sf)))
    return stringify_dates(daily_mart(staging(earlier))).withColumn(
        "total_articles", F.col("total_articles").cast("string")
    )


@query("export_upsert")
def q_export_plan(spark: SparkSession, sf: str) -> DataFrame:
    return plan_upsert(
        _daily(spark, sf), _delivered_earlier(spark, sf), export_spec("daily")
    ).orderBy("published_date")


@query("export_snapshot")
def q_export_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    target = _delivered_earlier(spark, sf).withColumn(
        "total_articles", F.col("total_articles").cast("bigint")
    )
    return apply_upsert(_daily(spark, sf), target, export_spec("daily"))


@query("export_rows_addressed")
def q_export_rows_addressed(spark: SparkSession, sf: str) -> DataFrame:
    """A target with row numbers that lists some days twice: the last row is the one to update."""
    earlier = _delivered_earlier(spark, sf)
    day = F.datediff(F.col("published_date").cast("date"), F.lit("1992-01-01").cast("date"))
    first = earlier.withColumn("sheet_row", day * 2)
    again = first.where(F.pmod("sheet_row", F.lit(3)) == 0).withColumns(
        {"sheet_row": F.col("sheet_row") + 1, "total_articles": F.lit("7")}
    )
    spec = replace(export_spec("daily"), row_column="sheet_row")
    plan = plan_upsert(_daily(spark, sf), first.unionByName(again), spec)
    return plan.select("published_date", "total_articles", F.col("target_row").cast("bigint"), "action")


@query("stringify_dates")
def q_stringified_dates(spark: SparkSession, sf: str) -> DataFrame:
    return stringify_dates(weekly_mart(_daily(spark, sf)))


@query("exported_rows")
def q_exported_rows(spark: SparkSession, sf: str) -> DataFrame:
    return export_rows(_daily(spark, sf), "published_date")


# ---- ingest ----------------------------------------------------------------------------


@query("ingest_anti_join")
def q_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments reported again: orders whose link and date bronze already has are dropped."""
    lineitem = A.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("published_date"),
        F.concat(
            F.lit("https://news.example/"), (F.col("l_suppkey") % 50).cast("string")
        ).alias("link"),
    )
    orders = A.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ingest_seq"),
        F.col("o_orderdate").cast("date").alias("published_date"),
        F.concat(
            F.lit("https://news.example/"), (F.col("o_custkey") % 50).cast("string")
        ).alias("link"),
    )
    return unseen(orders, lineitem)


@query("ingest_articles")
def q_ingest_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Files written per day, read back, loaded twice: the second load adds nothing."""
    landing, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    write_landing(A.event_articles(spark, sf), landing)
    batch = read_articles(spark, landing, as_of=A.FETCHED)
    ingest(spark, batch, bronze)
    ingest(spark, batch, bronze)
    return read_bronze(spark, bronze).drop("ingest_seq")


@query("landing_overwrite")
def q_landing_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A day is scraped twice; the second file replaces the first, links deduplicated."""
    landing = scratch_path(spark, "landing")
    news = A.event_articles(spark, sf)
    write_landing(news, landing)
    write_landing(news, landing, order="ingest_seq")
    return read_articles(spark, landing, as_of=A.FETCHED).select(
        *ARTICLE_COLUMNS, "published_date"
    )


@query("landing_round_trip")
def q_landing_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Files written per day and read with the defaults: all days, and the first day alone."""
    landing, news = scratch_path(spark, "landing"), A.event_articles(spark, sf)
    write_landing(news, landing)
    first = news.agg(F.min("published_date")).first()[0]
    every = read_articles(spark, landing, as_of=A.FETCHED).withColumn("scope", F.lit("all"))
    day = read_day(spark, landing, first).withColumn("scope", F.lit("day"))
    return every.unionByName(day).select("scope", *ARTICLE_COLUMNS, "published_date")


@query("array_files")
def q_array_files(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON array a day, read back in byte ranges; ``place`` is the order within the file."""
    landing, news = scratch_path(spark, "arrays"), A.tricky_articles(spark, sf)
    A.write_array_files(news, landing)
    read = read_articles(spark, landing, as_of=A.FETCHED, format="array", pattern="*.txt")
    place = F.row_number().over(Window.partitionBy("published_date").orderBy("ingest_seq"))
    return read.select(*ARTICLE_COLUMNS, "published_date", place.cast("long").alias("place"))


@query("stamp_files")
def q_stamp_files(spark: SparkSession, sf: str) -> DataFrame:
    """Dates from file names, from folders, and neither; files in the order they load."""
    o = A.table(spark, sf, "orders")
    day, k = F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"), F.col("o_orderkey") % 3
    name = F.when(k == 0, F.concat(F.lit("scrape_"), day, F.lit(".json"))).otherwise(F.lit("part-0.json"))
    folder = F.when(k == 1, F.concat(F.lit("/in/published_date="), day, F.lit("/"))).otherwise(F.lit("/in/"))
    files = o.select(
        *[F.col("o_orderkey").cast("string").alias(c) for c in ARTICLE_COLUMNS],
        name.alias("file_name"),
        F.concat(folder, name).alias("file_path"),
    )
    return stamp_batch(files, A.FETCHED).select("link", "published_date", "load_key")


@query("bronze_catalog")
def q_bronze_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze as a partitioned catalog table, loaded through its location."""
    path = scratch_path(spark, "bronze")
    name = f"raw_news_{path.rsplit('-', 1)[1]}"
    create_bronze(spark, name, path)
    append(A.event_articles(spark, sf), path)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


@query("bronze_append")
def q_bronze_append(spark: SparkSession, sf: str) -> DataFrame:
    """Append by name: a batch without a column gets NULLs there."""
    path = scratch_path(spark, "bronze")
    append(A.event_articles(spark, sf).drop("category"), path)
    return read_bronze(spark, path)


@query("stream_ingest")
def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The same files as a stream that is started a second time with nothing new."""
    landing, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    checkpoint = scratch_path(spark, "stream")
    write_landing(A.event_articles(spark, sf), landing)
    for _ in range(2):
        start_ingest(
            spark, landing, bronze, checkpoint, as_of=A.FETCHED
        ).awaitTermination()
    return read_bronze(spark, bronze).drop("ingest_seq")


@query("union_sources")
def q_source_union(spark: SparkSession, sf: str) -> DataFrame:
    return union_sources(A.directory_sources(spark, sf))


@query("scrape_stats")
def q_source_stats(spark: SparkSession, sf: str) -> DataFrame:
    return scrape_stats(union_sources(A.directory_sources(spark, sf)))


# ---- dates and titles ------------------------------------------------------------------


@query("parse_relative_date")
def q_parse_relative_date(spark: SparkSession, sf: str) -> DataFrame:
    o = spread(A.table(spark, sf, "orders"))
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("9 menit lalu"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(" Kemarin 15:37"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", A.indonesian_date(day))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", day.cast("string"))
        .when(key % 2 == 0, F.translate(F.concat(A.indonesian_date(day), F.lit(" pagi")), " ", "\xa0"))
        .otherwise(F.concat(F.lit("31 "), F.date_format(day, "MMMM"), F.lit(" 1999")))
    )
    return o.select(key, relative_date(text, F.lit(A.FETCHED)).alias("parsed"))


@query("parse_long_date")
def q_parse_long_date(spark: SparkSession, sf: str) -> DataFrame:
    o = spread(A.table(spark, sf, "orders"))
    text = F.concat(
        F.lit("Sabtu, "),
        A.indonesian_date(F.col("o_orderdate").cast("date")),
        F.lit(" 10:37 WIB"),
    )
    k = F.col("o_orderkey") % 4
    text = F.when(k == 1, F.translate(text, " ", "\u2003")).when(
        k == 2, F.regexp_replace(text, r"(\d{4}) 10", "$10 10")
    ).when(k == 3, F.regexp_replace(text, r", \d+ [A-Za-z]+ ", ", 31 Februari ")).otherwise(text)
    return o.select("o_orderkey", long_date(text).alias("parsed"))


@query("parse_iso_date")
def q_parse_iso_date(spark: SparkSession, sf: str) -> DataFrame:
    e = spread(A.table(spark, sf, "events"))
    text = (
        F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd HH:mm 'Z'"))
        .when(F.col("event_type") == "error", F.date_format("ts", "d MMMM yyyy"))
        .when(F.col("event_type") == "signup", F.date_format("ts", "MMMM d, yyyy"))
        .otherwise(F.col("props"))
    )
    return e.select("event_id", iso_date(text).alias("parsed"))


@query("slug_title")
def q_slug_titles(spark: SparkSession, sf: str) -> DataFrame:
    p = A.table(spark, sf, "part")
    url = F.concat(
        F.lit("https://news.example/politik/"),
        F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")),
        F.lit("-"),
        F.col("p_partkey").cast("string"),
        F.lit("?page=2"),
    )
    return p.select("p_partkey", slug_title(url).alias("title"))


@query("page_slugs")
def q_page_slugs(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "pages").select("page_id", slug_title("url").alias("title"))


# ---- extraction ------------------------------------------------------------------------


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    pages = A.listing_pages(spark, sf)
    return parse_listing(
        pages, as_of=F.col("fetched_on"), target=F.date_sub(F.col("fetched_on"), 1)
    )


@query("extract_listing")
def q_extract_listing(spark: SparkSession, sf: str) -> DataFrame:
    return accepted(listing_items(_listing(spark, sf))).select(
        "page_id", "pos", *ARTICLE_COLUMNS, "article_date"
    )


@query("extract_rejects")
def q_extract_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return rejects(listing_items(_listing(spark, sf))).select(
        "source", "page_id", "pos", "reason"
    )


@query("extract_pages")
def q_extract_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _listing(spark, sf).select(
        "source", "page_id", "has_more", "oldest_date", "found_any", "stopped"
    )


@query("page_stats")
def q_listing_page_stats(spark: SparkSession, sf: str) -> DataFrame:
    items = listing_items(_listing(spark, sf))
    return page_stats(items, ["source", "page_id"])


NAVIGATION = {"navigation": ListingLayout(item=("nav li",), title=("a[href]",))}


@query("extract_navigation")
def q_extract_navigation(spark: SparkSession, sf: str) -> DataFrame:
    """A layout of one's own over the raw web pages."""
    pages = spread(A.table(spark, sf, "pages")).withColumn("layout", F.lit("navigation"))
    parsed = parse_listing(pages, A.FETCHED, A.FETCHED, NAVIGATION)
    return accepted(listing_items(parsed, NAVIGATION)).select(
        "page_id", "pos", "title", "link"
    )


@query("extract_sitemap")
def q_extract_sitemap(spark: SparkSession, sf: str) -> DataFrame:
    urls = sitemap_urls(A.sitemaps(spark, sf), "xml")
    return sitemap_articles(urls, F.col("target_date")).select(
        "doc_id", "title", "link", "category", "date_text"
    )


@query("sitemap_files")
def q_sitemap_files(spark: SparkSession, sf: str) -> DataFrame:
    """The sitemap documents written as four large files, read back in byte ranges."""
    folder = scratch_path(spark, "sitemaps")
    A.sitemaps(spark, sf).select("xml").repartition(4).write.text(folder)
    urls = read_sitemaps(spark, folder)
    return urls.select(
        F.nullif(F.trim("loc"), F.lit("")).alias("loc"),
        F.substring("lastmod", 1, 10).alias("day"),
        F.trim("news_title").alias("news_title"),
        "reason",
    )


@query("sitemap_rejects")
def q_sitemap_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Every entry of broken sitemaps: an article, one of another date, or a reject."""
    urls = sitemap_urls(A.broken_sitemaps(spark, sf), "xml")
    articles = sitemap_articles(urls, F.col("target_date")).select(
        "doc_id", F.lit("article").alias("outcome"), "link"
    )
    return articles.unionByName(
        sitemap_rejects(urls).select("doc_id", F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("link"))
    )


@query("prefix_cut")
def q_newest_first_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a customer read like a page, in key order, until the first before 1996."""
    items = A.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("article_date")
    )
    return prefix_cut(items, ["o_custkey"], "o_orderkey", "article_date", "1996-01-01")


# ---- data quality ----------------------------------------------------------------------


@query("dq_checks")
def q_dq_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_checks(_daily(spark, sf))


@query("dq_articles")
def q_dq_articles(spark: SparkSession, sf: str) -> DataFrame:
    news = A.raw_news(spark, sf)
    return article_checks(news, required=ARTICLE_COLUMNS, source=("F", "O"))
