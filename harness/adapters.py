"""The given tables seen as news data: one expression each, mirrored in ``harness/oracle.py``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from newsrisk.functions.dates import INDONESIAN_MONTHS
from newsrisk.session import spread

# The headline each row gets, by key.  They cover every branch of the rules.
HEADLINES = (
    "Indonesia dan Malaysia bahas sengketa perbatasan",
    "Indonesia tawarkan solusi konflik Gaza",
    "Perundingan Indonesia dan Israel gagal",
    "Diplomasi Indonesia di ASEAN berjalan baik",
    "TNI gelar latihan bersama Amerika",
    "WNI ditangkap tentara Israel",
    "Serangan di Gaza, WNI selamat",
    "Korban gempa Turki, KBRI kirim bantuan",
    "Korban konflik Ukraina dibantu Indonesia",
    "Terorisme lintas batas dibahas Indonesia dan Filipina",
    "Menteri luar negeri bertemu delegasi AS",
    "Kasus biasa di Indonesia",
    "Harga emas naik 2026",
    None,
    "",
    "KRISIS UKRAINA: KEDUTAAN INDONESIA SIAGA",
    "Kirana Indonesia raih gelar juara",
    "Bombastis: film Indonesia di China",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def headline(key: str) -> Column:
    titles = ", ".join("NULL" if h is None else f"'{h}'" for h in HEADLINES)
    return F.expr(f"element_at(array({titles}), CAST({key} % {len(HEADLINES)} + 1 AS INT))")


def raw_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as bronze: about half of the links occur on several dates."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        headline("o_orderkey").alias("title"),
        F.concat(
            F.lit("https://news.example/"),
            F.col("o_custkey").cast("string"),
            F.lit("/"),
            (F.col("o_orderkey") % 5).cast("string"),
        ).alias("link"),
        F.col("o_orderpriority").alias("category"),
        F.lit("").alias("date_text"),
        F.col("o_orderstatus").alias("source"),
        F.col("o_orderkey").alias("ingest_seq"),
        F.col("o_orderdate").cast("date").alias("published_date"),
    )


def event_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as scraped articles of thirty days; links repeat within a day."""
    e = table(spark, sf_dir, "events")
    return e.select(
        headline("event_id").alias("title"),
        F.concat(
            F.lit("https://news.example/"),
            F.col("event_type"),
            F.lit("/"),
            F.col("user_id").cast("string"),
        ).alias("link"),
        F.col("event_type").alias("category"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_text"),
        F.lit("events").alias("source"),
        F.col("event_id").alias("ingest_seq"),
        F.col("ts").cast("date").alias("published_date"),
    )


def directory_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three tables as three sources with categories of their own."""
    def articles(name: str, key: str, title: str, category: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.col(title).alias("title"),
            F.concat(
                F.lit(f"https://{name}.example/"), F.col(key).cast("string")
            ).alias("link"),
            F.col(category).cast("string").alias("category"),
            F.lit("kemarin").alias("date_text"),
        )

    return {
        "customer": articles("customer", "c_custkey", "c_name", "c_mktsegment"),
        "supplier": articles("supplier", "s_suppkey", "s_name", "s_nationkey"),
        "part": articles("part", "p_partkey", "p_name", "p_brand"),
    }


def indonesian_date(date: Column) -> Column:
    """``16 Mei 2026`` for a date."""
    months = F.array(*[F.lit(m.title()) for m in INDONESIAN_MONTHS])
    return F.concat_ws(
        " ",
        F.day(date).cast("string"),
        F.element_at(months, F.month(date)),
        F.year(date).cast("string"),
    )


# ---- archived listing pages, one per row of a table ------------------------------------

FETCHED = "2026-05-20"


def _html(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per layout and customer, built from the row: no table is grouped for it.

    Every page is fetched on a day of its own, so relative dates and the target differ.
    """
    c = spread(table(spark, sf_dir, "customer")).select(
        F.col("c_custkey").alias("page_id"),
        F.col("c_custkey").cast("string").alias("k"),
        F.col("c_name").alias("name"),
        F.date_sub(F.lit(FETCHED).cast("date"), (F.col("c_custkey") % 700).cast("int")).alias(
            "fetched_on"
        ),
        F.col("c_mktsegment").alias("category"),
    )
    k, name, day = F.col("k"), F.col("name"), F.col("fetched_on")
    base = "https://news.example/"
    yesterday, older = F.date_sub(day, 1), F.date_sub(day, 2)

    def post(n: str, date: Column | str) -> list:
        return [
            "<div class='row x'><h2 class='post_title'><a href='", base, k, f"/{n}'>\n ",
            name, f" &amp; {n}</a></h2><span class='text-secondary'> ", date, "</span></div>",
        ]

    post_rows = _html(
        "<main>",
        *post("1", "9 menit lalu"),
        *post("2", "Kemarin 15:37"),
        *post("3", indonesian_date(yesterday)),
        *post("4", "entah kapan"),
        "<div class='row'><h2 class='post_title'>tanpa tautan</h2></div></main>",
    )

    def media(tag: str, heading: str, n: str, href: Column | str) -> list:
        return [
            f"<{tag} class='list-content__item'><{heading} class='media__title'><a href='",
            href, "'>", name, f" {n}</a></{heading}></{tag}>",
        ]

    has_next = F.col("page_id") % 2 == 0
    media_list = F.when(
        has_next,
        _html(
            *media("article", "h3", "1", _html(base, k)),
            *media("article", "h3", "2", ""),
            *media("div", "h3", "3", _html(base, k)),
            "<a class='next' href='?page=2'>Next</a>",
        ),
    ).otherwise(
        _html(
            *media("div", "h4", "1", _html(base, k)),
            "<a class='next' disabled='disabled'>Next</a>",
        )
    )
    linked_cards = _html(
        "<a href='", base, k, "/a'><div class='articleItem-wrap'><h2 class='articleTitle'>",
        name, "</h2><div class='articlePost-date'>", indonesian_date(day), "</div></div></a>",
        "<div class='articleItem-wrap'><h2 class='articleTitle'>", name,
        "<br></h2><p><a name='x'></a><a href='", base, k, "/b'>baca</a></div>",
        "<div class='articleItem-wrap'><h2 class='articleTitle'>", name, "</h2></div>",
    )

    def dated(n: str, date: Column, href: bool = True) -> list:
        return [
            "<li class='ptb15'><h3 class='f16 fbo'><a title=' ", name, f" {n} '",
            *([" href='", base, k, f"/{n}'"] if href else []),
            "><i></i>ikon</a></h3><time class='grey'>Sabtu, ", indonesian_date(date),
            " 10:37 WIB</time></li>",
        ]

    dated_index = _html(
        "<ul>", *dated("1", day), *dated("2", yesterday), *dated("3", yesterday, href=False),
        *dated("4", older), *dated("5", yesterday), "</ul>",
    )
    pages = F.array(
        *[
            F.struct(F.lit(layout).alias("layout"), html.alias("html"))
            for layout, html in (
                ("post_rows", post_rows),
                ("media_list", media_list),
                ("linked_cards", linked_cards),
                ("dated_index", dated_index),
            )
        ]
    )
    return c.select("page_id", "category", "fetched_on", F.inline(pages)).withColumn(
        "source", F.col("layout")
    )


def sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sitemap document per order: a plain entry, a news entry, an old one, an empty one."""
    o = spread(table(spark, sf_dir, "orders")).select(
        F.col("o_orderkey").alias("doc_id"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderdate").cast("date").alias("target_date"),
    )
    k = F.col("doc_id").cast("string")
    day = F.date_format("target_date", "yyyy-MM-dd")
    old = F.date_format(F.date_sub(F.col("target_date"), 1), "yyyy-MM-dd")
    xml = _html(
        "<urlset xmlns:news='n'><url><loc> https://news.example/politik/harga-emas-naik-2026-",
        k, "?ref=", k, " </loc><lastmod>", day, "T20:37:00+07:00</lastmod></url>",
        "<url><loc>https://news.example/", k, "</loc><lastmod>", day,
        " 20:37 Z</lastmod><news:news><news:title> Judul ", k,
        " &amp; lain </news:title></news:news></url>",
        "<url><loc>https://news.example/lama-", k, "</loc><lastmod>", old, "</lastmod></url>",
        "<url><loc></loc><lastmod>", day, "</lastmod></url></urlset>",
    )
    return o.withColumn("xml", xml)


def broken_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order: a bare ``&``, two addresses, none, no date, a cut last entry."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.col("o_orderdate").cast("date").alias("target_date"),
        F.lit("politik").alias("category"),
    )
    k, day = F.col("doc_id").cast("string"), F.date_format("target_date", "yyyy-MM-dd")
    url = lambda *inner: ["<url>", *inner, "</url>"]
    loc = lambda path: ["<loc>https://n.example/", path, k, "</loc>"]
    dated = ["<lastmod>", day, "</lastmod>"]
    xml = _html(
        "<urlset>", *url(*loc("a?x=1&y="), *dated), *url(*loc("b/"), *loc("c/"), *dated),
        *url("<loc></loc>", *dated), *url(*loc("d/"), "<lastmod>soon</lastmod>"),
        "<url>", *loc("e/"), "<lastmo",
    )
    return o.withColumn("xml", F.when(F.col("doc_id") % 5 == 0, F.lit("<html>moved")).otherwise(xml))


#: Every fifth title of ``tricky_articles`` ends so: braces, quotes and backslashes inside a string.
TRICKY = ' {"cut} here\\ and\\"there}} '


def tricky_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_articles`` with every fifth title ending in ``TRICKY``."""
    news = event_articles(spark, sf_dir)
    odd = F.col("ingest_seq") % 5 == 0
    return news.withColumn("title", F.when(odd, F.concat("title", F.lit(TRICKY))).otherwise(F.col("title")))


def write_array_files(articles: DataFrame, path: str) -> None:
    """One JSON array a ``published_date`` folder, an element a line, in ``ingest_seq`` order.

    A writer of test input: each date is written by one task.
    """
    columns = ["title", "link", "category", "date_text", "source"]
    place = F.row_number().over(Window.partitionBy("published_date").orderBy("ingest_seq"))
    size = F.count("*").over(Window.partitionBy("published_date"))
    line = F.concat(
        F.when(place == 1, "[").otherwise(","), F.to_json(F.struct(*columns)), F.when(place == size, "]").otherwise("")
    )
    (
        articles.select("published_date", "ingest_seq", line.alias("value"))
        .sortWithinPartitions("published_date", "ingest_seq")
        .select("published_date", "value")
        .write.partitionBy("published_date")
        .text(path)
    )
