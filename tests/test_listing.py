import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsrisk.operators.stats import page_stats
from newsrisk.sources.listing import LAYOUTS, accepted, listing_items, parse_listing, rejects
from newsrisk.sources.sitemap import (
    _entries,
    _entry,
    read_sitemaps,
    sitemap_articles,
    sitemap_rejects,
    sitemap_urls,
)

AS_OF = dt.date(2026, 5, 20)


@pytest.fixture()
def extract(rows):
    def run(layout, html, target, as_of=AS_OF):
        pages = rows("source string, layout string, page int, html string", [("s", layout, 1, html)])
        parsed = parse_listing(pages, as_of, target)
        items = listing_items(parsed).orderBy("pos")
        return parsed.drop("items").first(), items

    return run


def brief(items):
    return [(r.title, r.link, r.date_text) for r in accepted(items).collect()]


def reasons(items):
    return [r.reason for r in items.collect()]


def post(title, date, href="https://a.example/1"):
    link = f" href='{href}'" if href is not None else ""
    return (
        f"<div class='row'><h2 class='post_title'><a{link}> {title} </a></h2>"
        f"<span class='text-secondary'>{date}</span></div>"
    )


MIXED = post("Hari ini", "30 menit lalu") + post("Kemarin", "kemarin") + post(
    "Tengah", "15 Mei 2026"
) + post("Lama", "10 Mei 2026")


def test_post_rows_keep_the_target_date(rows):
    targets = {"2026-05-20": ["Hari ini"], "2026-05-19": ["Kemarin"], "2026-05-15": ["Tengah"],
               "2026-05-10": ["Lama"], "2026-05-21": []}
    pages = rows("layout string, target string, html string",
                 [("post_rows", t, MIXED) for t in targets])
    parsed = parse_listing(pages, AS_OF, F.col("target"))
    got = {t: [] for t in targets}
    for r in accepted(listing_items(parsed)).collect():
        got[r.target].append(r.title)
    assert got == targets
    page = parsed.first()
    assert page.oldest_date == dt.date(2026, 5, 10) and page.stopped is False


def test_post_rows_broken_items(extract):
    html = (
        post("Tanpa tautan", "kemarin", href=None)
        + post("Tanggal aneh", "entah kapan")
        + "<div class='row'><h2 class='post_title'><a href='x'>t</a></h2></div>"
        + "<div class='row'><span class='text-secondary'>kemarin</span></div>"
    )
    _, items = extract("post_rows", html, "2026-05-19")
    assert brief(items) == [("Tanpa tautan", "", "kemarin")]
    assert reasons(items) == [None, "bad_date", "missing_date", "missing_title"]
    assert rejects(items).count() == 3


def media(title, href, tag="article", heading="h3"):
    return (
        f"<{tag} class='list-content__item'><{heading} class='media__title'>"
        f"<a href='{href}'>{title}</a></{heading}></{tag}>"
    )


def test_media_list(extract):
    html = media("Satu", "https://d.example/1") + media("Kosong", "") + media("Div", "x", "div")
    page, items = extract("media_list", html, "2026-05-15")
    assert brief(items) == [("Satu", "https://d.example/1", "2026-05-15")]
    assert reasons(items) == [None, "missing_link"]
    assert page.has_more is False


def test_media_list_fallbacks_and_next_page(rows):
    html = media("Satu", "u", "div", "h4")
    cases = {
        "<a class='next' href='?page=2'>Next</a>": True,
        "<li class='pagination__next'><a href='?page=2'>Next</a></li>": True,
        "<a class='next' disabled='disabled'>Next</a>": False,
        "": False,
    }
    pages = rows("layout string, more string, html string",
                 [("media_list", more, html + more) for more in cases])
    parsed = parse_listing(pages, AS_OF, "2026-05-15")
    assert {r.more: r.has_more for r in parsed.collect()} == cases
    assert [r.title for r in accepted(listing_items(parsed)).collect()] == ["Satu"] * 4


def card(title="<h2 class='articleTitle'>Judul</h2>", date="", inside=""):
    return f"<div class='articleItem-wrap'>{title}{date}{inside}</div>"


def test_linked_cards(extract):
    dated = "<div class='articlePost-date'> Rabu, 1 Januari 2025 </div>"
    html = (
        f"<a href='https://k.example/1'>{card(date=dated)}</a>"
        + card(inside="<a name='x'></a><a href='https://k.example/2'>baca</a>")
        + f"<a>{card(inside='<a href=anak>x</a>')}</a>"
        + card()
        + f"<a href='https://k.example/3'>{card(title='')}</a>"
    )
    _, items = extract("linked_cards", html, "2025-01-01")
    assert brief(items) == [
        ("Judul", "https://k.example/1", "Rabu, 1 Januari 2025"),
        ("Judul", "https://k.example/2", "Date not available"),
        ("Judul", "anak", "Date not available"),
    ]
    assert reasons(items)[3:] == ["missing_link", "missing_title"]


def entry(title, date, href="https://t.example/1"):
    link = f" href='{href}'" if href is not None else ""
    shown = f" title='{title}'" if title is not None else ""
    return (
        f"<li class='ptb15'><h3 class='f16 fbo'><a{link}{shown}><i></i>ikon</a></h3>"
        f"<time class='grey'>{date}</time></li>"
    )


MAY = "Jumat, {} Mei 2026 10:00 WIB"


def test_dated_index_stops_at_the_first_older_item(extract):
    html = "".join(entry(f"a{d}", MAY.format(d)) for d in (16, 15, 14, 15, 13))
    page, items = extract("dated_index", html, "2026-05-15")
    assert [b[0] for b in brief(items)] == ["a15"]
    assert reasons(items) == ["other_date", None, "after_cut", "after_cut", "after_cut"]
    assert page.stopped is True and page.found_any is True


def test_dated_index_broken_items_do_not_stop_the_page(extract):
    html = (
        entry("x", "Invalid date format")
        + entry(None, MAY.format(15))
        + entry("Tanpa tautan", MAY.format(15), href=None)
        + entry("Baik", MAY.format(15))
    )
    page, items = extract("dated_index", html, "2026-05-15")
    assert [b[0] for b in brief(items)] == ["", "Baik"]
    assert reasons(items) == ["bad_date", None, "missing_link", None]
    assert page.stopped is False


def test_pages_without_items(rows):
    pages = rows("layout string, html string", [
        (layout, html) for layout in LAYOUTS for html in ("<div>Tidak ada berita</div>", "", None)
    ])
    parsed = parse_listing(pages, AS_OF, "2026-05-15")
    assert listing_items(parsed).count() == 0
    assert {(r.found_any, r.stopped, r.has_more) for r in parsed.collect()} == {
        (False, False, False)}
    assert parsed.count() == 12


def test_unusable_pages_are_rejected_not_lost(rows):
    good = post("x", "kemarin")
    pages = rows("layout string, html string",
                 [("nope", good), (None, "<p>"), ("post_rows", good),
                  ("media_list", "<![foo bar]>" + good)])
    items = listing_items(parse_listing(pages, AS_OF, "2026-05-19"))
    assert [r.layout for r in accepted(items).collect()] == ["post_rows"]
    assert {(r.layout, r.reason) for r in rejects(items).collect()} == {
        ("nope", "unknown_layout"), (None, "unknown_layout"), ("media_list", "unreadable_page")}


def test_dates_may_be_columns_and_the_page_parser_runs_once(rows):
    pages = rows(
        "source string, layout string, page int, html string, fetched date",
        [("s", "post_rows", i, post("x", "kemarin"), AS_OF - dt.timedelta(days=i)) for i in range(3)],
    )
    parsed = parse_listing(pages, F.col("fetched"), F.date_sub("fetched", 1))
    items = listing_items(parsed)
    assert accepted(items).count() == 3
    plan = accepted(items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert {(r["items"], r.oldest_date) for r in page_stats(items, ["page"]).collect()} == {
        (1, AS_OF - dt.timedelta(days=i + 1)) for i in range(3)
    }


SITEMAP = """<?xml version="1.0" encoding="UTF-8"?>
<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"
        xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">
  <url><loc>https://x.example/politik/kabinet-baru-12345</loc><lastmod>2026-05-19T20:37:00Z</lastmod></url>
  <url><loc> https://x.example/p/2 </loc><lastmod>2026-05-19 15:30 Z</lastmod>
    <news:news><news:title> Judul &amp; Isi </news:title></news:news></url>
  <url><loc>https://x.example/p/lama-3</loc><lastmod>2026-05-18T10:15:00Z</lastmod></url>
  <url><loc>https://x.example/p/tanpa-tanggal</loc></url>
  <url><loc></loc><lastmod>2026-05-19T10:15:00Z</lastmod></url>
</urlset>"""

EXPECTED = [
    ("Judul & Isi", "https://x.example/p/2", "2026-05-19"),
    ("Kabinet Baru", "https://x.example/politik/kabinet-baru-12345", "2026-05-19"),
]


def test_sitemap_files_and_documents(spark, rows, tmp_path):
    (tmp_path / "politik-sitemap.xml").write_text(SITEMAP, encoding="utf-8")
    files = read_sitemaps(spark, str(tmp_path))
    docs = sitemap_urls(rows("category string, xml string", [("politik", SITEMAP)]), "xml")
    for urls in (files, docs):
        got = sitemap_articles(urls, "2026-05-19").select("title", "link", "date_text")
        assert sorted(map(tuple, got.collect())) == EXPECTED
    assert files.columns == ["loc", "lastmod", "news_title", "reason"]
    assert sitemap_articles(docs, "2026-05-19").first().category == "politik"


def test_sitemap_without_entries(rows):
    docs = rows("xml string", [("<urlset></urlset>",), ("<div>No sitemap</div>",), (None,)])
    assert sitemap_articles(sitemap_urls(docs, "xml"), "2026-05-19").count() == 0


def test_sitemap_entries_fail_one_by_one(rows):
    start = "<?xml version='1.0'?><urlset xmlns:news='n' xmlns:image='i'>"
    entry = "<url><loc>https://n/{}</loc><lastmod>2026-05-19</lastmod></url>"
    documents = [
        (1, start + entry.format("a?x=1&y=2&amp;z=3") + "<url><loc>https://n/b</loc><lastmod>2026-05-19</lastmod>"),
        (2, start + entry.format("c") + "<url><loc>https://n/d</loc><lastm"),
        (3, start + "<url><loc>https://n/e</loc><loc>https://n/f</loc><lastmod>2026-05-19</lastmod></url></urlset>"),
        (4, start + "<url><loc> </loc></url><url><lastmod>2026-05-19</lastmod></url><url><loc>g</loc></url>"),
        (5, "<html>no entries"),
        (6, None),
        (7, start + "<url><image:image><image:loc>i</image:loc></image:image><loc><![CDATA[https://n/h?a=1&b=2]]></loc>"
            "<lastmod>2026-05-18</lastmod></url></urlset>"),
    ]
    urls = sitemap_urls(rows("d int, xml string", documents), "xml").cache()
    articles = sitemap_articles(urls, "2026-05-19").select("d", "link")
    assert sorted(map(tuple, articles.collect())) == [
        (1, "https://n/a?x=1&y=2&z=3"), (1, "https://n/b"), (2, "https://n/c"), (3, "https://n/e"),
    ]
    assert sorted((r.d, r.reason) for r in sitemap_rejects(urls).collect()) == [
        (2, "unreadable_entry"), (4, "bad_date"), (4, "missing_link"), (4, "missing_link"),
        (5, "unreadable_document"), (6, "unreadable_document"),
    ]
    assert [r.loc for r in urls.where("d = 7").collect()] == ["https://n/h?a=1&b=2"]


def test_sitemap_long_titles_comments_and_prefixes(rows):
    title = "a\U0001F600" * 100_000
    start = "<?xml version='1.0'?><urlset xmlns:news='n'>"
    entry = "<url><loc>https://n/{}</loc><lastmod>2026-05-19</lastmod>{}</url>"
    documents = [
        (1, start + entry.format("long", f"<news:news><news:title>{title}</news:title></news:news>")),
        (2, start + "<!-- " + entry.format("hidden", "") + " -->" + entry.format("shown", "")),
        (3, "<s:urlset xmlns:s='x'><s:url><s:loc>https://n/p</s:loc><s:lastmod>2026-05-19</s:lastmod></s:url>"),
        (4, start + entry.format("before", "") + "<!-- unclosed " + entry.format("after", "")),
    ]
    urls = sitemap_urls(rows("d int, xml string", documents), "xml")
    got = sitemap_articles(urls, "2026-05-19").select("d", "link", F.length("title").alias("n")).collect()
    assert sorted((r.d, r.link) for r in got) == [
        (1, "https://n/long"), (2, "https://n/shown"), (3, "https://n/p"), (4, "https://n/before"),
    ]
    assert [r.n for r in got if r.d == 1] == [200_000]


def test_sitemap_parses_each_entry_once(rows):
    urls = sitemap_urls(rows("category string, xml string", [("politik", SITEMAP)]), "xml")
    plan = sitemap_articles(urls, "2026-05-19")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") == 1


def test_sitemap_files_in_byte_ranges(spark, rows, tmp_path):
    entry = "<url><loc>https://n/{0}</loc><lastmod>2026-05-{1:02d}</lastmod>{2}</url>\n"
    parts = ["<?xml version='1.0'?><urlset xmlns:news='n'>\n"]
    for i in range(400):
        extra = f"<news:news><news:title>T{i} &amp; {'é' * (i % 7)}</news:title></news:news>" if i % 3 else ""
        if i % 50 == 10:
            parts.append("<!-- " + entry.format(f"hidden{i}", 19, "") * 3 + " -->\n")
        parts.append(entry.format(i, 18 + i % 3, extra))
    text = "".join(parts) + "</urlset>\n"
    (tmp_path / "big.xml").write_text(text, encoding="utf-8")
    (tmp_path / "none.xml").write_text("<urlset></urlset>", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        got = sorted(map(tuple, read_sitemaps(spark, str(tmp_path)).collect()), key=str)
        ranges = spark.read.text(str(tmp_path / "big.xml")).select("_metadata.file_block_start").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    docs = rows("xml string", [(text,), ("<urlset></urlset>",)])
    want = sorted(map(tuple, sitemap_urls(docs, "xml").drop("position").collect()), key=str)
    assert got == want and ranges >= 8
    assert not any("hidden" in (r[0] or "") for r in got) and len(got) == 401


PLAIN_ENTRY = (
    "<url>\n <loc> https://t.example/a?x=1&y=2&amp;lt; </loc>\r\n<lastmod>2026-05-15T01:02:03Z</lastmod>"
    "<news:news><news:publication><news:name>n</news:name></news:publication>"
    "<news:title>\U0001f600 &quot;J&apos; </news:title></news:news>"
)
ODD_ENTRIES = [
    "<url a='b'><loc>x</loc>", "<url><loc>&#65;</loc>", "<url><loc><![CDATA[a&b]]></loc>", "<url><loc>a\rb</loc>",
    "<url><loc>x</loc><loc>y</loc>", "<url><loc>a>b</loc>", "<url><loc>]]></loc>", "<url><loc>\x01</loc>",
    "<url>text<loc>x</loc>", "<url><lastmod>x</lastmod><loc>y</loc>", "<url><loc/>", "<s:url><s:loc>x</s:loc>",
    "<url><loc>x</loc><lastmo",
]


def test_plain_entries_do_not_go_through_the_xml_parser(rows):
    fields = (None, "https://t.example/a?x=1&y=2&lt;", "2026-05-15T01:02:03Z", '\U0001f600 "J\'')
    assert _entries(f"<urlset>{PLAIN_ENTRY}</url></urlset>") == [fields]
    parsed = rows("p string", [(PLAIN_ENTRY,)]).select(_entry(F.col("p")).alias("u")).first().u
    assert (parsed.loc, parsed.lastmod, parsed.news_title) == fields[1:]
    assert [e[0] for e in _entries("</url>".join(ODD_ENTRIES))] == ODD_ENTRIES


def test_an_unplain_entry_lends_nothing_to_the_next(rows):
    xml = "<url><loc>a</loc><b/></url><url><lastmod>2026-05-15</lastmod></url><!-- <!-- --><url><loc>z</loc>"
    urls = sitemap_urls(rows("xml string", [(xml,), (None,), ("<html>",)]), "xml").collect()
    got = [(r.position, r.loc, r.lastmod, r.reason) for r in urls]
    assert got[:3] == [
        (0, "a", None, "bad_date"), (1, None, "2026-05-15", "missing_link"), (2, "z", None, "bad_date"),
    ]
    assert got[3:] == [(None, None, None, "unreadable_document")] * 2


def test_files_without_entries_are_one_row_each(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<urlset><!-- <url><loc>x</loc></url> <url><loc>y</loc></url> --></urlset>")
    (tmp_path / "b.xml").write_text(" ")
    (tmp_path / "c.xml").write_text("<!-- --><url><loc>c</loc></url><!--" + "<url></url>" * 50 + "--><url><loc>d</loc></url>")
    urls = read_sitemaps(spark, str(tmp_path))
    assert sorted((r.loc or "", r.reason) for r in urls.collect()) == [
        ("", "unreadable_document"), ("", "unreadable_document"), ("c", "bad_date"), ("d", "bad_date"),
    ]
    plan = urls._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2
