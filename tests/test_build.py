import json
import os

import pytest

from newsrisk.__main__ import main
from newsrisk.functions.lexicon import COMPONENTS

WAR = "Indonesia dan Malaysia bahas sengketa perbatasan"
CALM = "Diplomasi Indonesia di ASEAN berjalan baik"


def article(link, title):
    return {"title": title, "link": link, "category": "c", "date_text": "", "source": "s"}


def test_load_build_and_export_steps(spark, tmp_path):
    landing, bronze, marts = (str(tmp_path / n) for n in ("landing", "bronze", "marts"))
    os.makedirs(landing)
    for day, articles in (
        ("2025-06-15", [article("a", WAR), article("b", CALM)]),
        ("2025-06-16", [article("a", WAR), article("c", "Harga emas naik")]),
    ):
        with open(f"{landing}/scrape_{day}.json", "w") as f:
            json.dump(articles, f)

    load = ["load", "--landing", landing, "--bronze", bronze, "--as-of", "2025-06-16"]
    build = ["build", "--bronze", bronze, "--marts", marts]
    main(load)
    main(build)
    target = str(tmp_path / "target")
    spark.read.parquet(f"{marts}/daily").drop("mart_year").write.parquet(target)

    main([*load, "--all"])
    main([*build, "--incremental"])
    main(["plan-export", "--marts", marts, "--target", target, "--output", str(tmp_path / "plan")])

    # The link seen again counts on its later day only.
    daily = {str(r.published_date): r.total_articles for r in spark.read.parquet(f"{marts}/daily").collect()}
    assert daily == {"2025-06-15": 1, "2025-06-16": 1}
    assert {r.link for r in spark.read.parquet(f"{marts}/audit").collect()} == {"a", "b"}
    assert spark.read.parquet(f"{marts}/weekly").count() == 2
    month = spark.read.parquet(f"{marts}/monthly").first()
    assert month.total_articles == 2 and month[f"idx_{COMPONENTS[0]}"] == 50.0
    plan = {r.published_date: r.action for r in spark.read.parquet(str(tmp_path / "plan")).collect()}
    assert plan == {"2025-06-15": "update", "2025-06-16": "append"}


def test_pages_to_marts_through_the_steps(spark, tmp_path):
    landing, refused, bronze, marts = (str(tmp_path / n) for n in ("landing", "rejects", "bronze", "marts"))
    post = (
        "<div class='row x'><h2 class='post_title'><a href='{}'>{}</a></h2>"
        "<span class='text-secondary'> {}</span></div>"
    )
    html = post.format("https://n/1", WAR, "Kemarin 15:37") + post.format("https://n/2", CALM, "entah")
    spark.createDataFrame(
        [("wire", "c", "post_rows", html), ("wire", "c", "no_such", "x")],
        "source string, category string, layout string, html string",
    ).write.parquet(str(tmp_path / "pages"))
    xml = (
        "<urlset><url><loc>https://n/konflik-gaza-1</loc><lastmod>2025-06-15</lastmod></url>"
        "<url><loc>https://n/1</loc><lastmod>2025-06-15</lastmod></url><url><loc></loc></url>"
    )
    spark.createDataFrame([("maps", "c", xml)], "source string, category string, xml string").write.parquet(
        str(tmp_path / "maps")
    )
    main(["extract", "--pages", str(tmp_path / "pages"), "--sitemaps", str(tmp_path / "maps"), "--date", "2025-06-15",
          "--as-of", "2025-06-16", "--landing", landing, "--rejects", refused])
    reasons = sorted((r.origin, r.reason) for r in spark.read.parquet(refused).collect())
    assert reasons == [("page", "bad_date"), ("page", "unknown_layout"), ("sitemap", "missing_link")]
    main(["load", "--landing", landing, "--bronze", bronze, "--as-of", "2025-06-16"])
    main(["build", "--bronze", bronze, "--marts", marts])
    rows = {r.link: r.source for r in spark.read.parquet(bronze).collect()}
    assert rows == {"https://n/1": "maps", "https://n/konflik-gaza-1": "maps"}  # the last occurrence
    main(["check", "--bronze", bronze])
    with pytest.raises(SystemExit):
        main(["check", "--bronze", bronze, "--marts", marts])  # the only day has no relevant article


def test_last_occurrence_follows_the_fetch_order_not_file_sizes(spark, tmp_path):
    from newsrisk.plans.extract import extract
    from newsrisk.sources.articles import read_articles

    post = (
        "<div class='row x'><h2 class='post_title'><a href='https://n/same'>{}</a></h2>"
        "<span class='text-secondary'> Kemarin 15:37</span></div>"
    )
    for order in ((1, 2, 3, 4), (4, 3, 2, 1)):
        pages = tmp_path / f"pages{order[0]}"
        for n, seq in enumerate(order):
            # Files of different sizes, which Spark reads largest first.
            html = post.format(f"page {n}") + "<p>" + "x" * (1000 * (n % 2 + 1) * (n + 1)) + "</p>"
            spark.createDataFrame(
                [("wire", "c", "post_rows", html, seq)], "source string, category string, layout string, html string, seq int"
            ).write.mode("append").parquet(str(pages))
        landing = str(tmp_path / f"landing{order[0]}")
        extract(spark, "2025-06-15", landing, str(tmp_path / f"rejects{order[0]}"), spark.read.parquet(str(pages)),
                as_of="2025-06-16")
        got = [r.title for r in read_articles(spark, landing, as_of="2025-06-16").collect()]
        assert got == [f"page {order.index(4)}"]
