import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newsrisk.plans.incremental import since
from newsrisk.schema import RAW_NEWS
from newsrisk.sources.articles import read_articles, read_day, write_landing
from newsrisk.sources.bronze import (
    append,
    create_bronze,
    dates_of,
    ingest,
    read_bronze,
    unseen,
)
from newsrisk.streaming.ingest import start_ingest

AS_OF = dt.date(2025, 6, 20)


def article(link, title="t"):
    return {"title": title, "link": link, "category": "c", "date_text": "kemarin", "source": "s"}


def put(folder, name, articles):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(articles), encoding="utf-8")


def state(df):
    return sorted((str(r.published_date), r.link) for r in df.collect())


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    put(folder, "news_2025-06-15.json", [article("a"), article("b")])
    put(folder, "artifact-2025-06-17/scrape_2025-06-16.json", [article("a"), article("c")])
    put(folder, "news_latest.json", [article("d")])
    put(folder, "empty_2025-06-14.json", [])
    return folder


def test_scan_stamps_dates_from_file_names(spark, raw):
    batch = read_articles(spark, str(raw), AS_OF)
    assert state(batch) == [
        ("2025-06-15", "a"), ("2025-06-15", "b"), ("2025-06-16", "a"), ("2025-06-16", "c"),
        ("2025-06-19", "d"),
    ]


def test_one_day_and_a_missing_day(spark, raw):
    put(raw, "scrape_2025-06-19.json", [article("z")])
    assert state(read_day(spark, str(raw), "2025-06-16")) == [
        ("2025-06-16", "a"), ("2025-06-16", "c"),
    ]
    assert state(read_day(spark, str(raw), as_of=AS_OF)) == [("2025-06-19", "z")]
    assert read_day(spark, str(raw), "2025-01-01").count() == 0


def test_missing_fields_are_null_and_unknown_fields_are_refused(spark, tmp_path):
    put(tmp_path, "a_2025-06-15.json", [{"title": "t", "link": "a"}])
    assert read_articles(spark, str(tmp_path), AS_OF).first().category is None
    put(tmp_path, "b_2025-06-15.json", [{"title": "t", "content": "x"}])
    with pytest.raises(Exception, match="content"):
        read_articles(spark, str(tmp_path), AS_OF).count()
    checkpoint, bronze = str(tmp_path / "c"), str(tmp_path / "b")
    with pytest.raises(Exception, match="content"):
        start_ingest(spark, str(tmp_path), bronze, checkpoint, AS_OF).awaitTermination()
    assert read_articles(spark, str(tmp_path), AS_OF, strict=False).count() == 2


def test_malformed_json_raises(spark, tmp_path):
    (tmp_path / "a_2025-06-15.json").write_text('[{"title": "t"', encoding="utf-8")
    with pytest.raises(Exception):
        read_articles(spark, str(tmp_path), AS_OF, strict=False).collect()


def test_ingest_twice_is_ingest_once(spark, raw, tmp_path):
    bronze = str(tmp_path / "bronze")
    assert read_bronze(spark, bronze).count() == 0
    for _ in range(2):
        ingest(spark, read_articles(spark, str(raw), AS_OF), bronze)
        assert read_bronze(spark, bronze).count() == 5
    put(raw, "more_2025-06-15.json", [article("b"), article("e")])
    ingest(spark, read_articles(spark, str(raw), AS_OF), bronze)
    assert state(read_bronze(spark, bronze))[:3] == [
        ("2025-06-15", "a"), ("2025-06-15", "b"), ("2025-06-15", "e"),
    ]


def test_guard_is_per_date_and_files_load_in_order(spark, tmp_path):
    put(tmp_path, "a_2025-06-15.json", [article("x", "1"), article("x", "2")])
    put(tmp_path, "b_2025-06-15.json", [article("x", "3"), article("y", "4")])
    put(tmp_path, "a_2025-06-16.json", [article("x", "5")])
    batch = read_articles(spark, str(tmp_path), AS_OF)
    empty = spark.createDataFrame([], RAW_NEWS)
    kept = sorted(r.title for r in unseen(batch, empty).collect())
    assert kept == ["1", "2", "4", "5"]  # copies inside one file stay, later files lose


def test_null_links_compare_equal(rows):
    batch = rows("published_date date, link string, n int", [(AS_OF, None, 1), (AS_OF, "a", 2)])
    seen = rows("published_date date, link string", [(AS_OF, None)])
    assert [r.n for r in unseen(batch, seen).collect()] == [2]


def test_guard_under_skew_matches_a_plain_anti_join(spark):
    """A third of both sides is one key; the join may not broadcast and must split it."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        link = lambda c: F.when(c % 3 == 0, F.lit("hot")).otherwise(c.cast("string"))
        day = F.lit(AS_OF).alias("published_date")
        rows_in = spark.range(0, 60000, 1, 4).select(
            day, link(F.col("id")).alias("link"), F.sha2(F.col("id").cast("string"), 256).alias("t")
        )
        loaded = spark.range(0, 30000, 1, 4).select(
            day, link(F.col("id") * 2 + 1).alias("link")
        ).where("link <> 'hot'")
        for batch in (rows_in, rows_in.withColumn("load_key", F.lit("2025-06-19|f"))):
            left = unseen(batch, loaded)
            assert len(left.toPandas()) == 40000
            assert "skew=true" in plan(left)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_guard_reads_two_columns_of_the_batch_dates(spark, raw, tmp_path):
    path = str(tmp_path / "bronze")
    ingest(spark, read_articles(spark, str(raw), AS_OF), path)
    batch = read_articles(spark, str(raw), AS_OF)
    text = plan(unseen(batch, dates_of(batch, read_bronze(spark, path))))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1
    assert "ReadSchema: struct<link:string>" in scans[0]
    assert "2025-06-15" in scans[0].split("PartitionFilters")[1]
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


def test_incremental_refresh_prunes_bronze_and_columns(spark, raw, tmp_path):
    path = str(tmp_path / "bronze")
    ingest(spark, read_articles(spark, str(raw), AS_OF), path)
    text = plan(since(read_bronze(spark, path), dt.date(2025, 6, 16)))
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line)
    assert "2025-06-16" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "category" not in scan and "source" not in scan.split("ReadSchema")[1]
    assert text.count("Exchange hashpartitioning") == 2


def test_append_by_name(spark, rows, tmp_path):
    path = str(tmp_path / "bronze")
    append(rows("published_date date, link string", [(AS_OF, "a")]), path)
    row = read_bronze(spark, path).first()
    assert row.link == "a" and row.title is None
    with pytest.raises(ValueError, match="content"):
        append(rows("link string, content string", [("a", "x")]), path)


def test_bronze_as_a_catalog_table(spark, tmp_path):
    for _ in range(2):
        create_bronze(spark, "raw_news_t", str(tmp_path / "t"))
    try:
        assert set(spark.table("raw_news_t").columns) == set(RAW_NEWS.names)
    finally:
        spark.sql("DROP TABLE raw_news_t")


def test_landing_replaces_only_its_dates(spark, rows, tmp_path):
    path = str(tmp_path / "landing")
    schema = (
        "title string, link string, category string, date_text string, source string, "
        "published_date date, ingest_seq long"
    )
    day = lambda d: dt.date(2025, 6, d)
    row = lambda link, d, seq: ("t", link, "c", "", "s", day(d), seq)
    write_landing(rows(schema, [row("a", 15, 1), row("b", 16, 2)]), path)
    again = [row("a", 15, 1), row("c", 15, 2), row("c", 15, 3)]
    write_landing(rows(schema, again), path, order="ingest_seq")
    got = read_articles(spark, path, AS_OF)
    assert state(got) == [("2025-06-15", "a"), ("2025-06-15", "c"), ("2025-06-16", "b")]


def test_stream_loads_new_files_only(spark, raw, tmp_path):
    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")

    def run():
        start_ingest(spark, str(raw), bronze, checkpoint, AS_OF, max_files_per_trigger=2).awaitTermination()
        return read_bronze(spark, bronze).count()

    assert run() == 5
    assert run() == 5
    put(raw, "late_2025-06-15.json", [article("b"), article("n")])
    assert run() == 6
    assert state(read_bronze(spark, bronze)) == state(
        unseen(read_articles(spark, str(raw), AS_OF), spark.createDataFrame([], RAW_NEWS))
    )


def test_landing_loads_back_with_the_defaults_of_the_steps(spark, rows, tmp_path):
    from newsrisk.__main__ import main

    schema = "title string, link string, category string, date_text string, source string, published_date date"
    day = lambda n: dt.date(2025, 6, 15 + n % 3)
    landing, some, every = (str(tmp_path / n) for n in ("landing", "some", "every"))
    write_landing(rows(schema, [("t", f"l{i}", "c", "", "s", day(i)) for i in range(300)]), landing)
    main(["load", "--landing", landing, "--bronze", some, "--as-of", "2025-06-17"])
    assert read_bronze(spark, some).count() == 100
    main(["load", "--landing", landing, "--bronze", every, "--as-of", "2025-06-17", "--all"])
    assert read_bronze(spark, every).count() == 300


def test_array_format_refuses_what_it_would_lose(spark, tmp_path):
    one = tmp_path / "one"
    put(one, "a_2025-06-15.json", [article("a", 'x "][" \\'), article("b")])
    (one / "b_2025-06-15.json").write_text(json.dumps([article("c")], indent=4), encoding="utf-8")
    assert read_articles(spark, str(one), AS_OF, "array").count() == 3
    with pytest.raises(Exception):  # an array over several lines is not lines
        read_articles(spark, str(one), AS_OF).collect()
    lines, twice = tmp_path / "lines", tmp_path / "twice"
    for folder, text in ((lines, '{"link": "a"}\n{"link": "b"}\n'), (twice, '[{"link": "a"}]\n[{"link": "b"}]')):
        folder.mkdir()
        (folder / "x_2025-06-15.json").write_text(text, encoding="utf-8")
        with pytest.raises(Exception, match="not one JSON array"):
            read_articles(spark, str(folder), AS_OF, "array").collect()
        assert read_articles(spark, str(folder), AS_OF).count() == 2


def test_a_straggler_opens_only_its_own_date(spark, raw, tmp_path):
    path = str(tmp_path / "bronze")
    ingest(spark, read_articles(spark, str(raw), AS_OF), path, cache=False)
    assert read_bronze(spark, path).count() == 5
    batch = read_articles(spark, str(raw), AS_OF).where("published_date <> '2025-06-16'")
    text = plan(dates_of(batch, read_bronze(spark, path)))
    assert "2025-06-16" not in text and "2025-06-15" in text
