import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsrisk.operators.dedup import (
    duplicates_removed,
    last_occurrence,
    latest_per_link,
    prefix_cut,
)
from newsrisk.operators.quality import article_checks, daily_checks, table_checks
from newsrisk.operators.stats import scrape_stats
from newsrisk.operators.union import union_sources
from newsrisk.operators.upsert import (
    UpsertSpec,
    apply_upsert,
    deliver,
    export_rows,
    export_spec,
    plan_upsert,
)
from newsrisk.plans import incremental as inc
from newsrisk.plans.marts import (
    audit_mart,
    daily_mart,
    monthly_mart,
    recover_counts,
    weekly_mart,
)
from newsrisk.plans.staging import staging
from newsrisk.schema import COUNT_COLUMNS, DAILY, RAW_NEWS

D = dt.date
WAR = "Indonesia dan Malaysia bahas sengketa perbatasan"
CALM = "Diplomasi Indonesia di ASEAN berjalan baik"
OTHER = "Harga emas naik 2026"
ACT = "Serangan di Gaza, WNI selamat"


@pytest.fixture()
def news(spark):
    def make(*articles):
        """(link, date, title) per article, in file order."""
        data = [
            (title, link, "c", "", "s", seq, date)
            for seq, (link, date, title) in enumerate(articles)
        ]
        return spark.createDataFrame(data, RAW_NEWS)

    return make


def table(df):
    return {r.published_date: r for r in df.collect()}


def test_latest_date_wins_and_ties_take_the_later_row(news):
    df = news(("a", D(2025, 1, 1), "old"), ("a", D(2025, 1, 2), "x"), ("a", D(2025, 1, 2), "y"),
              (None, D(2025, 1, 1), "n1"), (None, D(2025, 1, 1), "n2"))
    assert sorted(r.title for r in latest_per_link(df).collect()) == ["n2", "y"]
    assert sorted(r.title for r in last_occurrence(df).collect()) == ["n2", "y"]
    assert tuple(duplicates_removed(df).first()) == (5, 2, 3)


def test_dedup_keeps_one_row_per_link_and_task_before_the_shuffle(news):
    plan = latest_per_link(news())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_daily_index(news):
    day, empty = D(2025, 1, 1), D(2025, 1, 2)
    daily = table(daily_mart(staging(news(
        ("1", day, WAR), ("2", day, CALM), ("3", day, ACT), ("4", day, OTHER), ("5", empty, OTHER),
        ("6", day, None)))))
    row = daily[day]
    assert (row.total_articles, row.count_war_threat, row.count_war_act) == (3, 1, 1)
    assert row.idx_war_threat == 33.3333
    assert (row.threats_index, row.acts_index, row.total_index) == (33.3333, 33.3333, 66.6667)
    assert daily[empty].total_articles == 0 and daily[empty].total_index is None


def test_rollups_aggregate_before_dividing(news):
    monday, sunday = D(2025, 6, 2), D(2025, 6, 8)
    bronze = news(("1", monday, WAR), ("2", sunday, CALM), ("3", sunday, CALM), ("4", D(2025, 6, 9), WAR),
                  ("5", D(2025, 6, 30), OTHER))
    daily = daily_mart(staging(bronze))
    weeks = {r.week_start: r for r in weekly_mart(daily).collect()}
    first = weeks[monday]
    assert first.idx_war_threat == 33.3333  # not the mean of 100 and 0
    assert (first.first_day_in_week, first.last_day_in_week, first.days_with_data) == (monday, sunday, 2)
    assert weeks[D(2025, 6, 30)].total_index is None
    assert sum(w.total_articles for w in weeks.values()) == 4
    month = monthly_mart(daily).first()
    assert (month.month_start, month.total_articles, month.idx_war_threat) == (D(2025, 6, 1), 4, 50.0)
    stored = daily.drop(*COUNT_COLUMNS)
    assert sorted(weekly_mart(recover_counts(stored)).collect()) == sorted(weekly_mart(daily).collect())
    assert {r.published_date: r.count_war_threat for r in recover_counts(stored).collect()}[monday] == 1


def test_rule_code_is_small_enough_to_be_compiled(spark, news):
    """HotSpot interprets methods above 8,000 bytes; the keyword rules must stay below."""
    df = daily_mart(staging(news(("1", D(2025, 1, 1), WAR))))
    df.collect()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
    text = debug.codegenString(df._jdf.queryExecution().executedPlan())
    sizes = [int(part.split(";")[0].split()[0]) for part in text.split("maxMethodCodeSize:")[1:]]
    assert sizes and max(sizes) < 8000


def test_audit_holds_the_counted_articles(news):
    audit = audit_mart(staging(news(("1", D(2025, 1, 1), WAR), ("2", D(2025, 1, 1), OTHER))))
    assert [(r.link, r.is_war_threat, r.is_war_act) for r in audit.collect()] == [("1", 1, 0)]


def test_prefix_cut(rows):
    day = D(2026, 5, 15)
    older = D(2026, 5, 14)
    data = [("p", 0, day), ("p", 1, None), ("p", 2, older), ("p", 3, day), ("q", 0, day), (None, 0, older)]
    df = rows("page string, pos int, date date", data)
    got = prefix_cut(df, ["page"], "pos", "date", day)
    assert sorted((r.page, r.pos) for r in got.collect()) == [("p", 0), ("p", 1), ("q", 0)]


# ---- incremental -----------------------------------------------------------------------


def stored(spark, path):
    return sorted(map(tuple, inc.read_daily(spark, path).collect()))


def expected(bronze):
    return sorted(map(tuple, daily_mart(staging(bronze)).collect()))


def test_watermark_equals_full_refresh_for_ordered_days(spark, news, tmp_path):
    path = str(tmp_path / "daily")
    days = [D(2024, 12, 30), D(2024, 12, 31), D(2025, 1, 1)]
    articles = [(f"{d}-{i}", d, t) for d in days for i, t in enumerate([WAR, CALM, OTHER])]
    assert inc.watermark(inc.read_daily(spark, path)) == inc.EPOCH
    for n in (3, 5, 9):
        inc.refresh_watermark(spark, news(*articles[:n]), path)
    assert stored(spark, path) == expected(news(*articles))
    assert inc.read_daily(spark, path).schema == DAILY


def test_watermark_ignores_late_dates_and_affected_mode_does_not(spark, news, tmp_path):
    old = [("a", D(2025, 1, 1), WAR), ("b", D(2025, 1, 5), CALM)]
    late = [("c", D(2025, 1, 1), CALM), ("b", D(2025, 1, 6), CALM)]
    bronze = news(*old, *late)
    batch = bronze.where(F.col("ingest_seq") >= 2)
    watermark, affected = str(tmp_path / "w"), str(tmp_path / "a")
    for path in (watermark, affected):
        inc.full_refresh(news(*old), path)
    inc.refresh_watermark(spark, bronze, watermark)
    inc.refresh_affected(spark, bronze, batch, affected)
    kept = table(inc.read_daily(spark, watermark))
    assert kept[D(2025, 1, 1)].total_articles == 1  # not recomputed
    assert D(2025, 1, 5) in kept  # the day link b left stays
    assert stored(spark, affected) == expected(bronze)
    assert D(2025, 1, 5) not in table(inc.read_daily(spark, affected))


def test_affected_mode_drops_a_year_that_becomes_empty(spark, news, tmp_path):
    path = str(tmp_path / "daily")
    old = [("a", D(2024, 12, 31), WAR), ("b", D(2025, 1, 5), CALM)]
    inc.full_refresh(news(*old), path)
    bronze = news(*old, ("a", D(2025, 1, 6), WAR))
    inc.refresh_affected(spark, bronze, bronze.where("ingest_seq = 2"), path)
    assert stored(spark, path) == expected(bronze)


def test_affected_mode_equals_full_refresh_on_random_histories(spark, news, tmp_path):
    rng = random.Random(7)
    articles = [
        (f"l{rng.randrange(12)}", D(2024, 12, 25) + dt.timedelta(days=rng.randrange(14)),
         rng.choice([WAR, CALM, OTHER, ACT, None]))
        for _ in range(60)
    ]
    path = str(tmp_path / "daily")
    whole = news(*articles)
    for low, high in ((0, 25), (25, 40), (40, 60)):
        bronze = whole.where(F.col("ingest_seq") < high)
        inc.refresh_affected(spark, bronze, bronze.where(F.col("ingest_seq") >= low), path)
        assert stored(spark, path) == expected(bronze)


# ---- export ----------------------------------------------------------------------------

SPEC = export_spec("daily")


def test_only_the_daily_mart_is_registered():
    assert (SPEC.key, SPEC.change_columns) == ("published_date", ("total_articles",))
    for name in ("weekly", "monthly", "nope"):
        with pytest.raises(KeyError):
            export_spec(name)


def actions(plan):
    return {r.published_date: r.action for r in plan.collect()}


@pytest.mark.parametrize(
    "target,action",
    [([], "append"), ([("2025-01-01", "10")], "skip"), ([("2025-01-01", "9")], "update"),
     ([("2025-01-01", "")], "update"), ([("2025-01-01", "abc")], "update"),
     ([("2025-01-01", None)], "update"), ([("2025-01-02", "10")], "append")],
)
def test_append_update_skip(rows, target, action):
    mart = rows("published_date date, total_articles long", [(D(2025, 1, 1), 10)])
    sheet = rows("published_date string, total_articles string", target)
    assert actions(plan_upsert(mart, sheet, SPEC)) == {"2025-01-01": action}


def test_duplicate_target_keys_use_the_last_row(rows):
    spec = UpsertSpec("t", "published_date", ("total_articles",), row_column="row")
    mart = rows("published_date date, total_articles long", [(D(2025, 1, 1), 10)])
    sheet = rows("published_date string, total_articles string, row int",
                 [("2025-01-01", "10", 2), ("2025-01-01", "7", 3)])
    row = plan_upsert(mart, sheet, spec).first()
    assert (row.action, row.target_row) == ("update", 3)


def test_missing_index_becomes_zero_only_on_export(rows):
    mart = rows("published_date date, total_articles long, idx double", [(D(2025, 1, 2), 0, None), (D(2025, 1, 1), 5, 1.5)])
    assert [tuple(r) for r in export_rows(mart, "published_date").collect()] == [
        ("2025-01-01", 5, 1.5), ("2025-01-02", 0, 0.0)]


def test_merged_snapshot_and_delivery(rows, tmp_path):
    mart = rows("published_date date, total_articles long", [(D(2025, 1, d), n) for d, n in ((1, 10), (2, 5), (3, 1))])
    sheet = rows("published_date string, total_articles long", [("2024-12-31", 4), ("2025-01-01", 10), ("2025-01-02", 9)])
    merged = {tuple(r) for r in apply_upsert(mart, sheet, SPEC).collect()}
    assert merged == {("2024-12-31", 4), ("2025-01-01", 10), ("2025-01-02", 5), ("2025-01-03", 1)}
    out = str(tmp_path)

    def send(batch):
        for r in batch:
            with open(f"{out}/{r.published_date}", "w") as f:
                f.write(r.action)

    deliver(plan_upsert(mart, sheet, SPEC), send)
    assert {p.name: p.read_text() for p in tmp_path.iterdir()} == {
        "2025-01-02": "update", "2025-01-03": "append"}


def test_snapshot_refuses_a_key_listed_twice_without_rows(rows):
    mart = rows("published_date date, total_articles long", [(D(2025, 1, 1), 10)])
    sheet = rows("published_date string, total_articles long", [("2025-01-01", 4), ("2025-01-01", 7)])
    for make in (plan_upsert, apply_upsert):
        with pytest.raises(Exception, match="lists a key twice"):
            make(mart, sheet, SPEC).collect()
    once = rows("published_date string, total_articles long", [("2025-01-01", 4), ("2025-01-02", 7)])
    assert {tuple(r) for r in apply_upsert(mart, once, SPEC).collect()} == {("2025-01-01", 10), ("2025-01-02", 7)}


# ---- union, counters, quality ----------------------------------------------------------


def test_union_stamps_and_counts(rows):
    schema = "category string, title string, link string, date_text string"
    a = rows(schema, [("p", "t", "1", ""), ("q", "t", "1", "")])
    b = rows(schema, [("p", "t", "2", "")])
    both = union_sources({"a": a, "b": b})
    assert both.count() == 3
    stats = {(r.source, r.category, r.level): r.articles for r in scrape_stats(both).collect()}
    assert stats == {
        ("a", "p", 2): 1, ("a", "q", 2): 1, ("b", "p", 2): 1, ("a", None, 1): 2, ("b", None, 1): 1,
        (None, None, 0): 3}


def report(df):
    return {(r.check, r.column): (r.failing_rows, r.passed) for r in df.collect()}


def test_daily_constraints(rows):
    data = [(D(2025, 1, 1), 1, 5.0), (D(2025, 1, 1), 0, None), (None, None, -1.0), (None, 2, 0.0)]
    got = report(daily_checks(rows("published_date date, total_articles long, total_index double", data)))
    assert got == {
        ("unique", "published_date"): (1, False),
        ("not_null", "published_date"): (2, False),
        ("not_null", "total_articles"): (1, False),
        ("not_null", "total_index"): (1, False),
        ("accepted_range", "total_articles"): (1, False),
        ("accepted_range", "total_index"): (1, False),
    }
    assert report(table_checks(rows("k int", []), "k")) == {("unique", "k"): (0, True)}


def test_article_acceptance(rows):
    schema = "title string, link string, source string"
    good = rows(schema, [("t", "https://x", "a")])
    assert all(p for _, p in report(article_checks(good, ["title", "link"], "a")).values())
    bad = rows(schema, [(" ", "/x", "b"), (None, None, None)])
    got = report(article_checks(bad, ["title"], "a"))
    assert got[("required", "title")] == (2, False)
    assert got[("absolute_link", "link")] == (2, False)
    assert got[("accepted_values", "source")] == (2, False)
    assert report(article_checks(rows(schema, []), ["title"]))[("not_empty", "*")] == (1, False)
