"""Plans that must stay as they are."""

import datetime as dt

import pytest

from newsrisk.operators.upsert import UpsertSpec, apply_upsert, plan_upsert
from newsrisk.plans.incremental import affected_dates, recompute
from newsrisk.plans.marts import daily_mart
from newsrisk.plans.staging import staging
from newsrisk.schema import RAW_NEWS

D = lambda n: dt.date(2025, 6, n)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def bronze(spark, tmp_path):
    rows = [("t", f"l{i}", "c", "", "s", i, D(1 + i % 9)) for i in range(90)]
    rows += [("t", "l0", "c", "", "s", 100, D(20)), ("t", "late", "c", "", "s", 101, D(1))]
    path = str(tmp_path / "bronze")
    spark.createDataFrame(rows, RAW_NEWS).write.partitionBy("published_date").parquet(path)
    return spark.read.schema(RAW_NEWS).parquet(path)


def test_dedup_moves_one_copy_of_the_title(bronze):
    text = plan(staging(bronze))
    exchange = text[text.index("Exchange hashpartitioning") :]
    assert "lower(" in text[: text.index("Exchange hashpartitioning")] and "lower(" not in exchange


def test_affected_refresh_deduplicates_only_touched_links(spark, bronze):
    batch = bronze.where("ingest_seq >= 100")
    dates = affected_dates(batch, bronze)
    # l0 left day 1 for day 20; the late article came to day 1.
    assert {r[0] for r in dates.collect()} == {D(1), D(20)}
    fresh = recompute(bronze, dates)
    want = {r for r in daily_mart(staging(bronze)).collect() if r.published_date in (D(1), D(20))}
    assert set(fresh.collect()) == want
    text = plan(fresh)
    window, semi = text.index("WindowGroupLimit"), text.index("LeftSemi")
    assert window < semi  # the plan is printed from the top: the join is below the dedup


def test_upsert_reads_each_side_once(spark, tmp_path):
    for name in ("mart", "target"):
        spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long").write.parquet(str(tmp_path / name))
    mart, target = (spark.read.parquet(str(tmp_path / n)) for n in ("mart", "target"))
    spec = UpsertSpec("w", "k", ("n",))
    assert plan(apply_upsert(mart, target, spec)).count("FileScan") == 2
    assert sorted(map(tuple, apply_upsert(mart, target, spec).collect())) == [("a", 1), ("b", 2)]


def test_duplicate_target_keys(rows):
    mart = rows("k string, n long, m long", [("a", 5, None), ("b", 2, 1), ("new", 1, 1)])
    target = rows("k string, n string, m long, r int", [("a", "5", 0, 9), ("a", "x", 0, 2), ("b", "7", 8, 4), ("c", "1", 1, 5)])
    spec = UpsertSpec("w", "k", ("n",), row_column="r")
    for parts in (1, 3):
        planned = {r.k: (r.target_row, r.action, r.m) for r in plan_upsert(mart, target.repartition(parts), spec).collect()}
        assert planned == {"a": (9, "skip", 0), "b": (4, "update", 1), "new": (None, "append", 1)}
    with pytest.raises(Exception, match="twice"):
        plan_upsert(mart, target, UpsertSpec("w", "k", ("n",))).collect()
    merged = sorted((r.k, str(r.n), r.m) for r in apply_upsert(mart, target.withColumn("n", target.n.try_cast("long")), spec).collect())
    assert merged == [("a", "5", 0), ("a", "None", 0), ("b", "2", 1), ("c", "1", 1), ("new", "1", 1)]
