import json
import random

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from newsrisk.sources.arrays import array_objects
from newsrisk.sources.articles import read_articles


def tricky(pick, i):
    parts = ['}', '{', '"', '\\', '\\"', '},{', '"}', 'x', ' ', 'é😀', '\\\\}', ']', '[']
    return "".join(pick.choice(parts) for _ in range(pick.randrange(0, 30))) + str(i)


def articles(n, seed=1):
    pick = random.Random(seed)
    return [
        {"title": tricky(pick, i), "link": f"https://x/{i}", "category": pick.choice(["a", None]), "source": "s"}
        for i in range(n)
    ]


@pytest.fixture()
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_objects_across_every_cut(spark, tmp_path, small_ranges):
    rows = articles(600)
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps(rows[:200], indent=2, ensure_ascii=False))
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text(" \n ")
    got = array_objects(spark.read, str(tmp_path)).collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r.file_name, []).append((r.position, json.loads(r.object)))
    assert set(by_file) == {"a.json", "b.json"}
    assert [o for _, o in sorted(by_file["a.json"], key=lambda x: x[0])] == rows
    assert [o for _, o in sorted(by_file["b.json"], key=lambda x: x[0])] == rows[:200]
    ranges = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).select("_metadata.file_block_start")
    assert ranges.distinct().count() >= 8


def test_read_articles_keeps_the_order_of_the_file(spark, tmp_path, small_ranges):
    rows = articles(300, seed=2)
    day = tmp_path / "published_date=2026-01-02"
    day.mkdir()
    (day / "part.json").write_text(json.dumps(rows))
    got = read_articles(spark, str(tmp_path), as_of="2026-01-05", format="array").orderBy("ingest_seq").collect()
    assert [r.link for r in got] == [r["link"] for r in rows]
    assert [r.title for r in got] == [r["title"] for r in rows]
    assert {str(r.published_date) for r in got} == {"2026-01-02"}


@pytest.mark.parametrize(
    "text",
    [
        '[{"title": "a"}] x',
        '[{"title": "a"} {"title": "b"}]',
        '[{"title": "a"}, {"title": "b"}',
        'x[{"title": "a"}]',
        '[{"title": {"nested": "}"}}]',
        '[{"title": "a}", "link": "b"},\n {"title": "unterminated}',
    ],
)
def test_broken_arrays_raise(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_articles(spark, str(tmp_path), as_of="2026-01-05", format="array").collect()
