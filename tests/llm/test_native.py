import random
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from newsrisk.llm import licences, mixing, shards


def against_sql(table, sql: str, out) -> None:
    """``out`` holds the rows that DuckDB finds in ``table`` (as documents)."""
    con = duckdb.connect()
    con.register("documents", table.toArrow())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(out.columns)
    want = Counter(rel.fetchall())
    assert Counter(tuple(r[n] for n in names) for r in out.collect()) == want


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(5)
    notices = [t for _, t in licences.TEMPLATES]
    lines = [*notices, *(n.upper() for n in notices), *(n + " More words here." for n in notices)]
    lines += [" ".join(n.split()[2:]) for n in notices] + ["", " ", "one", "Ä licensed", "license " * 300, "a\tb"]
    out = ["\n".join(pick.choice(lines) for _ in range(pick.randrange(5))) for _ in range(120)]
    return [*out, None, "", "\n\n"]


def test_licences_match_sql(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = licences.scan(table.withColumn("line", F.lit("x")).withColumn("grams", F.lit(1)))
    against_sql(table, licences.scan_sql(), out)
    assert out.count() > 80
    assert licences.scan(table.limit(0)).count() == 0


def test_mixing_matches_sql(spark):
    pick = random.Random(6)
    rows = [(i, pick.choice(["a", "a", "a", "b", None]), "x" * pick.randrange(90)) for i in range(500)]
    rows += [(600, "rare", "yy"), (601, "empty", None), (602, "empty", ""), (603, "b", None)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.replicate(table)
    against_sql(table, mixing.MIX_SQL, out)
    sizes = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    total = sum(len(t or "") for *_, t in rows)
    assert set(sizes) == {"a", "b", None, "rare"}
    assert all(abs(n - total / 4) < 0.25 * total / 4 for n in sizes.values())


def test_mixing_weights_and_edges(spark):
    table = spark.createDataFrame(
        [(i % 400, "ab"[i % 2], "text", 7) for i in range(1000)] + [(None, "b", "t", 7)],
        "doc_id long, source string, text string, copy int",
    )
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("z", 9.0)], "source string, weight double")
    out = mixing.replicate(table, weights)
    n = Counter(r.source for r in out.collect())
    assert 2.4 < n["a"] / n["b"] < 3.7
    assert out.columns == ["doc_id", "source", "text", "copy", "shuffle_key"]
    assert mixing.replicate(table.limit(0)).count() == 0


def test_poisson_inverse(spark):
    from math import exp

    rows = [(rate, u / 997) for rate in (0.0, 0.3, 2.0, 40.0) for u in range(1, 997, 83)]
    table = spark.createDataFrame(rows, "rate double, u double")
    for r in table.select("rate", "u", mixing.poisson(F.col("rate"), F.col("u")).alias("k")).collect():
        k, p = 0, exp(-r.rate)
        total = p
        while total < r.u:
            k += 1
            p *= r.rate / k
            total += p
        assert r.k == k


def shard_rows(spark, rows):
    return shards.documents_by_text(spark.createDataFrame(rows, "doc_id long, text string")).collect()


@pytest.mark.parametrize("hot", [0, 500])
def test_shards_are_even_and_keep_groups(spark, hot, monkeypatch):
    monkeypatch.setattr(shards, "NUMBERED", 40)
    pick = random.Random(8)
    rows = [(i, f"text {i}") for i in range(900)] + [(1000 + i, f"copied {i // 4}") for i in range(200)]
    rows += [(3000 + i, "hot") for i in range(hot)] + [(None, None), (None, ""), (5, "text 5"), (5, None)]
    pick.shuffle(rows)
    out = shard_rows(spark, rows)
    assert Counter((r.doc_id, r.size) for r in out) == Counter((d, len(t or "") + 1) for d, t in rows)
    counts = Counter(r.shard for r in out)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    where: dict = {}
    for r in out:
        if r.doc_id is not None and 1000 <= r.doc_id < 1200:
            where.setdefault((r.doc_id - 1000) // 4, set()).add(r.shard)
    assert sum(len(s) == 1 for s in where.values()) >= (40 if hot else 46)
    assert {r.law for r in out} == {"rows"} and {r.grown_shard for r in out} == {None}


def test_shards_of_few_rows(spark):
    assert shard_rows(spark, []) == []
    out = shard_rows(spark, [(1, "a"), (2, "a"), (3, None)])
    assert len({r.shard for r in out}) == 3 and {r.slot for r in out} == {0}


def test_quotas_hold():
    pick = random.Random(9)
    for _ in range(30):
        n = pick.randrange(2, 9)
        flows = [[0 if i == j else pick.randrange(900) for j in range(n)] for i in range(n)]
        sizes = [sum(f) + pick.randrange(800) for f in flows]
        limit = 1.02 * sum(sizes) / n
        part = shards.quotas(sizes, flows, limit)
        for j in range(n):
            come = sum(flows[i][j] * part[i][j] for i in range(n))
            go = sum(flows[j][k] * part[j][k] for k in range(n))
            assert sizes[j] + come - go <= max(limit, sizes[j]) + 1


def test_native_modules_use_no_python_on_executors():
    for module in (licences, mixing, shards):
        code = Path(module.__file__).read_text()
        assert not any(word in code for word in ("mapIn", "applyIn", "udf", ".rdd", "pandas"))
