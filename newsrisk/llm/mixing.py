"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's rate is its target share of the mixture over what it has, in bytes of text.  Every
document draws a number from a hash of its id; inverting the Poisson distribution with the
source's rate as its mean at that number gives how often the document is repeated, zero
included.  The copies are dealt and sorted by another hash: a global shuffle.

A rate above ``SPLIT`` is the sum of several draws.  Rows without a source are a source of
their own; a missing text has no bytes; a source without bytes keeps no rows.  A row without
doc_id draws like an empty id, rows that repeat a doc_id draw alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsrisk.llm.common import stored
from newsrisk.operators.skew import join_one_per_key

SEED = "mix"
#: Above this mean a draw would underflow.
SPLIT = 500.0
#: The table of rates is broadcast up to this number of sources.
FEW_SOURCES = 10_000


def drawn(*parts: Column, digits: int = 13) -> Column:
    """An integer of so many hexadecimal digits, from the MD5 hash of the parts."""
    text = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("long")


def poisson(rate: Column, uniform: Column) -> Column:
    """The least k whose cumulative probability reaches ``uniform``."""
    most = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.exp(-rate)
    end = F.aggregate(
        F.sequence(F.lit(1), most),
        F.struct(start.alias("p"), start.alias("c"), F.lit(0).alias("k")),
        lambda s, k: F.when(
            s["c"] < uniform,
            F.struct((s["p"] * rate / k).alias("p"), (s["c"] + s["p"] * rate / k).alias("c"), k.alias("k")),
        ).otherwise(s),
    )
    return end["k"]


def repeats(rate: Column, doc_id: Column, seed: str) -> Column:
    """How often a document is repeated: the draws of its parts of the rate, summed."""
    draws = F.greatest(F.ceil(rate / SPLIT), F.lit(1)).cast("int")
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    one = lambda i: poisson(
        rate / draws, (drawn(F.lit(seed), name, i.cast("string")) + F.lit(0.5)) / float(1 << 52)
    )
    return F.aggregate(F.sequence(F.lit(1), draws), F.lit(0), lambda total, i: total + one(i))


def rates(docs: DataFrame, weights: DataFrame | None = None, source: str = "source", text: str = "text") -> DataFrame:
    """(source, rate): target bytes over bytes at hand, for sources that have any.

    ``weights`` (source, weight) gives target shares, which are scaled to one over the sources
    present; without it all have the same.  The mixture is about as large as the input.
    """
    have = docs.groupBy(F.col(source).alias("source")).agg(F.sum(F.octet_length(text)).cast("double").alias("bytes"))
    have = have.where("bytes > 0")
    if weights is None:
        have = have.withColumn("weight", F.lit(1.0))
    else:
        have = join_one_per_key(have, weights.select("source", F.col("weight").cast("double")), ["source"], "left")
        have = have.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    have = stored(have, "sources")
    sums = have.agg(F.sum("bytes"), F.sum("weight")).first()
    total, weight = sums[0] or 0.0, sums[1] or 1.0
    return have.select("source", (F.lit(total) * F.col("weight") / F.lit(weight) / F.col("bytes")).alias("rate"))


def replicate(docs: DataFrame, weights: DataFrame | None = None, source: str = "source", seed: str = SEED) -> DataFrame:
    """The copies of ``docs``, with ``copy`` from 1 and ``shuffle_key``, shuffled globally.

    Input columns of these names are replaced.
    """
    table = rates(docs, weights, source).withColumnRenamed("source", source)
    docs = docs.drop("copy", "shuffle_key", "rate")
    if table.count() <= FEW_SOURCES:
        rate = table.withColumnRenamed(source, "_source")
        rows = docs.join(F.broadcast(rate), F.col(source).eqNullSafe(F.col("_source"))).drop("_source")
    else:
        rows = join_one_per_key(docs, table, [source], "left").where("rate IS NOT NULL")
    rows = rows.withColumn("copy", repeats(F.col("rate"), F.col("doc_id"), seed)).where("copy > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copy"))))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = drawn(F.lit(seed), name, F.col("copy").cast("string"), F.lit("place"))
    rows = rows.drop("rate").withColumn("shuffle_key", key)
    return rows.repartition("shuffle_key", "doc_id", "copy").sortWithinPartitions("shuffle_key", "doc_id", "copy")


MIX_SQL = """
WITH RECURSIVE have AS (
  SELECT source, CAST(sum(octet_length(encode(text))) AS DOUBLE) AS bytes
  FROM documents GROUP BY source HAVING sum(octet_length(encode(text))) > 0
),
rate AS (
  SELECT source, (SELECT sum(bytes) FROM have) * 1.0::DOUBLE / (SELECT count(*) FROM have)::DOUBLE / bytes AS rate
  FROM have
),
part AS (
  SELECT source, CAST(greatest(ceil(rate / 500.0::DOUBLE), 1) AS INTEGER) AS draws,
         rate / CAST(greatest(ceil(rate / 500.0::DOUBLE), 1) AS INTEGER)::DOUBLE AS mean
  FROM rate
),
steps(source, mean, k, p, c) AS (
  SELECT source, mean, 0, exp(-mean), exp(-mean) FROM part
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1)::DOUBLE, c + p * mean / (k + 1)::DOUBLE
  FROM steps WHERE k < CAST(ceil(mean + 12 * sqrt(mean) + 40) AS INTEGER)
),
draw AS (
  SELECT d.doc_id, d.source, i,
         (CAST(CAST('0x' || substr(md5(concat('mix:', coalesce(d.doc_id::VARCHAR, ''), ':', i)), 1, 13) AS BIGINT) AS DOUBLE)
          + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN part p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, p.draws + 1)) AS r(i)
),
per_draw AS (
  SELECT w.doc_id, w.i, w.source, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM w.source AND s.c < w.u
     AND s.k < (SELECT max(k) FROM steps m WHERE m.source IS NOT DISTINCT FROM w.source)) AS n
  FROM draw w
),
counts AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n FROM per_draw GROUP BY doc_id)
SELECT d.doc_id, d.source, d.text, CAST(r.copy AS INTEGER) AS copy,
       CAST('0x' || substr(md5(concat('mix:', d.doc_id, ':', r.copy, ':place')), 1, 13) AS BIGINT) AS shuffle_key
FROM documents d JOIN counts c ON c.doc_id = d.doc_id, unnest(range(1, c.n + 1)) AS r(copy)
"""
