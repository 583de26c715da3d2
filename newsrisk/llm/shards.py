"""Sharding by balanced label propagation, in DataFrame operations only.

Documents that share a link (here: equal texts) should lie in one shard, shards should be even.
All start in a shard drawn by a hash.  In every round a document looks at the shards of the
documents it is linked with (counts by link and shard, never pairs) and wants to move to the
most frequent one, or, once refused, to the most frequent one that has room; quotas on the
flows between shards keep the linked rows of every shard within its share (within ``SLACK``
more if nearly all rows are linked), and a link's documents are let through together.  Large
groups are placed whole where they fit; those larger than a shard fill what is left.  The
last step makes the numbers of rows exactly even: the rows a shard has too many,
those without links first, fill the places missing elsewhere.

A missing text has no bytes and is linked with other missing texts.  Rows that repeat a
doc_id are rows of their own.  Only the votes of at most shards / SLACK large groups and
(shards x shards) numbers reach the driver.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsrisk.llm.common import stored
from newsrisk.operators.skew import join_one_per_key

SHARDS, ROUNDS, SLACK = 8, 4, 0.1
#: Rounds end when no move is left; after ``ROUNDS`` also when one brings nothing, and here.
MOST = 24
#: Rows of a shard that are numbered in one task.
NUMBERED = 4_000


def share(*of: Column) -> Column:
    """A number in [0, 1) that is fixed by ``of``."""
    return F.pmod(F.xxhash64(*of), F.lit(1 << 30)) / float(1 << 30)


def quotas(sizes: list[int], flows: list[list[int]], limit: float) -> list[list[float]]:
    """The part of each flow between shards that may pass, so that no shard exceeds ``limit``."""
    n = len(sizes)
    open_ = [[1.0] * n for _ in range(n)]
    for _ in range(100):
        steady = True
        for j in range(n):
            come = sum(flows[i][j] * open_[i][j] for i in range(n))
            go = sum(flows[j][k] * open_[j][k] for k in range(n))
            over = sizes[j] + come - go - max(limit, sizes[j])
            if come > 0 and over > 0.5:
                factor = max(0.0, 1 - over / come)
                steady = False
                for i in range(n):
                    open_[i][j] *= factor
        if steady:
            break
    return open_


def by_pair(matrix: list[list[float]], row: Column, column: Column) -> Column:
    flat = [x for r in matrix for x in r]
    return F.element_at(F.lit(flat), row * len(matrix) + column + 1)


def whole_or_pieces(votes: dict, room: list[float], pieces: bool) -> dict[object, list[float]]:
    """Per group the parts of its rows that go to each shard; ``room`` is taken up.

    ``votes`` has the rows of each group by shard.  The largest group is served first: with
    the most frequent shard that holds it as a whole, or, as ``pieces``, with the roomiest.
    """
    plan = {}
    for link, have in sorted(votes.items(), key=lambda v: (-sum(v[1]), v[1], str(v[0]))):
        total = left = sum(have)
        part = [0.0] * len(room)
        fits = [j for j in range(len(room)) if room[j] >= total]
        if pieces:
            for j in sorted(range(len(room)), key=lambda j: -room[j]):
                part[j] = min(left, max(0.0, room[j]))
                left -= part[j]
            part[max(range(len(room)), key=lambda j: part[j])] += left
        elif fits:
            part[max(fits, key=lambda j: have[j])] = total
        else:
            continue
        room[:] = [r - x for r, x in zip(room, part, strict=True)]
        plan[link] = [x / total for x in part]
    return plan


def planned(plan: dict[object, list[float]]) -> Column:
    """The shard of a row of a group in ``plan``, else that it has."""
    out = F.col("shard")
    for link, part in plan.items():
        ends = [*accumulate(part)][:-1]
        at = F.size(F.filter(F.lit(ends), lambda end: end <= share(F.col("node"), F.lit(-1))))
        out = F.when(F.col("link") == F.lit(link), at).otherwise(out)
    return out.cast("int")


def propagate(nodes: DataFrame, shards: int, rounds: int) -> DataFrame:
    """``nodes`` (node, link, ...) with ``shard`` and ``links``, the size of the link's group.

    Groups of more than ``SLACK`` of a share are few (shards / SLACK at most) and placed on
    the driver: those that fit a shard first, the others in pieces when all else is placed.
    """
    sizes = nodes.groupBy("link").agg(F.count("*").alias("links"))
    placed = join_one_per_key(nodes, sizes, ["link"], "left")
    placed = stored(placed.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")), "placed")
    fair = placed.count() / shards
    large = F.col("links") > max(1.0, fair * SLACK)
    small = (F.col("links") > 1) & ~large
    votes: dict = {}
    for r in placed.where(large).groupBy("link", "shard").agg(F.count("*").alias("n")).collect():
        votes.setdefault(r.link if not isinstance(r.link, bytearray) else bytes(r.link), [0] * shards)[r.shard] = r.n
    # Rows without links and pieces make way in the end: only small groups take up room.
    room = [fair] * shards
    whole = whole_or_pieces({k: v for k, v in votes.items() if sum(v) <= fair}, room, False)
    pieces = {k: v for k, v in votes.items() if k not in whole}
    taken = [fair - r for r in room]
    refused = -1
    for turn in range(MOST):
        seen = placed.where(small).groupBy("link", "shard").agg(F.count("*").alias("votes"), F.first("links").alias("links"))
        counts = [0] * shards
        for r in seen.groupBy("shard").agg(F.sum("votes").alias("n")).collect():
            counts[r.shard] = r.n
        limit = max(fair, (sum(counts) + sum(taken)) / shards * (1 + SLACK))
        free = [max(0.0, limit - n - t) for n, t in zip(counts, taken, strict=True)]
        # Where a group lies as a whole it stays; else it needs room for what is not there yet.
        fits = F.col("links") - F.col("votes") <= F.element_at(F.lit(free), F.col("shard") + 1)
        best = seen.groupBy("link").agg(
            F.max_by("shard", F.struct(fits.alias("fits") if turn else F.lit(True), "votes", F.xxhash64("link", "shard"))).alias("best")
        )
        wish = join_one_per_key(placed, best, ["link"], "left")
        wish = stored(wish.withColumn("best", F.coalesce("best", "shard")), "wishes")
        flows = [[0] * shards for _ in range(shards)]
        for r in wish.where("shard <> best").groupBy("shard", "best").agg(F.count("*").alias("n")).collect():
            flows[r.shard][r.best] = r.n
        moves = sum(map(sum, flows))
        if not moves or (turn >= rounds and moves == refused):
            placed = wish.drop("best")
            break
        passed = quotas([n + t for n, t in zip(counts, taken, strict=True)], flows, limit)
        lot = share(F.col("link"), F.lit(turn))
        moved = F.when(lot < by_pair(passed, F.col("shard"), F.col("best")), F.col("best")).otherwise(F.col("shard"))
        placed = stored(wish.withColumn("shard", moved).drop("best"), "placed")
        refused = moves
    room = [fair - n - t for n, t in zip(counts, taken, strict=True)]
    plan = {**whole, **whole_or_pieces(pieces, room, True)}
    return placed.withColumn("shard", F.when(large, planned(plan)).otherwise(F.col("shard")))


def numbered(placed: DataFrame, per_task: int) -> DataFrame:
    """``placed`` with ``rank``: gapless from 0 in each shard, rows with links first.

    Small groups lie side by side, so that few are cut; before the rows without links come
    those of groups larger than a shard.  Rows are numbered within hash buckets; the buckets' offsets come from their counts.
    """
    total = placed.count()
    buckets = max(1, total // (SHARDS * per_task))
    links = F.col("links")
    kind = F.when(links < 2, 3).when(links > total / SHARDS, 2).when(links > per_task, 0).otherwise(1)
    by = F.when(kind == 1, F.xxhash64("link", F.lit(1))).otherwise(F.xxhash64("node", F.lit(1)))
    rows = placed.withColumn("kind", kind).withColumn("bucket", F.pmod(by, F.lit(buckets)))
    order = ["kind", "bucket"]
    counts = rows.groupBy("shard", *order).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", *order, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("shard", *order).orderBy("link", "node", "doc_id")
    rows = rows.withColumn("rank", F.row_number().over(inner) - 1)
    rows = join_one_per_key(rows, offsets, ["shard", *order], "left")
    return rows.withColumn("rank", (F.col("rank") + F.col("offset")).cast("long")).drop("offset", *order)


def even(ranked: DataFrame, shards: int) -> DataFrame:
    """``ranked`` with final ``shard`` and ``slot``; the shards' counts differ by one at most."""
    counts = [0] * shards
    for r in ranked.groupBy("shard").agg(F.count("*").alias("n")).collect():
        counts[r.shard] = r.n
    total = sum(counts)
    quota = [total // shards + (j < total % shards) for j in range(shards)]
    spare = [max(0, c - q) for c, q in zip(counts, quota, strict=True)]
    gaps = [max(0, q - c) for c, q in zip(counts, quota, strict=True)]
    spare_before = [0, *accumulate(spare)][:-1]
    gaps_before = [0, *accumulate(gaps)]
    at = lambda values, j: F.element_at(F.lit(values), j + 1)
    shard, rank = F.col("shard"), F.col("rank")
    # The how-manieth of all surplus rows this is, and the shard whose gap it falls into.
    extra = rank - at(quota, shard) + at(spare_before, shard)
    host = F.size(F.filter(F.lit(gaps_before[1:]), lambda end: end <= extra))
    leaves = rank >= at(quota, shard)
    slot = F.when(leaves, at(counts, host) + extra - at(gaps_before, host)).otherwise(rank)
    return ranked.withColumn("slot", slot.cast("long")).withColumn("shard", F.when(leaves, host).otherwise(shard).cast("int"))


def assign(nodes: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, per_task: int = NUMBERED) -> DataFrame:
    """``nodes`` (doc_id, node, link, ...) with ``shard`` and ``slot``.

    ``node`` tells rows apart, rows with the same ``link`` are linked.  An empty table stays
    empty.  Other columns are passed through.
    """
    return even(stored(numbered(propagate(nodes, shards, rounds), per_task), "ranked"), shards)


def documents_by_text(docs: DataFrame) -> DataFrame:
    """Shards of ``docs`` (doc_id, text); equal texts are linked, the law is even rows."""
    text = F.coalesce("text", F.lit(""))
    nodes = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("node"),
        F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"")).alias("link"),
    )
    return assign(stored(nodes, "nodes")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("links").alias("group_size"),
    )
