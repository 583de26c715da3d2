"""Super-k-mers: how windows of texts meet their equals without every window travelling.

A window is ``width`` consecutive units (words or bytes) of one text; its minimiser is the
least hash of the grams in it.  Equal windows have equal minimisers, and neighbouring windows
mostly share theirs, so a run of windows with one minimiser travels as one packed string.

1. ``super_windows``: one row a run (minimiser, place), no text.
2. ``wanted``: runs whose minimiser occurs once cannot hold a repeat and are left behind.
3. ``pack``: the others are cut out of the texts.  A minimiser shared by more than ``hot``
   runs, or by runs of more than ``most`` windows together (a text that repeats itself makes one
   long run), would make one bucket too large; its windows go one by one under their digests,
   equal windows of a run together.
4. ``distinct``: equal strings become one row with their number and least owner, before
   anything is brought together by bucket.  What is left of a bucket is at most ``hot``
   strings and ``most`` windows.
5. The caller compares the windows of each bucket (``by_bucket``) and
6. ``cuts`` brings the answers back to the texts.

No step needs the rows of a key together except 5, whose buckets are bounded by step 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsrisk.llm.common import LAST, gram_hashes, row_key, sliced, sliding_min, stored
from newsrisk.operators.skew import join_one_per_key

#: Bytes of a window's digest.  A row whose number of windows is 0 is one window's digest.
DIGEST = 16
#: What ``times`` and ``first`` of a string lead to: windows [lo, hi) whose least owner is first.
RUNS = "pid binary, runs array<struct<lo:int,hi:int,first:bigint>>"


def keyed(docs: DataFrame) -> DataFrame:
    """(rid, rkey, text): the order of the rows and a key of each; a missing doc_id is last."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rid"), row_key().alias("rkey"), "text"
    )


def runs_of(values: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, number of windows, whether the minimiser occurs again) by run."""
    if len(values) < width:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(bool)
    grams = gram_hashes(values, gram)
    span = width - gram + 1
    least = sliding_min(grams, span)
    start = np.flatnonzero(np.diff(least, prepend=~least[:1]))
    value = least[start]
    size = np.diff(np.append(start, len(least)))
    again = [
        np.count_nonzero(grams[a : a + n - 1 + span] == v) > 1
        for a, n, v in zip(start.tolist(), size.tolist(), value, strict=True)
    ]
    return value, start, size, np.array(again, bool)


def super_windows(rows: DataFrame, values_of: Callable, width: int, gram: int) -> DataFrame:
    """One row a run of windows that share a minimiser; texts below one window give none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [runs_of(values_of(t), width, gram) for t in batch.column(1).to_pylist()]
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            parts = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(keys, [len(f[0]) for f in found]).astype(np.int64)),
                    pa.array(parts[0].view(np.int64)),
                    pa.array(parts[1].astype(np.int32)),
                    pa.array(parts[2].astype(np.int32)),
                    pa.array(parts[3].astype(bool)),
                ],
                names=["rkey", "minimiser", "start", "n", "again"],
            )

    return rows.select("rkey", "text").mapInArrow(
        work, "rkey long, minimiser long, start int, n int, again boolean"
    )


def wanted(runs: DataFrame, hot: int, most: int, within: bool) -> DataFrame:
    """The runs that can hold a repeat; ``within`` also counts repeats inside one run."""
    counts = runs.groupBy("minimiser").agg(F.count("*").alias("n_runs"), F.sum("n").alias("n_windows"))
    counts = counts.where("n_runs > 1")
    found = join_one_per_key(runs, counts, ["minimiser"], "left")
    keep = F.col("n_runs").isNotNull()
    if within:
        keep = keep | F.col("again")
    large = (F.col("n_runs") > hot) | (F.col("n_windows") > most)
    return found.where(keep).select(
        "rkey", "minimiser", "start", "n", "again", F.coalesce(large, F.lit(False)).alias("hot")
    )


def pack(rows: DataFrame, runs: DataFrame, cutter: Callable, width: int) -> DataFrame:
    """(bucket, packed, rid, rkey, starts, n, again, pid) for the wanted runs.

    ``cutter(text)`` gives a function (first unit, end unit) -> bytes.
    """
    places = runs.groupBy("rkey").agg(
        F.collect_list(F.struct("minimiser", "start", "n", "again", "hot")).alias("places")
    )
    schema = "bucket long, packed binary, rid long, rkey long, starts array<int>, n int, again boolean"
    size = 10_000

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in sliced(batches):
            for rid, rkey, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cut = cutter(text)
                for p in places:
                    a, n = p["start"], p["n"]
                    if not p["hot"]:
                        out.append((p["minimiser"], cut(a, a + n + width - 1), rid, rkey, [a], n, p["again"]))
                    else:
                        where: dict[bytes, list[int]] = {}
                        for w in range(a, a + n):
                            digest = hashlib.blake2b(cut(w, w + width), digest_size=DIGEST).digest()
                            where.setdefault(digest, []).append(w)
                        for digest, starts in where.items():
                            key = int.from_bytes(digest[:8], "little", signed=True)
                            out.append((key, digest, rid, rkey, starts, 0, False))
                    if len(out) > size:
                        yield rows_as_batch(out, schema)
                        out = []
        if out:
            yield rows_as_batch(out, schema)

    return (
        rows.join(places, "rkey")
        .select("rid", "rkey", "text", "places")
        .mapInArrow(work, schema)
        .withColumn("pid", F.unhex(F.md5("packed")))
    )


ARROW = {
    "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
}


def rows_as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def distinct(pieces: DataFrame) -> DataFrame:
    """Equal strings as one row: how often, the least owner."""
    return pieces.groupBy("bucket", "pid", "packed", "n").agg(
        F.min("rid").alias("first"), F.sum(F.size("starts")).alias("times"), F.max("again").alias("again")
    )


def by_bucket(strings: DataFrame, compare: Callable, size: int) -> DataFrame:
    """``compare`` on lists of whole buckets, ``size`` windows or one bucket long.

    ``compare(buckets)`` gets lists of (pid, packed, n, first, times, again) and yields
    (pid, [(lo, hi, first), ...]).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[list[tuple]] = []
        bucket, held, last = [], 0, None
        for batch in sliced(batches):
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last:
                    if bucket:
                        done.append(bucket)
                    if held > size:
                        yield runs_as_batch(compare(done))
                        done, held = [], 0
                    bucket, last = [], key
                bucket.append(tuple(row))
                held += row[2]
        if bucket:
            done.append(bucket)
        yield runs_as_batch(compare(done))

    return (
        strings.select("bucket", "pid", "packed", "n", "first", "times", "again")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(work, RUNS)
    )


def split(buckets: list[list[tuple]], alone: bool) -> tuple[list[tuple], list[tuple]]:
    """The strings to compare with others, and those whose equals are already counted.

    A string that is alone in its bucket is compared only when ``alone`` and its minimiser
    occurs in it again; digests never are.
    """
    several, settled = [], []
    for bucket in buckets:
        whole = [s for s in bucket if s[2]]
        if len(whole) > 1 or alone and whole and whole[0][5]:
            several += whole
        else:
            settled += whole
        settled += [s for s in bucket if not s[2]]
    return several, settled


def runs_as_batch(found: Iterator[tuple[bytes, list[tuple]]]) -> pa.RecordBatch:
    rows = list(found)
    lengths = np.cumsum([0, *(len(r) for _, r in rows)]).astype(np.int32)
    lo, hi, first = zip(*(x for _, r in rows for x in r), strict=True) if lengths[-1] else ((), (), ())
    struct = pa.StructArray.from_arrays(
        [pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(first, pa.int64())], ["lo", "hi", "first"]
    )
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in rows], pa.binary()), pa.ListArray.from_arrays(pa.array(lengths), struct)],
        names=["pid", "runs"],
    )


def cuts(pieces: DataFrame, found: DataFrame, width: int, earlier: bool) -> DataFrame:
    """(rkey, cuts): the units [lo, hi) of each text that lie in repeated windows.

    ``earlier``: only windows whose least owner comes before the text count.
    """
    mine = F.col("runs")
    if earlier:
        mine = F.filter(mine, lambda r: r["first"] < F.col("rid"))
    moved = F.flatten(
        F.transform(
            "starts",
            lambda start: F.transform(
                mine, lambda r: F.struct((start + r["lo"]).alias("lo"), (start + r["hi"] + (width - 1)).alias("hi"))
            ),
        )
    )
    return (
        pieces.select("pid", "rid", "rkey", "starts")
        .join(found, "pid")
        .select("rkey", moved.alias("moved"))
        .where(F.size("moved") > 0)
        .groupBy("rkey")
        .agg(F.flatten(F.collect_list("moved")).alias("cuts"))
    )


def repeated(
    docs: DataFrame,
    values_of: Callable,
    cutter: Callable,
    compare: Callable,
    width: int,
    gram: int,
    hot: int,
    most: int,
    size: int,
    earlier: bool,
) -> DataFrame:
    """Steps 1 to 6 over ``docs`` (doc_id, text): (rkey, cuts)."""
    rows = keyed(docs)
    runs = stored(super_windows(rows, values_of, width, gram), "runs")
    picked = stored(wanted(runs, hot, most, within=not earlier), "wanted")
    pieces = stored(pack(rows, picked, cutter, width), "pieces")
    found = by_bucket(distinct(pieces), compare, size)
    return stored(cuts(pieces, found, width, earlier), "cuts")
