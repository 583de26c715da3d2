"""Document fingerprints by winnowing.

All k-grams of a text's code points get a rolling hash; of every ``window`` consecutive
hashes the least is chosen, the rightmost of equal ones, and kept with its position.  Texts
that share a substring of ``k + window - 1`` code points share a chosen hash.

A text of fewer than k code points is one gram; one of fewer than ``window`` grams is one
window; an empty or missing text has no fingerprint.  ``fingerprints`` passes extra columns
through and replaces those named like its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsrisk.llm.common import mix, sliding_min, span_hashes, with_fields

K, WINDOW = 16, 32
FULL = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)


def winnow(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The chosen hashes (32 bits) and their positions, in order of position."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    k = min(k, len(points))
    at = np.arange(len(points) - k + 1)
    hashes = span_hashes(mix(points.astype(np.uint64) + np.uint64(1)), at, at + k)
    # The complement of the position makes the rightmost of equal hashes the least.
    keys = (hashes >> HALF << HALF) | (FULL - at.astype(np.uint64))
    least = sliding_min(keys, min(window, len(keys)))
    chosen = least[np.flatnonzero(np.diff(least, prepend=~least[:1]))]
    return (chosen >> HALF).astype(np.uint32), (FULL - (chosen & FULL)).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of two sets of hashes; 1 when both are empty."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) + len(b):
        return 1.0
    return 2 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def as_text(hashes: np.ndarray) -> str:
    """Eight hexadecimal digits for each chosen hash, in order of position."""
    return hashes.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """``docs`` with arrays ``fp_hashes`` and ``fp_positions``."""
    docs = docs.drop("fp_hashes", "fp_positions")
    schema = with_fields(docs, "fp_hashes array<long>, fp_positions array<int>")
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(t, k, window) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                batch.columns
                + [
                    pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                    pa.array([p.astype(np.int32) for _, p in found], pa.list_(pa.int32())),
                ],
                names=[*batch.schema.names, "fp_hashes", "fp_positions"],
            )

    return docs.mapInArrow(work, schema)


# -- a text against its edited form and its neighbour ------------------------------------------


def range_bucket(value: Column, bounds: list, fan: int = 256) -> Column:
    """How many of the ascending ``bounds`` lie below ``value``, in two short scans."""
    if not bounds:
        return F.lit(0)
    below = lambda array: F.size(F.filter(array, lambda b: b < value))
    coarse = bounds[fan - 1 :: fan]
    step = below(F.lit(coarse)) if coarse else F.lit(0)
    return step * fan + below(F.slice(F.lit(bounds), step * fan + 1, fan))


def in_sequence(docs: DataFrame) -> DataFrame:
    """(bucket, guest, doc_id, text): ranges of doc_id, each with the row that follows it.

    The bounds come from approximate quantiles of doc_id.  In descending order the last row
    of a bucket is followed by the first of the next bucket that has rows, and the last row
    of all by the first; those first rows are sent along once more as guests.  Only one
    number a bucket reaches the driver.  The texts are shuffled once.
    """
    spark = docs.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.stat.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    bounds = sorted({int(c) for c in cuts})
    bucket = F.coalesce(range_bucket(F.col("doc_id"), bounds), F.lit(-1)).cast("int")
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(bucket)
    rows = docs.select("doc_id", "text", bucket.alias("bucket"))
    firsts = rows.groupBy("bucket").agg(F.max("doc_id").alias("first")).collect()
    firsts = sorted(((r.bucket, r.first) for r in firsts), reverse=True)
    heads = firsts[1:] + firsts[:1]
    links = spark.createDataFrame(
        [(first, own[0]) for own, (_, first) in zip(firsts, heads, strict=True)],
        "first long, host int",
    )
    # One row a bucket: as small as the number of partitions, whatever the size of the input.
    links = F.broadcast(links)
    same = F.col("doc_id").eqNullSafe(F.col("first"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.when(F.col("host").isNotNull(), F.struct(F.col("host").alias("bucket"), F.lit(True).alias("guest")))
    return (
        rows.join(links, same, "left")
        .select(F.explode(F.array_compact(F.array(own, guest))).alias("place"), "doc_id", "text")
        .select("place.*", "doc_id", "text")
    )


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, positions array<int>"
)


def compare_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and order: each is compared with the row after it."""
    names = [f.strip().split(" ")[0] for f in COMPARED.split(",")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int32())]
    held = None
    for batch in batches:
        out = []
        for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            if guest and (held is None or held[1] or held[0] != bucket):
                held = bucket, True, doc_id, text, None
                continue
            print_ = winnow(text)
            if held and not held[1] and held[0] == bucket:
                out.append(compared(*held[2:], text, print_))
            held = bucket, guest, doc_id, text, print_
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            if out
            else [pa.array([], t) for t in types],
            names=names,
        )


def compared(doc_id, text: str, own: tuple, following: str, after: tuple) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    changed = winnow(edited)[0]
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        as_text(own[0]),
        as_text(changed),
        likeness(own[0], changed),
        likeness(own[0], after[0]),
        own[1].astype(np.int32),
    )


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how alike these and the next are.

    Edited: the last half of the code points is replaced by as many first ones (or all) of
    the next document in descending doc_id; the first follows the last.  Missing texts are
    empty.  Rows that repeat a doc_id follow one another in order of their texts; rows
    without one come last.  An empty table gives no rows; a single row is its own neighbour.
    """
    placed = in_sequence(docs).repartition("bucket")
    order = ["bucket", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()]
    return placed.sortWithinPartitions(*order).mapInArrow(compare_in_order, COMPARED)
