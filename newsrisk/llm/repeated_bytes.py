"""Suffix-array dedup on bytes: every string of 200 bytes that starts twice or more goes.

Super-k-mers (``superkmers``) bring strings that can be equal into one bucket.  There the
positions are sorted like a suffix array by bucket-pointer refinement: q-grams give the first
buckets; a bucket is refined by sorting its positions on the bucket numbers of the positions
one depth later, which doubles the depth; new numbers are used by the next refinement, and
positions alone in their bucket are done.  At depth 200 positions of one bucket start equal
strings.

A text is its UTF-8 bytes; a missing one is empty.  All places of a repeated string go, also
those that overlap in one text.  Matches never cross texts.  Input columns named like an
output column are replaced, others are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsrisk.llm.common import CUTS, KEY, VALUES, as_bytes, covered, row_key, sliced, with_fields
from newsrisk.llm.superkmers import repeated, split

WIDTH, GRAM, Q = 200, 32, 8
#: Runs that share a minimiser, and windows in them, before its windows travel one by one.
HOT, MOST = 24_000, 4_000_000
OUT = ("n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_text")


def byte_values(text: str | None) -> np.ndarray:
    return VALUES[as_bytes(text)]


def byte_cutter(text: str | None):
    raw = (text or "").encode()
    return lambda a, b: raw[a:b]


def numbers(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each key, equal for equal keys, and which keys occur once."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    once = np.empty(len(keys), bool)
    once[order] = new & np.append(new[1:], True)
    return number, once


def refine(flat: np.ndarray, width: int) -> np.ndarray:
    """Bucket numbers of all positions of ``flat``, equal where ``width`` bytes are equal.

    Positions less than ``width`` from the end have a number without meaning.
    """
    depth = min(Q, width)
    padded = np.concatenate([flat, np.zeros(2 * width, np.uint8)])
    first = np.zeros(len(flat), np.uint64)
    for i in range(depth):
        first = (first << np.uint64(8)) | padded[i : i + len(flat)]
    bucket, once = numbers(first)
    active = np.flatnonzero(~once)
    while depth < width and len(active):
        step = min(depth, width - depth)
        ahead = np.minimum(active + step, len(flat) - 1)
        number, once = numbers((bucket[active] << 32) | (bucket[ahead] & 0xFFFFFFFF))
        # Fresh numbers above all old ones, so that they and the old ones never meet.
        bucket[active] = number
        if len(active) < len(flat):
            idle = np.ones(len(flat), bool)
            idle[active] = False
            bucket[idle] = int(number.max()) + 1 + np.arange(np.count_nonzero(idle))
        active = active[~once]
        depth += step
    return bucket


def repeated_runs(buckets: list[list[tuple]], width: int = WIDTH) -> Iterator[tuple[bytes, list[tuple]]]:
    """For each string its windows that start twice or more anywhere."""
    several, settled = split(buckets, alone=True)
    for pid, _, n, first, times, _ in settled:
        if times > 1:
            yield pid, [(0, max(n, 1), first)]
    if not several:
        return
    sizes = np.array([s[2] for s in several])
    offsets = np.cumsum([0, *(len(s[1]) for s in several)])[:-1]
    bucket = refine(np.frombuffer(b"".join(s[1] for s in several), np.uint8), width)
    ends = np.cumsum(sizes)
    at = np.repeat(offsets - ends + sizes, sizes) + np.arange(ends[-1])
    bucket = numbers(bucket[at])[0]
    weight = np.bincount(bucket, np.repeat([s[4] for s in several], sizes))
    hit = np.zeros(len(at) + 2, np.int8)
    hit[1:-1] = weight[bucket] > 1
    for (pid, _, n, first, _, _), end in zip(several, ends.tolist(), strict=True):
        edge = np.diff(hit[end - n + 1 : end + 1], prepend=np.int8(0), append=np.int8(0))
        starts = np.flatnonzero(edge == 1)
        if len(starts):
            stops = np.flatnonzero(edge == -1)
            yield pid, [(a, b, first) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


def drop_repeated(docs: DataFrame, width: int = WIDTH, hot: int = HOT, as_text: bool = False, most: int = MOST) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (runs removed) and kept_bytes.

    ``as_text``: kept_text instead, without the bytes of characters of which a part has gone.
    """
    found = repeated(
        docs.select("doc_id", "text"), byte_values, byte_cutter, lambda b: repeated_runs(b, width),
        width, min(GRAM, width), hot, most, size=500_000, earlier=False,
    )
    kept = docs.drop(*OUT).withColumn(KEY, row_key()).join(found.toDF(KEY, CUTS), KEY, "left").drop(KEY)
    schema = with_fields(kept.drop(CUTS), "n_bytes long, n_removed long, n_spans long, " + ("kept_text string" if as_text else "kept_bytes binary"))
    text = schema.names.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            *same, spans = batch.columns
            counts, removed, runs, left = [], [], [], []
            for value, cut in zip(batch.column(text).to_pylist(), spans.to_pylist(), strict=True):
                raw = (value or "").encode()
                counts.append(len(raw))
                gone = np.zeros(len(raw), bool)
                if cut:
                    gone = covered(len(raw), np.array([c["lo"] for c in cut]), np.array([c["hi"] for c in cut]))
                removed.append(int(gone.sum()))
                runs.append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=np.int8(0)) == 1)))
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if cut else raw
                left.append(kept.decode(errors="ignore") if as_text else kept)
            yield pa.RecordBatch.from_arrays(
                [
                    *same,
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(left, pa.string() if as_text else pa.binary()),
                ],
                names=schema.names,
            )

    return kept.mapInArrow(work, schema)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the hash of the bytes left."""
    return drop_repeated(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )
