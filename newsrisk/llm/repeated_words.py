"""Substring dedup on words: a window of 50 words that an earlier document holds goes.

Windows meet in buckets of super-k-mers (``superkmers``), where sorting finds the equal ones
exactly: hashes order the windows and their words are compared.

Words are runs of anything but blanks and the control characters 9 to 13.  A missing text has
no words.  Windows are judged on the input.  Rows that repeat a doc_id do not remove each
other's words; rows without a doc_id come after all others.  Input columns named like an
output column are replaced, others are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsrisk.llm.common import CUTS, KEY, VALUES, as_bytes, covered, gram_hashes, mix, row_key, sliced, span_hashes, with_fields, word_spans
from newsrisk.llm.superkmers import repeated, split

WIDTH, GRAM = 50, 5
#: Runs that share a minimiser, and windows in them, before its windows travel one by one.
HOT, MOST = 20_000, 200_000
OUT = ("n_words", "n_removed", "kept_text")


def word_values(text: str | None) -> np.ndarray:
    raw = as_bytes(text)
    return span_hashes(VALUES[raw], *word_spans(raw))


def word_cutter(text: str | None):
    """Words [a, b) of a text, joined by one blank."""
    raw = (text or "").encode()
    starts, ends = (x.tolist() for x in word_spans(np.frombuffer(raw, np.uint8)))
    words = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
    return lambda a, b: b" ".join(words[a:b])


def equal_windows(strings: list[tuple], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every string its windows' class numbers, equal for equal word sequences."""
    numbers: dict[bytes, int] = {}
    ids = [np.array([numbers.setdefault(w, len(numbers)) for w in s[1].split(b" ")], np.int64) for s in strings]
    flat = np.concatenate(ids)
    offsets = np.cumsum([0, *(len(i) for i in ids)])
    counts = [len(i) - width + 1 for i in ids]
    at = np.concatenate([o + np.arange(n) for o, n in zip(offsets, counts, strict=False)])
    hashes = gram_hashes(mix(flat.astype(np.uint64) + np.uint64(1)), width)[at]
    order = np.argsort(hashes, kind="stable")
    windows = np.lib.stride_tricks.sliding_window_view(flat.astype(np.int32), width)
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    same = np.flatnonzero(~new)
    step = 100_000  # bounded copies of the windows that are compared
    for a in range(0, len(same), step):
        s = same[a : a + step]
        if (windows[at[order[s]]] != windows[at[order[s - 1]]]).any():  # one hash, two sequences
            exact = np.ascontiguousarray(windows[at]).view(f"V{4 * width}").ravel()
            return np.unique(exact, return_inverse=True)[1], np.array(counts)
    classes = np.empty(len(order), np.int64)
    classes[order] = np.cumsum(new) - 1
    return classes, np.array(counts)


def first_owners(buckets: list[list[tuple]], width: int = WIDTH) -> Iterator[tuple[bytes, list[tuple]]]:
    """For each string the windows whose least owner can precede one of the string's owners."""
    several, settled = split(buckets, alone=False)
    for pid, _, n, first, times, _ in settled:
        if times > 1:
            yield pid, [(0, max(n, 1), first)]
    if not several:
        return
    classes, counts = equal_windows(several, width)
    least = np.full(classes.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, classes, np.repeat([s[3] for s in several], counts))
    owner = least[classes]
    ends = np.cumsum(counts)
    for (pid, _, n, first, times, _), end in zip(several, ends.tolist(), strict=True):
        mine = owner[end - n : end]
        if times == 1 and mine.min() == first:
            continue
        start = np.flatnonzero(np.diff(mine, prepend=-1))
        runs = zip(start.tolist(), [*start[1:].tolist(), n], mine[start].tolist(), strict=True)
        yield pid, [r for r in runs if times > 1 or r[2] < first]


def drop_repeated(docs: DataFrame, width: int = WIDTH, hot: int = HOT, most: int = MOST) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (the words left, joined by one blank)."""
    found = repeated(
        docs.select("doc_id", "text"), word_values, word_cutter, lambda b: first_owners(b, width),
        width, min(GRAM, width), hot, most, size=50_000, earlier=True,
    )
    kept = docs.drop(*OUT).withColumn(KEY, row_key()).join(found.toDF(KEY, CUTS), KEY, "left").drop(KEY)
    schema = with_fields(kept.drop(CUTS), "n_words long, n_removed long, kept_text string")
    text = schema.names.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            *same, spans = batch.columns
            counts, removed, left = [], [], []
            for value, cut in zip(batch.column(text).to_pylist(), spans.to_pylist(), strict=True):
                raw = (value or "").encode()
                starts, ends = word_spans(np.frombuffer(raw, np.uint8))
                n = len(starts)
                if cut:
                    keep = ~covered(n, np.array([c["lo"] for c in cut]), np.array([c["hi"] for c in cut]))
                    starts, ends = starts[keep], ends[keep]
                counts.append(n)
                removed.append(n - len(starts))
                left.append(b" ".join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]).decode())
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.string())],
                names=schema.names,
            )

    return kept.mapInArrow(work, schema)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the words left."""
    return drop_repeated(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
