"""Quality rules with risk-controlled thresholds.

Base features of every whole text lead to the share of symbols, of repeated lines, of
repeated words and of words that repeat the one before.  A rule rejects a text whose share exceeds a cutoff.  For each stratum and
rule the cutoffs of a fixed grid are tested from the most lenient one on: labelled good
documents give an exact binomial test of "more than ALPHA / rules of the good ones are
rejected", at the level DELTA / (rules * strata); the first cutoff that fails ends the
sequence (fixed-sequence testing inside a rule, Bonferroni over rules and strata).  So with
probability 1 - DELTA at most ALPHA of the good documents are rejected in every stratum.
Of the valid cutoffs the most lenient that rejects the most bad documents is taken; a rule
without one rejects nothing.

A missing text has no words.  Documents that fail the base rule are rejected and do not take
part in the calibration.  Rows without a stratum form their own.  Repeated labels count as
often as they occur.  Without labels nothing but the base rule rejects.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsrisk.llm.common import VALUES, WHITE, as_bytes, covered, gram_hashes, span_hashes, stored, with_fields, word_spans
from newsrisk.operators.skew import join_one_per_key

ALPHA, DELTA = 0.05, 0.1
WINDOW = 8
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
#: Cutoffs by rule, from the most lenient to the strictest.
GRID = {
    "symbols_per_word": (3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1),
    "repeated_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "stuttered_words": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeated_words": (0.28, 0.26, 0.24, 0.22, 0.2, 0.18, 0.15, 0.12, 0.1),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutters")


def counts_of(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text."""
    raw = as_bytes(text)
    starts, ends = word_spans(raw)
    letters = int(np.count_nonzero(~WHITE[raw] & ((raw & 0xC0) != 0x80)))
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    repeated = 0
    words = span_hashes(VALUES[raw], starts, ends)
    if len(words) > WINDOW:
        grams = gram_hashes(words, WINDOW)
        _, back, times = np.unique(grams, return_inverse=True, return_counts=True)
        at = np.flatnonzero(times[back] > 1)
        repeated = int(covered(len(starts), at, at + WINDOW).sum()) if len(at) else 0
    stutters = int(np.count_nonzero(words[1:] == words[:-1]))
    symbols = int(np.count_nonzero(SYMBOL[raw]))
    return len(words), letters, symbols, len(lines) - len(set(lines)), repeated, len(lines), stutters


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with COUNTS; input columns of these names are replaced."""
    docs = docs.drop(*COUNTS)
    at = docs.columns.index(text)
    schema = with_fields(docs, ", ".join(f"{name} long" for name in COUNTS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts_of(t) for t in batch.column(at).to_pylist()]
            columns = zip(*found, strict=True) if found else [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(list(c), pa.int64()) for c in columns)], names=schema.names
            )

    return docs.mapInArrow(work, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def shares() -> dict[str, Column]:
    return {
        "symbols_per_word": F.col("n_symbols") / F.greatest("n_words", F.lit(1)),
        "repeated_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "stuttered_words": F.col("n_stutters") / F.greatest("n_words", F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of n trials with probability p, summed exactly in logarithms."""
    if k >= n:
        return 1.0
    i = np.arange(k, dtype=np.float64)
    steps = np.log((n - i) / (i + 1)) + math.log(p) - math.log1p(-p)
    logs = n * math.log1p(-p) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return min(1.0, math.exp(top) * float(np.exp(logs - top).sum()))


def choose(level_good: np.ndarray, level_bad: np.ndarray, alpha: float, delta: float) -> int:
    """How many cutoffs of the grid to pass over before the chosen one; -1 for no rule.

    ``level_good[i]``, ``level_bad[i]``: documents that exceed exactly the first i cutoffs'
    complement, that is the ones rejected by cutoffs i, i + 1, ... and by none before.
    """
    n, good, bad = int(level_good.sum()), 0, 0
    best, gain = -1, 0.0
    for i in range(len(level_good) - 1):
        good, bad = good + int(level_good[i]), bad + int(level_bad[i])
        if good > alpha * n or binomial_tail(good, n, alpha) > delta:
            break
        # A good document weighs as much as ten bad ones when valid cutoffs compete.
        if bad - 10 * good > gain:
            best, gain = i, bad - 10 * good
    return best


def cutoffs(rated: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, one column a rule) from ``rated`` (stratum, good, the shares by rule).

    Every labelled row counts; what is gathered is a number for each stratum, rule and cutoff.
    """
    # By rule: the first cutoff that rejects the document, or their number.
    level = lambda rule, grid: F.size(F.filter(F.lit(list(grid)), lambda c: F.col(rule) <= c))
    levels = [F.struct(F.lit(r).alias("rule"), level(r, grid).alias("level")) for r, grid in GRID.items()]
    counts = (
        rated.select("stratum", "good", F.explode(F.array(*levels)).alias("r")).select("stratum", "good", "r.*")
        .groupBy("stratum", "rule", "level")
        .agg(F.sum(F.col("good").cast("long")).alias("n_good"), F.sum((~F.col("good")).cast("long")).alias("n_bad"))
    )
    counts = stored(counts, "levels")
    tests = max(1, counts.select("stratum").distinct().count()) * len(GRID)

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        row = {"stratum": group["stratum"].iloc[0]}
        for rule, grid in GRID.items():
            own = group[group["rule"] == rule]
            good, bad = np.zeros(len(grid) + 1), np.zeros(len(grid) + 1)
            good[own["level"]], bad[own["level"]] = own["n_good"], own["n_bad"]
            at = choose(good, bad, alpha / len(GRID), delta / tests)
            row[rule] = math.inf if at < 0 else grid[at]
        return pd.DataFrame([row])

    schema = "stratum string, " + ", ".join(f"{rule} double" for rule in GRID)
    return counts.groupBy("stratum").applyInPandas(pick, schema)


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id``, COUNTS, ``stratum``, ``base_failed`` and ``kept`` for every row of ``docs``.

    ``labels`` (doc_id, quality): 1 is good.
    """
    docs = docs.select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "text")
    counted = stored(base_counts(docs).drop("text"), "counts")
    ready = counted.withColumns({**shares(), "base_failed": base_failed()})
    marks = labels.where("quality IS NOT NULL").select("doc_id", (F.col("quality") == 1).alias("good"))
    rated = ready.where("NOT base_failed").join(marks, "doc_id")
    bounds = stored(cutoffs(rated), "cutoffs").withColumnsRenamed({r: f"max_{r}" for r in GRID})
    ready = join_one_per_key(ready, bounds, ["stratum"], "left")
    kept = ~F.col("base_failed")
    for rule in GRID:
        kept = kept & (F.col(rule) <= F.coalesce(f"max_{rule}", F.lit(math.inf)))
    return ready.select("doc_id", *COUNTS, "stratum", "base_failed", kept.alias("kept"))
