"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's score is logistic in its marks (words, their beginnings, capitals, repeated
exclamation marks); a document is toxic if any of its sentences is:
1 - product(1 - score) (noisy-or).  The weights are fitted to the document labels through that
formula, so the sentences that make a document toxic are found without sentence labels.

The fit uses at most ``SAMPLE`` labelled documents a class, drawn by a hash of their id, and the
``MARKS`` marks that tell the classes apart best in them; scoring covers every sentence of
every text.  Labels, language, source and doc_id are no input of a score.

A missing text or one without words has no sentences and scores 0.  Labels other than 0 and 1
are not used; without labels of both classes every score is 0.  Rows that repeat a doc_id are
scored one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsrisk.llm.common import stored, with_fields

#: Documents a class that the fit may use, and marks it chooses from them.
SAMPLE, MARKS = 5_000, 500
#: Steps of the fit, weight of the squared weights, share of the toxic class in the likelihood.
STEPS, RIDGE, SIDE = 400, 2e-5, 0.3
TOKEN = re.compile(r"\w+|!!+")
SENTENCE = re.compile(r"[^.?\n]+")
OUT = ("score", "predicted", "offending")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(toxic, text): the labelled documents of the fit, at most ``size`` a class."""
    marks = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    picked = [
        marks.where(F.col("toxic") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for side in (0, 1)
    ]
    # At most 2 * size rows of two numbers.
    chosen = F.broadcast(stored(picked[0].union(picked[1]), "sample"))
    return stored(docs.select("doc_id", "text").join(chosen, "doc_id").select("toxic", "text"), "fit")


def marks_of(token: str) -> list[str]:
    """What a token tells: the word, its beginnings, capitals, repeated exclamation."""
    if token[0] == "!":
        return ["!!"]
    word = token.lower()
    marks = [word, *(word[:n] + "*" for n in range(4, min(8, len(word))))]
    return [*marks, "CAPITALS"] if len(token) > 1 and token.isupper() else marks


def words_of(sentence: str) -> set[str]:
    return set(TOKEN.findall(sentence))


def telling_marks(rows: DataFrame, size: int = MARKS) -> list[str]:
    """The marks of toxic documents whose document frequencies differ most between the classes (chi-square)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marks = {m for token in words_of(text or "") for m in marks_of(token)}
                found.update((m, toxic) for m in marks)
            marks, sides = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.string()), pa.array(sides, pa.int32()), pa.array(list(found.values()), pa.int64())],
                names=["mark", "toxic", "n"],
            )

    sides = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sides) < 2:
        return []
    counts = rows.select("toxic", "text").mapInArrow(count, "mark string, toxic int, n long")
    sums = counts.groupBy("mark").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
    )
    n1, n0 = float(sides[1]), float(sides[0])
    a, b = F.col("a"), F.col("b")
    gap = a * n0 - b * n1
    chi = gap * gap / ((a + b) * (n1 + n0 - a - b + 1.0))
    best = sums.where((a + b > 1) & (gap > 0)).orderBy(chi.desc(), "mark").limit(size)
    return [r.mark for r in best.select("mark").collect()]


def fit(rows: DataFrame, marks: list[str]) -> tuple[dict[str, float], float]:
    """Weights by mark and the bias of a sentence."""
    number = {m: i for i, m in enumerate(marks)}

    def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for text in batch.column(1).to_pylist():
                found = [words_of(s) for s in SENTENCE.findall(text or "")]
                bags.append([sorted({number[m] for w in s for m in marks_of(w) if m in number}) for s in found if s])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bags, pa.list_(pa.list_(pa.int32())))], names=["toxic", "bags"]
            )

    # Numbers of chosen marks only, of a bounded number of documents.
    found = rows.select("toxic", "text").mapInArrow(sentences, "toxic int, bags array<array<int>>")
    table = [(r.toxic, r.bags) for r in found.toLocalIterator() if r.bags]
    if len({t for t, _ in table}) < 2:
        return {}, -math.inf
    toxic = np.array([t for t, _ in table], float)
    size = np.array([len(b) for _, b in table])
    flat = [s for _, bags in table for s in bags]
    used = np.array([len(s) for s in flat])
    sentence = np.repeat(np.arange(len(flat)), used)
    mark = np.fromiter((m for s in flat for m in s), np.int64, int(used.sum()))
    return ascend(toxic, size, len(flat), sentence, mark, marks)


def ascend(toxic, size, n, sentence, mark, marks) -> tuple[dict[str, float], float]:
    """Gradient ascent (Adam) on the likelihood of the noisy-or; ``size`` sentences a document."""
    document = np.repeat(np.arange(len(size)), size)
    weight = np.where(toxic > 0, SIDE / max(1, toxic.sum()), (1 - SIDE) / max(1, (1 - toxic).sum()))
    theta = np.zeros(len(marks) + 1)
    theta[-1] = -math.log(max(2.0, size.mean())) - 2
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = np.bincount(sentence, theta[mark], n) + theta[-1]
        risk = np.bincount(document, np.logaddexp(0, z), len(size))  # -log(1 - P)
        # d log P / d risk for toxic documents, -1 for the others.
        slope = np.where(toxic > 0, 1 / np.maximum(np.expm1(np.minimum(risk, 50)), 1e-9), -1.0) * weight
        pull = slope[document] / (1 + np.exp(-z))
        grad = np.append(np.bincount(mark, pull[sentence], len(marks)), pull.sum())
        grad[:-1] -= RIDGE * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        theta += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return dict(zip(marks, theta[:-1].tolist(), strict=True)), float(theta[-1])


def logistic(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


class Rater:
    """Scores texts; remembers which tokens have a weight."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.seen = weights, bias, {}
        self.quiet = math.log1p(-logistic(bias))

    def marks(self, token: str) -> tuple[str, ...]:
        if (known := self.seen.get(token)) is None:
            if len(self.seen) > 500_000:
                self.seen.clear()
            known = self.seen[token] = tuple(m for m in marks_of(token) if m in self.weights)
        return known

    def rate(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The score of a text and (start, end, score) of each sentence that scores 0.5 or more."""
        clean, found = 0.0, []
        for match in SENTENCE.finditer(text or ""):
            tokens = words_of(match[0])
            if not tokens:
                continue
            marks = {m for token in tokens for m in self.marks(token)}
            if not marks:
                clean += self.quiet
                continue
            p = logistic(self.bias + sum(self.weights[m] for m in sorted(marks)))
            clean += math.log1p(-min(p, 1 - 1e-12))
            if p >= 0.5:
                found.append((match.start(), match.end(), p))
        return -math.expm1(clean), found


def score(docs: DataFrame, weights: dict[str, float], bias: float, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``offending`` sentences (start, end, score)."""
    docs = docs.drop(*OUT)
    at = docs.columns.index(text)
    schema = with_fields(docs, "score double, predicted int, offending array<struct<start:int,end:int,score:double>>")
    place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rater = Rater(weights, bias)
        for batch in batches:
            found = [rater.rate(t) for t in batch.column(at).to_pylist()]
            scores = [p for p, _ in found]
            places = [[{"start": a, "end": b, "score": p} for a, b, p in own] for _, own in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores, pa.float64()),
                    pa.array([int(p >= 0.5) for p in scores], pa.int32()),
                    pa.array(places, place),
                ],
                names=schema.names,
            )

    return docs.mapInArrow(work, schema)


def learn(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[dict[str, float], float]:
    """The fit from labelled documents that are not held out."""
    rows = sample(docs, labels.where(~held_out(F.col("doc_id"))), size)
    return fit(rows, telling_marks(rows))


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and offending for every row of ``docs``."""
    weights, bias = learn(docs, labels)
    return score(docs.select("doc_id", "text"), weights, bias).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "offending"
    )
