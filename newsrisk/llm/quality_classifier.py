"""Document quality by random indexing and a small neural network.

Random indexing: every word has a fixed sparse index vector (``NONZERO`` entries of +1 or -1 at
places drawn from a hash of the word, in ``DIM`` dimensions).  A word's context vector is the sum
of the index vectors of the words around each of its occurrences (``WINDOW`` on each side), over
all documents; the ``VOCAB`` most frequent words (counted over all documents, ties by the word)
have one.  Each task sums its own texts first, so at most ``VOCAB`` x ``DIM`` entries leave it.
A document's features are the mean of the unit context vectors of its known words and
a few measures of its shape (length, share of unknown words, letters, digits, capitals, symbols,
distinct words and repeated lines).  A network of one hidden layer (``HIDDEN`` tanh units) and a
logistic output is fitted in numpy to the labels, and its logits are divided by a temperature
fitted on a calibration fold, so that scores are calibrated probabilities.

The fit uses labelled rows whose crc32(doc_id as text) mod 4 is not 2, at most ``SAMPLE`` a class
(drawn by a hash of the doc_id, a documented bound); a fifth of them (by another hash) only
calibrates.  Labels, language, source and doc_id are never inputs of a score.  Words are runs of
letters, digits and ``_`` after lower-casing.

A missing text is empty; an empty text or one without known words has the pooled part zero and is
scored like any other.  Labels other than 0 and 1 are not used; without labelled rows of both
classes every score is the share of label 1 among the labelled rows (0.5 if there are none).
Rows that repeat a doc_id are scored one by one; input columns other than doc_id and text are
not read and do not come out.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from newsrisk.llm.common import stored

#: Dimensions, entries of an index vector, neighbours on each side, words with a vector.
DIM, NONZERO, WINDOW, VOCAB = 64, 4, 2, 1 << 13
#: Labelled documents a class that the fit may use; hidden units, steps, weight decay.
SAMPLE, HIDDEN, STEPS, DECAY = 20_000, 32, 600, 1e-3
#: Predicted 1 from this score on.
CUTOFF = 0.7
#: Words whose neighbours are summed up at a time.
LOT = 1 << 17
WORD = regex.compile(r"[\p{L}\p{N}_]+")
SHAPE = 10


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


#: Bytes of an ASCII text: capitals in lower case, blanks for what belongs to no word.
_ASCII = bytes(c if chr(c).isalnum() or chr(c) == "_" else 32 for c in bytes(range(128)).lower()) + bytes(128)
_INSIDE: list[np.ndarray] = []


def _inside() -> np.ndarray:
    """Whether each code point belongs to a word, as ``WORD`` has it."""
    if not _INSIDE:
        points = np.delete(np.arange(0x110000, dtype="<u4"), np.s_[0xD800:0xE000])
        table = np.zeros(0x110000, bool)
        table[np.frombuffer("".join(WORD.findall(points.tobytes().decode("utf-32-le"))).encode("utf-32-le"), "<u4")] = True
        _INSIDE.append(table)
    return _INSIDE[0]


def raw_words(text: str) -> tuple[list[bytes], int]:
    """``words_of`` in UTF-8, and how many code points they hold."""
    if text.isascii():
        words = text.encode().translate(_ASCII).split()
        return words, sum(map(len, words))
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    inside = _inside()[points]
    blanked = np.where(inside, points, np.uint32(32)).astype("<u4").tobytes().decode("utf-32-le")
    return blanked.encode().split(), int(np.count_nonzero(inside))


def raw_vocabulary(vocab: dict[str, int]) -> dict[bytes, int]:
    return {word.encode(): i for word, i in vocab.items()}


SALTS = [0x9E3779B9 * (j + 1) & 0xFFFFFFFF for j in range(NONZERO)]


def index_vector(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the word's index vector, from crc32 of the word with a salt."""
    raw = word.encode()
    bits = [zlib.crc32(raw, salt) for salt in SALTS]
    return np.array([b % DIM for b in bits]), np.array([1.0 if (b >> 16) & 1 else -1.0 for b in bits])


class _IndexVectors:
    """The index vectors of many words at once.

    What a salt changes in a crc32 depends on the word's length only, so one crc32 a word and
    a row for each length give them all.
    """

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.changes = np.empty((0, NONZERO), np.uint32)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sums = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        lengths = list(map(len, words))
        for n in set(lengths).difference(self.rows):
            zeros = bytes(n)
            change = [zlib.crc32(zeros, salt) ^ zlib.crc32(zeros) for salt in SALTS]
            self.rows[n] = len(self.rows)
            self.changes = np.concatenate([self.changes, np.array([change], np.uint32)])
        at = np.fromiter(map(self.rows.__getitem__, lengths), np.int64, len(words))
        bits = sums[:, None] ^ self.changes[at]
        return (bits % DIM).astype(np.int64), np.where(bits & 0x10000, 1.0, -1.0)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, combined in each batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for text in batch.column(0).to_pylist():
                found.update(raw_words(text or "")[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
            )

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, size: int = VOCAB) -> dict[str, int]:
    """The ``size`` most frequent words and their numbers (bounded by ``size``)."""
    top = word_counts(docs).orderBy(F.col("n").desc(), "word").limit(size)
    return {r.word: i for i, r in enumerate(top.collect())}


def context_vectors(docs: DataFrame, vocab: dict[str, int]) -> np.ndarray:
    """Unit context vectors of the vocabulary: sums over all documents, combined by Spark."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of the whole task: at most VOCAB x DIM entries leave it, whatever its input.
        numbers, vectors = raw_vocabulary(vocab), _IndexVectors()
        sums = np.zeros(len(vocab) * DIM, np.float64)

        def add(texts: list[list[bytes]]) -> None:
            # Blanks between the texts have no number, and no text reaches over them.
            flat = list(chain.from_iterable(texts))
            ids = np.fromiter((numbers.get(w, -1) for w in flat), np.int64, len(flat))
            places, signs = vectors(flat)
            signs[np.fromiter((not w for w in flat), bool, len(flat))] = 0
            for d in [*range(-WINDOW, 0), *range(1, WINDOW + 1)]:
                at = np.arange(max(0, -d), min(len(flat), len(flat) - d))
                at = at[ids[at] >= 0]
                spots = ids[at][:, None] * DIM + places[at + d]
                np.add(sums, np.bincount(spots.ravel(), signs[at + d].ravel(), len(sums)), out=sums)

        held, n = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = raw_words(text or "")[0]
                if len(words) < 2:
                    continue
                held += [words, [b""] * WINDOW]
                n += len(words)
                if n > LOT:
                    add(held)
                    held, n = [], 0
        if held:
            add(held)
        spot = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(spot // DIM, pa.int32()), pa.array(spot % DIM, pa.int32()), pa.array(sums[spot], pa.float64())],
            names=["id", "dim", "v"],
        )

    parts = docs.select("text").mapInArrow(gather, "id int, dim int, v double")
    summed = parts.groupBy("id", "dim").agg(F.sum("v").alias("v"))
    by_word = summed.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("dim", "v"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(DIM - 1)), lambda d: F.coalesce(F.element_at("m", d), F.lit(0.0)))
    # At most VOCAB rows of DIM numbers, as Arrow columns.
    table = by_word.select("id", dense.cast("array<float>").alias("vec")).toArrow()
    matrix = np.zeros((len(vocab), DIM), np.float32)
    if table.num_rows:
        flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix[table.column("id").to_numpy()] = flat.reshape(table.num_rows, DIM)
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norm > 0, norm, 1)


_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Bits of each code point below 2^16: letter, digit, capital, symbol; the last entry, a symbol, is for those above."""
    if not _KINDS:
        chars = [chr(c) for c in range(1 << 16)]
        tests = (str.isalpha, str.isdigit, str.isupper, lambda c: not c.isalnum() and not c.isspace())
        bits = sum(np.array([test(c) for c in chars], np.uint8) << i for i, test in enumerate(tests))
        _KINDS.append(np.append(bits, 8).astype(np.uint8))
    return _KINDS[0]


def features(text: str | None, vocab: dict[str, int], matrix: np.ndarray) -> np.ndarray:
    """Pooled context vectors and measures of shape of one text."""
    return raw_features(text or "", raw_vocabulary(vocab), matrix)


def raw_features(text: str, numbers: dict[bytes, int], matrix: np.ndarray) -> np.ndarray:
    words, letters = raw_words(text)
    known = [i for i in map(numbers.get, words) if i is not None]
    pooled = matrix[known].mean(axis=0) if known else np.zeros(DIM, np.float32)
    if text.isascii():
        points = np.frombuffer(text.encode(), np.uint8)
    else:
        points = np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), 1 << 16)
    counts = np.bincount(_kinds()[points], minlength=16)
    chars = max(1, len(points))
    lines = [x for x in text.split("\n") if x.strip()]
    shape = [
        math.log1p(len(words)),
        1 - len(known) / max(1, len(words)),
        *(int(counts[of].sum()) / chars for of in _OF),
        len(set(words)) / max(1, len(words)),
        1 - len(set(lines)) / max(1, len(lines)),
        letters / len(words) / 10 if words else 0.0,
        math.log1p(len(lines)),
    ]
    return np.concatenate([pooled, np.array(shape, np.float32)]).astype(np.float32)


#: The values of ``_kinds`` that have each bit.
_OF = [np.flatnonzero(np.arange(16) >> i & 1) for i in range(4)]


def _featurised(rows: DataFrame, vocab: dict[str, int], matrix: np.ndarray, keep: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = raw_vocabulary(vocab)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            feats = [raw_features(t or "", numbers, matrix) for t in texts]
            cols = [batch.column(k) for k in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(feats, pa.list_(pa.float32()))], names=[*keep, "x"])

    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keep)
    return rows.mapInArrow(run, f"{schema}, x array<float>")


class Network:
    """Standardised inputs, one tanh layer, a logistic output, a temperature."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature=1.0, prior=None):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2
        self.temperature, self.prior = temperature, prior

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, seed: int = 7) -> Network:
    """Fit on the rows outside ``calibrate`` (Adam, full batch), then the temperature on those in it."""
    fit, cal = ~calibrate, calibrate
    if len(set(y[fit].tolist())) < 2:
        prior = float(y.mean()) if len(y) else 0.5
        return Network(0, 1, None, None, None, None, prior=prior)
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    z = (x[fit] - mean) / scale
    t = y[fit].astype(float)
    pick = np.random.default_rng(seed)
    params = [
        pick.normal(0, 1 / math.sqrt(z.shape[1]), (z.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        pick.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN),
        np.array(math.log((t.mean() + 1e-3) / (1 - t.mean() + 1e-3))),
    ]
    moments = [np.zeros_like(p) for p in params]
    squares = [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        w1, b1, w2, b2 = params
        h = np.tanh(z @ w1 + b1)
        p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2, -50, 50)))
        g = (p - t) / len(t)
        gh = np.outer(g, w2) * (1 - h * h)
        grads = [z.T @ gh + DECAY * w1, gh.sum(axis=0), h.T @ g + DECAY * w2, np.array(g.sum())]
        for i, gr in enumerate(grads):
            moments[i] = 0.9 * moments[i] + 0.1 * gr
            squares[i] = 0.999 * squares[i] + 0.001 * gr * gr
            params[i] = params[i] - 0.01 * (moments[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, *params)
    if cal.any() and len(set(y[cal].tolist())) == 2:
        logit = net.logits(x[cal])
        tc = y[cal].astype(float)
        best = (math.inf, 1.0)
        for temp in np.exp(np.linspace(-2.5, 2.5, 101)):
            q = np.clip(1 / (1 + np.exp(-np.clip(logit / temp, -50, 50))), 1e-9, 1 - 1e-9)
            best = min(best, (float(-(tc * np.log(q) + (1 - tc) * np.log(1 - q)).mean()), float(temp)))
        net.temperature = best[1]
    return net


def learn(docs: DataFrame, labels: DataFrame, vocab: dict[str, int], matrix: np.ndarray, size: int = SAMPLE) -> Network:
    """The network, fitted to at most ``size`` labelled rows a class outside the held-out fold."""
    marks = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "quality").distinct()
    picked = [
        marks.where(F.col("quality") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for side in (0, 1)
    ]
    # At most 2 * size rows of two numbers.
    chosen = F.broadcast(stored(picked[0].union(picked[1]), "quality_sample"))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    calibrate = F.pmod(F.crc32(F.concat(F.lit("calibrate:"), F.col("doc_id").cast("string"))), F.lit(5)) == 0
    rows = rows.withColumn("cal", calibrate)
    got = _featurised(rows, vocab, matrix, ["quality", "cal"]).toArrow()
    flat = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False) if got.num_rows else np.zeros(0)
    x = flat.astype(np.float32).reshape(got.num_rows, DIM + SHAPE)
    y = got.column("quality").to_numpy().astype(np.int64)
    cal = got.column("cal").to_numpy(zero_copy_only=False).astype(bool)
    return train(x, y, cal)


def score(docs: DataFrame, net: Network, vocab: dict[str, int], matrix: np.ndarray, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = raw_vocabulary(vocab)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            x = np.array([raw_features(t or "", numbers, matrix) for t in texts], np.float32).reshape(len(texts), DIM + SHAPE)
            s = net.score(x).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= cutoff).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def classify(docs: DataFrame, labels: DataFrame, vocab_size: int = VOCAB, size: int = SAMPLE) -> DataFrame:
    """Vocabulary, context vectors and network from the corpus and labels, then every row scored."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vocab = vocabulary(docs, vocab_size)
    matrix = context_vectors(docs, vocab)
    net = learn(docs, labels, vocab, matrix, size)
    return score(docs, net, vocab, matrix)
