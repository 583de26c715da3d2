"""Phrase collocations: frequent phrases whose words occur together more than chance says.

Texts (a missing one is empty) are lower-cased in A-Z, cut at ``[.,;:!?\\x0A-\\x0D]`` into
pieces and those into words ``[^\\x20\\x09]+``.  Per language (a missing one is ``und``): n is the
number of words, f(phrase) the number of its contiguous occurrences within pieces (overlapping
ones too).  Candidates are phrases of 2 to 5 words with a = f(phrase) >= ``LEAST``.  A cut after
the first k words scores floor(1000 * a * n / (l * r)) with l and r the counts of the two parts;
the lowest-scoring cut counts, ties to the smallest k.  A candidate that lies inside a longer
candidate counted at least as often goes.  Each language keeps its first ``TOP`` by score, a
(both descending) and phrase (ascending, words joined by a space, in UTF-8 byte order).

Counting goes level by level, Apriori-like: a phrase of m words is counted only where both of
its parts of m - 1 words are frequent.  Frequent words and phrases get numbers (``numbered``),
and the texts become the numbers found at their places (``places``, level by level fewer).  A
phrase of m words is then exactly the pair of numbers of its parts of m - 1 words, one 64-bit
key; tasks add up the keys of their places and send them packed by bucket (``pair_counts``),
words travel for frequent phrases only (see ``counts``).  The rest runs on the counts of at
least ``LEAST`` only, as two streams: one sorted in prefix order (phrase by phrase, a phrase
right behind its prefixes and followed by its extensions), one in suffix order (the same on the
reversed words).  Each stream is walked once with a stack of at most five phrases, which gives,
without any hashing, the count of every prefix (l), of every suffix (r) and of the largest
extension to the right and to the left.  As f can only shrink when a phrase grows, a candidate
lies inside a longer candidate of at least its count exactly when one of its one-word extensions
has its count.  The streams are laid out by ranges of the phrase order; a range starts with the
prefixes of its first phrase open on the stack, whose counts are looked up after the walk (at
most four phrases a range).

Scores are computed with decimals of 38 digits and an integral division, so they are exact for
all inputs up to 10^13 words a language.  Rows with extra columns keep none of them; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newsrisk.llm.common import mix, stored

#: Fixed values of the contract: upper and lower case, longest phrase, least count, rows a language.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST, LEAST, TOP = 5, 100, 2000

OUT = "lang string, phrase array<string>, f long, parts array<long>, ext long, seeded boolean"

#: Stands between pieces; no byte of UTF-8.  Bytes split at blanks, tabs and (gone by then) 10 to 13.
BREAK = b"\xff"
_BYTES = bytes.maketrans((UPPER + ".,;:!?\n\x0b\x0c\r").encode(), LOWER.encode() + BREAK * 10)
#: Distinct words, and distinct keys, that a task holds before it sends their counts.
HELD_WORDS, HELD_KEYS = 1 << 18, 1 << 21
#: Places in a row of numbers; occurrences that a bucket is made for; parts that get numbers apart.
CHUNK, BUCKET, PARTS = 1 << 16, 500_000, 64


def tokens(text: bytes) -> list[bytes]:
    """The words of a text in order, ``BREAK`` between pieces."""
    return text.translate(_BYTES).replace(BREAK, b" \xff ").split()


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed bytes, all lowest bytes first, without the high zero bytes."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    low = values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + zlib.compress(low.T.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    low = np.frombuffer(zlib.decompress(packed[1:]), np.uint8).reshape(packed[0], -1)
    values = np.zeros((low.shape[1], 8), np.uint8)
    values[:, : packed[0]] = low.T
    return values.view("<i8").ravel()


def add_up(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their ``times``."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    return keys[first], np.add.reduceat(times[order], first) if len(first) else times


def gathered(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, times = zip(*parts, strict=True) if parts else ([np.empty(0, np.int64)],) * 2
    return add_up(np.concatenate(keys), np.concatenate(times))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, f) of a task's texts; without a word: the number of all words."""
    seen: dict[str, Counter] = {}
    held = 0

    def rows() -> pa.RecordBatch:
        out = []
        for lang, times in seen.items():
            times.pop(BREAK, 0)
            out += [(lang, None, times.total()), *((lang, w, f) for w, f in times.items())]
        columns = list(zip(*out, strict=True)) if out else [[]] * 3
        types = [pa.string(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "word", "f"]
        )

    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            times = seen.setdefault(lang, Counter())
            before = len(times)
            times.update(tokens(text))
            held += len(times) - before
            if held > HELD_WORDS:
                yield rows()
                seen, held = {}, 0
    yield rows()


def numbered(table: DataFrame, *key: str) -> DataFrame:
    """``table``, one row a ``key``, with ``id``: 1, 2, 3 and so on without gaps."""
    part = F.pmod(F.xxhash64(*key), F.lit(PARTS))
    table = stored(table.withColumn("_part", part), "collocation_table")
    before, starts = 0, []
    for row in table.groupBy("_part").count().orderBy("_part").collect():
        starts.append((row["_part"], before))
        before += row["count"]
    starts = table.sparkSession.createDataFrame(starts, "_part long, _before long")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*key))
    ranked = table.withColumn("_rank", rank).join(F.broadcast(starts), "_part")
    return stored(ranked.withColumn("id", F.col("_before") + F.col("_rank")).drop("_part", "_before", "_rank"), "collocation_ids")


def _slices(table: DataFrame, small: int) -> tuple[list[DataFrame], int]:
    """``table`` in slices of at most ``small`` numbers, and its number of rows."""
    size = table.count()
    return [table.where(F.col("id").between(a + 1, a + small)) for a in range(0, size, small)], size


def _joined(found: np.ndarray) -> np.ndarray:
    """Numbers with one 0 for each run of zeros: neighbours stay neighbours."""
    keep = found > 0
    keep[1:] |= found[:-1] > 0
    return found[keep]


def _packed(rows: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of numbers as batches of rows of about ``CHUNK`` places; a 0 parts what is put together."""
    held, size = [], 0
    for row in rows:
        if row.any():
            held += [row, np.zeros(1, np.int64)]
            size += len(row) + 1
        if size >= CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array([pack(np.concatenate(held))], pa.binary())], names=["ids"])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([pack(np.concatenate(held))], pa.binary())], names=["ids"])


def _placed(rows: DataFrame, table: DataFrame, small: int, load: Callable, look: Callable, name: str) -> DataFrame:
    """(ids): for each place of ``rows`` the number in ``table`` of what lies there, or 0.

    ``load`` makes of a slice of ``table`` (an Arrow table) what ``look(loaded, *row)`` searches.
    Of a table of more than ``small`` rows one slice is looked up at a time; the rows keep what
    was found so far.
    """
    slices, _ = _slices(table, small)
    sources = rows.columns
    for at, piece in enumerate(slices):
        shared = table.sparkSession.sparkContext.broadcast(load(piece.toArrow()))
        last = at == len(slices) - 1

        def found(batches: Iterator[pa.RecordBatch], shared=shared, first=at == 0) -> Iterator[tuple]:
            for batch in batches:
                for row in zip(*batch.columns, strict=True):
                    row = tuple(x.as_py() for x in row)
                    row, so_far = (row, None) if first else (row[:-1], row[-1])
                    ids = look(shared.value, *row)
                    yield row, ids if so_far is None else ids + unpack(so_far)

        def close(batches: Iterator[pa.RecordBatch], found=found) -> Iterator[pa.RecordBatch]:
            return _packed(_joined(ids) for _, ids in found(batches))

        def carry(batches: Iterator[pa.RecordBatch], found=found, types=rows.schema) -> Iterator[pa.RecordBatch]:
            kinds = [pa.string() if f.dataType.typeName() == "string" else pa.binary() for f in types][: len(sources)]
            for row, ids in found(batches):
                columns = [pa.array([x], kind) for x, kind in zip((*row, pack(ids)), (*kinds, pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[*sources, "_found"])

        if last:
            return stored(rows.mapInArrow(close, "ids binary"), name)
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in sources)
        rows = stored(rows.mapInArrow(carry, f"{ddl}, _found binary"), name)
    return table.sparkSession.createDataFrame([], "ids binary")


def _load_words(slice_: pa.Table) -> dict[str, dict[bytes, int]]:
    ids: dict[str, dict[bytes, int]] = {}
    for lang, word, number in zip(*(slice_[c].to_pylist() for c in ("lang", "word", "id")), strict=True):
        ids.setdefault(lang, {})[word] = number
    return ids


def _look_words(ids: dict[str, dict[bytes, int]], lang: str, text: bytes) -> np.ndarray:
    words = tokens(text)
    return np.fromiter(map(ids.get(lang, {}).get, words, repeat(0)), np.int64, len(words))


def _load_keys(slice_: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, ids = (slice_[c].to_numpy() for c in ("key", "id"))
    order = np.argsort(keys)
    return keys[order], ids[order]


def _keys(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the neighbours in ``ids`` that both have a number."""
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    return at, (ids[at] << 32) | ids[at + 1]


def _look_keys(table: tuple[np.ndarray, np.ndarray], packed: bytes) -> np.ndarray:
    ids = unpack(packed)
    found = np.zeros(len(ids), np.int64)
    at, keys = _keys(ids)
    hit = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    found[at] = np.where(table[0][hit] == keys, table[1][hit], 0)
    return found


def pair_counts(places: DataFrame, buckets: int, least: int) -> DataFrame:
    """(key, f): the pairs of neighbours that occur at least ``least`` times.

    A task adds up its keys and sends them by bucket (a hash), as packed differences and counts;
    a bucket is added up by one task.
    """

    def send(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, times = gathered(parts)
        bucket = (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keys, times, bucket = keys[order], times[order], bucket[order]
        start = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(start[1:], len(keys))
        for a in range(0, len(start), 256):
            spans = list(zip(start[a : a + 256].tolist(), ends[a : a + 256].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[start[a : a + 256]], pa.int32()),
                    pa.array([pack(np.diff(keys[i:j], prepend=0)) for i, j in spans], pa.binary()),
                    pa.array([pack(times[i:j]) for i, j in spans], pa.binary()),
                ],
                names=["bucket", "keys", "times"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, raw, held, waiting = [], [], 0, 0
        for batch in batches:
            for packed in batch.column(0):
                raw.append(_keys(unpack(packed.as_py()))[1])
                waiting += len(raw[-1])
                if waiting < HELD_KEYS // 2:
                    continue
                parts.append(np.unique(np.concatenate(raw), return_counts=True))
                held += len(parts[-1][0])
                raw, waiting = [], 0
                if held > HELD_KEYS:
                    parts = [gathered(parts)]
                    held = len(parts[0][0])
                    if held > HELD_KEYS // 2:
                        yield from send(parts)
                        parts, held = [], 0
        if raw:
            parts.append(np.unique(np.concatenate(raw), return_counts=True))
        yield from send(parts)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, last = [], 0, None

        def frequent() -> pa.RecordBatch:
            keys, times = gathered(parts)
            keep = times >= least
            return pa.RecordBatch.from_arrays([pa.array(keys[keep], pa.int64()), pa.array(times[keep], pa.int64())], names=["key", "f"])

        for batch in batches:
            for bucket, keys, times in zip(*batch.columns, strict=True):
                if bucket.as_py() != last:
                    yield frequent()
                    parts, held, last = [], 0, bucket.as_py()
                parts.append((np.cumsum(unpack(keys.as_py())), unpack(times.as_py())))
                held += len(parts[-1][0])
                if held > HELD_KEYS:
                    parts = [gathered(parts)]
                    held = len(parts[0][0])
        yield frequent()

    sent = places.mapInArrow(count, "bucket int, keys binary, times binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(total, "key long, f long")


def counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, small: int = 1 << 21) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to ``longest`` words with f >= ``least``, and (lang, n).

    Level by level: an m-word phrase is counted only where its first and its last m - 1 words
    are frequent, as no other can be (f only shrinks as a phrase grows).  Both are known at
    each place by number, so a phrase is one exact 64-bit key.  Tasks get at most ``small``
    frequent words or phrases at a time; if there are more, the places are looked up in passes.
    """
    texts = docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    words = texts.mapInArrow(_word_counts, "lang string, word binary, f long").groupBy("lang", "word")
    words = stored(words.agg(F.sum("f").alias("f")).where(F.col("word").isNull() | (F.col("f") >= least)), "collocation_words")
    n = words.where(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    table = numbered(words.where(F.col("word").isNotNull()), "lang", "word")
    level = table.select("id", "lang", F.array(F.col("word").cast("string")).alias("phrase"), "f")
    found = level
    buckets = (n.agg(F.sum("n")).first()[0] or 0) // BUCKET + 16
    places = _placed(texts, table, small, _load_words, _look_words, "collocation_places")
    for m in range(2, longest + 1):
        table = numbered(pair_counts(places, buckets, least), "key")
        head = level.select(F.col("id").alias("_head"), "lang", "phrase")
        tail = level.select(F.col("id").alias("_tail"), F.element_at("phrase", -1).alias("_last"))
        pairs = table.select(
            "id", "f", F.shiftright("key", 32).alias("_head"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("_tail")
        )
        level = pairs.join(head, "_head").join(tail, "_tail").select(
            "id", "lang", F.concat("phrase", F.array("_last")).alias("phrase"), "f"
        )
        level = stored(level, "collocation_level")
        found = found.unionByName(level)
        if m < longest:
            places = _placed(places, table, small, _load_keys, _look_keys, "collocation_places")
    return found.select("lang", "phrase", "f"), n


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases in stream order to (lang, phrase, f, parts, ext, seeded).

    ``parts`` are the counts of the phrase's proper prefixes by length, ``ext`` the largest count
    of a one-word extension in this range (0 if none).  The stack holds the prefixes of the
    current phrase.  Those that an earlier range left open (the prefixes of the range's first
    phrase) stand on it with an unknown count: they come out with ``seeded``, and the parts
    they give are null until ``_fill``.
    """
    stack: list[list] = []  # [lang, words, f, ext, seeded]
    out: list[list] = []

    def pop() -> None:
        lang, words, f, ext, seeded = stack.pop()
        out.append([lang, words, f, [s[2] for s in stack], ext, seeded])

    first = True
    for batch in batches:
        for lang, words, f in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if first:
                stack = [[lang, words[:k], None, 0, True] for k in range(1, len(words))]
                first = False
            while stack and (stack[-1][0] != lang or stack[-1][1] != words[: len(stack[-1][1])]):
                pop()
            if stack and len(stack[-1][1]) == len(words) - 1:
                stack[-1][3] = max(stack[-1][3], f)
            stack.append([lang, words, f, 0, False])
            if len(out) >= 4096:
                yield _batch(out)
                out = []
    while stack:
        pop()
    yield _batch(out)


def _fill(batches: Iterator[pa.RecordBatch], seeds: dict) -> Iterator[pa.RecordBatch]:
    """Null parts (prefixes an earlier range left open) from their counts."""
    for batch in batches:
        rows = [list(r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        for row in rows:
            lang, words, parts = row[0], row[1], row[3]
            if None in parts:
                row[3] = [seeds[(lang, tuple(words[: i + 1]))] if x is None else x for i, x in enumerate(parts)]
        yield _batch(rows)


def _batch(rows: list[list]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
    types = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["lang", "phrase", "f", "parts", "ext", "seeded"]
    )


def stream(frequent: DataFrame, reverse: bool) -> DataFrame:
    """(lang, phrase, f, parts, ext): one walk over ``frequent`` in prefix order, or suffix order.

    The phrases are range-partitioned by (lang, key) and sorted within each range.  The
    prefixes that a range finds open (at most ``LONGEST - 1``) are looked up in the counts after
    the walk, from the walk's own output, and the extensions they meet are merged.
    """
    keyed = frequent.select("lang", (F.reverse("phrase") if reverse else F.col("phrase")).alias("phrase"), "f")
    laid = keyed.repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    walked = stored(laid.mapInArrow(_walk, OUT), "collocation_walk")
    # The prefixes that ranges found open: at most LONGEST - 1 rows a range.
    later = walked.where("seeded").groupBy("lang", "phrase").agg(F.max("ext").alias("later"))
    later = stored(later, "collocation_open")
    seeds = {(r.lang, tuple(r.phrase)): r.f for r in keyed.join(later, ["lang", "phrase"]).collect()}
    own = walked.where(~F.col("seeded")).mapInArrow(lambda batches: _fill(batches, seeds), OUT)
    whole = own.join(F.broadcast(later), ["lang", "phrase"], "left")
    whole = whole.select(
        "lang",
        F.reverse("phrase").alias("phrase") if reverse else "phrase",
        "f",
        "parts",
        F.greatest("ext", F.coalesce("later", F.lit(0))).alias("ext"),
    )
    return whole


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best ``top`` candidates."""
    frequent, n = counts(docs, least, longest)
    ahead = stream(frequent, reverse=False).select(
        "lang", "phrase", "f", F.col("parts").alias("lefts"), F.col("ext").alias("right_ext")
    )
    behind = stream(frequent, reverse=True).select(
        "lang", "phrase", F.col("parts").alias("rights"), F.col("ext").alias("left_ext")
    )
    both = ahead.where(F.size("phrase") >= 2).join(behind, ["lang", "phrase"]).join(F.broadcast(n), "lang")
    kept = both.where((F.col("right_ext") < F.col("f")) & (F.col("left_ext") < F.col("f")))
    m = F.size("phrase")
    big = "decimal(38,0)"
    cut = F.transform(
        F.sequence(F.lit(1), m - 1),
        lambda k: F.struct(k.alias("k"), F.element_at("lefts", k).alias("l"), F.element_at("rights", m - k).alias("r")),
    )
    rows = kept.select("lang", "phrase", F.col("f").alias("a"), "n", F.explode(cut).alias("c")).select(
        "lang", "phrase", "a", "n", "c.k", "c.l", "c.r",
        F.expr(f"cast(1000 * a as {big}) * cast(n as {big}) div (cast(c.l as {big}) * cast(c.r as {big}))").alias("score"),
    )
    best = rows.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    text = F.array_join("phrase", " ")
    order = Window.partitionBy("lang").orderBy(F.col("b.score").desc(), F.col("a").desc(), text.asc())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        text.alias("phrase"),
        F.col("a").cast("long").alias("a"),
        F.col("b.l").cast("long").alias("l"),
        F.col("b.r").cast("long").alias("r"),
        F.col("n").cast("long").alias("n"),
        F.col("b.score").cast("long").alias("score"),
    )
