"""What several operators share: stored intermediates, words, hashes, interval sets.

The functions on bytes run inside Spark tasks, on one text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from newsrisk.session import discard, scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stands for a missing doc_id where an order is needed: behind all others.
LAST = 2**63 - 1
#: Rows of a few numbers that one task of a bounded table writes.
FILE_ROWS = 100_000
#: Columns that operators add for themselves; input columns of these names are lost.
KEY, CUTS = "_llm_key", "_llm_cuts"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def stored(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: a cut of the lineage.

    The shuffle files of the write go as soon as it ends; nothing after it needs them.
    ``most`` is a bound of its rows, if one is known and they are short: one file for each
    ``FILE_ROWS`` then, however many partitions a shuffle has.  Every file costs a task, and on a
    local file system processes that the executor starts to set its mode.
    """
    if most is not None:
        df = df.coalesce(most // FILE_ROWS + 1)
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def freed(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing reads any more."""
    for table in tables:
        discard(table.sparkSession, *{name.rpartition("/")[0] for name in table.inputFiles()})


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that a task makes Python objects of few texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` and more fields behind it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A long that tells rows apart, also rows that repeat a doc_id with another text."""
    return F.xxhash64(F.col(doc_id), F.col(text))


# -- bytes -----------------------------------------------------------------------------------

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


VALUES = mix(np.arange(1, 257, dtype=np.uint64))
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 2**64)
TABLES: dict[str, np.ndarray] = {}


def powers(n: int, name: str, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = TABLES.get(name)
    if have is None or len(have) < n:
        size = max(n, 4096, 2 * (0 if have is None else len(have)))
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = TABLES[name] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every span, from one running sum."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(n, "up", BASE), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(n + 1, "down", UNBASE)[starts])


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text (an array of bytes) start and end."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~WHITE[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive values; none where there are fewer."""
    at = np.arange(max(0, len(values) - k + 1))
    return span_hashes(values, at, at + k)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mask of n units with those in any [start, end) set."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.clip(starts, 0, n), 1)
    np.add.at(change, np.clip(ends, 0, n), -1)
    return np.cumsum(change[:-1]) > 0
