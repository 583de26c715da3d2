"""Joining many rows to one row per key when a single key may own a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

_HASH = "_key_hash"


def join_one_per_key(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str
) -> DataFrame:
    """``rows`` joined null-safely to ``lookup``, which holds at most one row per key.

    ``how`` is ``left``, ``left_semi`` or ``left_anti``.  No side is forced to broadcast;
    Spark does that when the measured size of ``lookup`` permits.  Otherwise it is a sort
    merge join, and a hot key makes one very large partition of ``rows``.  AQE splits such a
    partition, but only if both inputs of the join are shuffles made for that join.
    ``lookup`` usually comes from an aggregation on the same keys, whose partitioning would
    be reused and would switch the split off.  The extra hash key prevents that reuse: the
    short lookup side is shuffled again, and hot partitions of ``rows`` can be split.
    """
    hashed = F.xxhash64(*[F.col(k) for k in keys])
    left = rows.withColumn(_HASH, hashed)
    right = lookup.select(
        hashed.alias(f"_r{_HASH}"),
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in lookup.columns],
    )
    condition = reduce(
        and_,
        [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys],
        F.col(_HASH) == F.col(f"_r{_HASH}"),
    )
    return left.join(right, condition, how).drop(
        _HASH, f"_r{_HASH}", *[f"_r_{k}" for k in keys]
    )
