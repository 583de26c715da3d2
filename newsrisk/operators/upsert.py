"""Change-detecting keyed upsert of a mart into an external table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from newsrisk.functions.dates import stringify_dates

APPEND, UPDATE, SKIP = "append", "update", "skip"


@dataclass(frozen=True)
class UpsertSpec:
    """Where a mart goes and how changes are noticed.

    ``change_columns`` decide between update and skip.  ``row_column``, when the target has
    one, is its row address; it is handed through so that a writer can update in place.
    """

    worksheet: str
    key: str
    change_columns: tuple[str, ...]
    row_column: str | None = None


# Only the daily mart is delivered; coarser marts are derived by the receiver.
EXPORTS: dict[str, UpsertSpec] = {
    "daily": UpsertSpec("daily_data", "published_date", ("total_articles",)),
}


def export_spec(mart: str) -> UpsertSpec:
    """The registered spec, or a ``KeyError`` that names the known marts."""
    if mart not in EXPORTS:
        raise KeyError(f"unknown mart {mart!r}; registered: {sorted(EXPORTS)}")
    return EXPORTS[mart]


def tolerant_int(value: Column) -> Column:
    """Integer value of a number or text; 0 when it is missing or not an integer."""
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def export_rows(mart: DataFrame, key: str) -> DataFrame:
    """The mart as delivered: dates as text, missing numbers as 0, key order."""
    return stringify_dates(mart).fillna(0).orderBy(F.asc_nulls_last(key))


def _target_state(target: DataFrame, spec: UpsertSpec) -> DataFrame:
    """Key and change columns of the target, one row a key.

    A target that lists a key twice keeps the row with the greatest address, which is the one
    to update.  Without addresses no row is the last one, so a key listed twice raises.
    """
    columns = [tolerant_int(F.col(c)).alias(c) for c in spec.change_columns]
    key = F.col(spec.key).cast("string").alias("_key")
    if spec.row_column:
        address = F.col(spec.row_column).cast("bigint").alias("target_row")
        last = F.max(F.struct(address, *columns)).alias("_state")
        return target.groupBy(key).agg(last).withColumn("target_row", F.col("_state.target_row"))
    grouped = target.groupBy(key).agg(F.first(F.struct(*columns)).alias("_state"), F.count("*").alias("_n"))
    twice = F.raise_error(F.concat(F.lit("the target lists a key twice and has no row column: "), "_key"))
    return grouped.where(F.when(F.col("_n") > 1, twice).otherwise(True)).drop("_n")


def plan_upsert(mart: DataFrame, target: DataFrame, spec: UpsertSpec) -> DataFrame:
    """Mart rows as they would be delivered, plus ``action``.

    ``append``: the key is not in the target.  ``update``: it is, and a change column
    differs (both read as tolerant integers).  ``skip``: nothing to do.  ``target_row``, where
    the target has addresses, is NULL for rows to append.
    """
    rows = stringify_dates(mart)
    state = _target_state(target, spec)
    joined = rows.join(state, rows[spec.key] == state["_key"], "left")
    action = F.when(F.col("_key").isNull(), APPEND).when(_changed(spec), UPDATE).otherwise(SKIP)
    planned = joined.withColumn("action", action).drop("_key", "_state")
    return planned.fillna(0, subset=list(mart.columns))


def _changed(spec: UpsertSpec, prefix: str = "") -> Column:
    changed = F.lit(False)
    for c in spec.change_columns:
        changed = changed | (tolerant_int(F.col(prefix + c)) != F.col(f"_state.{c}"))
    return changed


def apply_upsert(mart: DataFrame, target: DataFrame, spec: UpsertSpec) -> DataFrame:
    """The target after the upsert: appended and updated rows replace, the rest stays.

    One outer join by key, so mart and target are each read once.  With a row column, the last
    row of a key decides and an update leaves one row of it; without one, a key that the target
    lists twice raises, as in ``plan_upsert``.
    """
    columns = list(mart.columns)
    new = stringify_dates(mart).fillna(0).select(F.struct(*columns).alias("new"), F.col(spec.key).alias("_new"))
    old = stringify_dates(target).withColumn("_old", F.col(spec.key).cast("string"))
    state = [tolerant_int(F.col(c)).alias(c) for c in spec.change_columns]
    old = old.select(F.struct(*columns).alias("old"), "_old", F.struct(*state).alias("_state"), *(
        [F.col(spec.row_column).alias("_row")] if spec.row_column else [F.lit(0).alias("_row")]
    ))
    last = Window.partitionBy("_old").orderBy(F.desc("_row"))
    if spec.row_column:
        # The last row of a key decides, and an update leaves one row of it.
        old = old.withColumn("_rank", F.row_number().over(last)).withColumn("_state", F.first("_state").over(last))
    else:
        twice = F.raise_error(F.concat(F.lit("the target lists a key twice and has no row column: "), "_old"))
        listed = F.count("*").over(Window.partitionBy("_old"))
        old = old.withColumn("_rank", F.when(listed > 1, twice).otherwise(F.lit(1)).cast("int"))
    both = old.join(new, F.col("_old") == F.col("_new"), "full_outer")
    replaced = F.col("_new").isNotNull() & (F.col("_old").isNull() | _changed(spec, "new."))
    kept = both.where(~replaced | (F.coalesce("_rank", F.lit(1)) == 1))
    pick = [F.when(replaced, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in columns]
    return kept.select(*pick)


def deliver(plan: DataFrame, send: Callable[[Iterable[Row]], None]) -> None:
    """Hand the rows to write to ``send``, one call per partition, from the executors."""
    plan.where(F.col("action") != SKIP).foreachPartition(send)
