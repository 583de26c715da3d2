"""Files that each hold one JSON array of flat objects, read in byte ranges by many tasks.

A file is read as text records that end at ``}``, so Hadoop's line reader cuts it at byte
ranges like any text file.  A ``}`` inside a string does not end an object; whether a record
starts inside a string follows from the parity of the quotes before it that are not escaped (a
quote behind an even run of backslashes).  Each task walks the records of its ranges in order
and counts, for both states a range may start in, the parity and the object ends before each
record.  One row per range then carries its totals; a window over the ranges of a file (a few
rows a GB) gives each range the state at its start and the number of objects before it.
Records that were cut inside a string are joined to their object by (file, object number);
all others pass on as they are, without a shuffle.

Objects must be flat (no object or array inside), as articles are.  A file must hold one array:
anything but ``[`` before the first element, elements not separated by commas, a file that does
not end with ``]`` (and whitespace), raise, as do nested and broken objects when they are
parsed.  A file of whitespace only, and ``[]``, give no rows.  ``position`` is the byte offset
of the object's range plus its record number in that range, so it grows with the place of the
object in its file, whatever the sizes of the ranges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, Window, functions as F

_QUOTE = re.compile(r'(\\*)"')
_HEAD = r"^\s*[\[,]\s*\{"
_FIRST = r"^\s*\[\s*\{"
_TAIL = r"^\s*(\[\s*)?\]\s*$"
_LEAD = r"^\s*[\[,]\s*"

WALKED = (
    "value string, file_name string, file_path string, block long, seq long, "
    "before int, own int, ends_out long, ends_in long"
)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per record, in the order of its range: its number there, the parity of the unescaped
    quotes before it in the range and of its own, and the object ends before it in the range if
    the range starts outside a string (``ends_out``) or inside one (``ends_in``)."""
    at, seq, before, ends = None, 0, 0, [0, 0]
    for batch in batches:
        values = batch.column("value").to_pylist()
        places = zip(batch.column("file_path").to_pylist(), batch.column("block").to_pylist(), strict=True)
        cols: list[list[int]] = [[], [], [], [], []]
        for value, place in zip(values, places, strict=True):
            if place != at:
                at, seq, before, ends = place, 0, 0, [0, 0]
            own = sum(len(m.group(1)) % 2 == 0 for m in _QUOTE.finditer(value)) % 2
            for col, v in zip(cols, (seq, before, own, ends[0], ends[1]), strict=True):
                col.append(v)
            seq += 1
            before ^= own
            # The record ends an object when the parity after it, with the range's start, is 0.
            ends[before] += 1
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("value"),
                batch.column("file_name"),
                batch.column("file_path"),
                batch.column("block"),
                *(pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()], strict=True)),
            ],
            names=["value", "file_name", "file_path", "block", "seq", "before", "own", "ends_out", "ends_in"],
        )


def array_objects(reader: DataFrameReader, path: str, pattern: str = "*.json") -> DataFrame:
    """(object, file_name, file_path, position): every element of the array files below ``path``."""
    records = (
        reader.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("lineSep", "}")
        .text(path)
        .select("value", "_metadata.file_name", "_metadata.file_path", F.col("_metadata.file_block_start").alias("block"))
    )
    walked = records.mapInArrow(_walk, WALKED)
    after = F.col("before").bitwiseXOR(F.col("own"))
    tail = F.col("value").rlike(_TAIL) | F.col("value").rlike(r"^\s*$")
    ranges = walked.groupBy("file_path", "block").agg(
        (F.sum("own") % 2).cast("int").alias("parity"),
        F.sum((after == 0).cast("long")).alias("total_out"),
        F.sum((after == 1).cast("long")).alias("total_in"),
        F.max_by(tail, "seq").alias("tail_last"),
    )
    file = Window.partitionBy("file_path").orderBy("block")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("start", F.coalesce(F.sum("parity").over(earlier) % 2, F.lit(0)).cast("int"))
    ranges = ranges.withColumn("ends", F.when(F.col("start") == 0, F.col("total_out")).otherwise(F.col("total_in")))
    ranges = ranges.select(
        "file_path",
        "block",
        "start",
        F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("ends_before"),
        F.last("tail_last").over(file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("closed"),
    )
    # One row per byte range of the input (``spark.sql.files.maxPartitionBytes`` each at most).
    placed = walked.join(F.broadcast(ranges), ["file_path", "block"])

    start_in = F.col("start").bitwiseXOR(F.col("before"))
    end_in = start_in.bitwiseXOR(F.col("own"))
    number = F.col("ends_before") + F.when(F.col("start") == 0, F.col("ends_out")).otherwise(F.col("ends_in"))
    first = (F.col("block") == 0) & (F.col("seq") == 0)
    wrong = (start_in == 0) & ~tail & (~F.col("value").rlike(_HEAD) | (first & ~F.col("value").rlike(_FIRST)))
    refuse = F.raise_error(F.concat(F.lit("not one JSON array: "), F.col("file_name")))
    kept = placed.where((start_in == 1) | ~tail | ~F.col("closed")).select(
        F.when(wrong | ~F.col("closed"), refuse).otherwise(F.col("value")).alias("value"),
        "file_name",
        "file_path",
        (F.col("block") + F.col("seq")).alias("position"),
        start_in.alias("start_in"),
        end_in.alias("end_in"),
        number.alias("number"),
    )
    whole = kept.where((F.col("start_in") == 0) & (F.col("end_in") == 0)).select(
        F.concat(F.regexp_replace("value", _LEAD, ""), F.lit("}")).alias("object"), "file_name", "file_path", "position"
    )
    # Objects with a } inside a string: their records meet by (file, object number).
    cut = kept.where((F.col("start_in") == 1) | (F.col("end_in") == 1))
    joined = cut.groupBy("file_path", "number").agg(
        F.first("file_name").alias("file_name"),
        F.min("position").alias("position"),
        F.array_sort(F.collect_list(F.struct("position", "value"))).alias("parts"),
    )
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}"))
    rest = joined.select(F.regexp_replace(text, _LEAD, "").alias("object"), "file_name", "file_path", "position")
    return whole.unionByName(rest)
