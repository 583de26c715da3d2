"""Article files landing in a folder, loaded as a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from newsrisk.sources.articles import article_rows, stamp_batch
from newsrisk.sources.bronze import ingest


def stream_articles(
    spark: SparkSession,
    path: str,
    format: str = "lines",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Articles of every file that appears below ``path``, with the file they came from.

    It refuses what a batch refuses: malformed JSON and unknown fields.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return article_rows(reader, path, format, strict=True)


def start_ingest(
    spark: SparkSession,
    path: str,
    bronze_path: str,
    checkpoint: str,
    as_of: dt.date | str,
    format: str = "lines",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Load everything that has landed, then stop; start again to load what came since.

    A micro-batch that is replayed after a failure finds its rows in bronze and adds
    nothing, so delivery is effectively once.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        ingest(batch.sparkSession, stamp_batch(batch, as_of), bronze_path)

    stream = stream_articles(spark, path, format, max_files_per_trigger)
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
