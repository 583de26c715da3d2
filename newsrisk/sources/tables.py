"""Stored tables that may not exist before their first load."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table at ``path`` with ``schema``; no rows when there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
