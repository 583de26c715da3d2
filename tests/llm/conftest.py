import pytest


@pytest.fixture()
def docs(spark):
    """``docs([(doc_id, text), ...])`` -> DataFrame in four partitions."""
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
