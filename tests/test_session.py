import pytest

from newsrisk.session import scratch_path, spread


class Session:
    """Just enough of a session to ask for its settings."""

    def __init__(self, master, settings):
        self.conf = type("Conf", (), {"get": staticmethod(settings.get)})()
        self.sparkContext = type("Context", (), {"master": master})()


def test_scratch_is_below_the_shared_folder():
    shared = Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = (scratch_path(shared, "daily") for _ in range(2))
    assert first.startswith("hdfs:///shared/daily-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session("spark://host:7077", {}), "daily")


def test_local_sessions_fall_back_to_a_temporary_folder():
    assert "newsrisk-" in scratch_path(Session("local[2]", {}), "daily")


def test_spread_only_touches_tables_of_few_partitions(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(10, numPartitions=1), spark.range(10, numPartitions=cores + 1)
    assert spread(few).rdd.getNumPartitions() == cores
    assert spread(many) is many
