import pytest

from tablesync.errors import SyncError
from tablesync.session import scratch_dir, scratch_root, shuffle_partitions, wide_shuffles


def test_scratch_lives_where_the_session_says(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


class Unset:
    """A session of a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(SyncError, match="spark.checkpoint.dir"):
        scratch_root(Unset)


def test_shuffle_partitions(spark):
    assert shuffle_partitions(100 << 40) == 819_200
    assert shuffle_partitions(0) == 1
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with wide_shuffles(spark, 1 << 20):
        assert spark.conf.get(key) == before
    with wide_shuffles(spark, 100 << 30):
        assert spark.conf.get(key) == "2400"
    assert spark.conf.get(key) == before
