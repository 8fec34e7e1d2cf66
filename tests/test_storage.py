import pytest
from helpers import tuples

from tallyloom.plans import storage


def test_the_session_names_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = storage.shared_folder(spark)
    assert folder == storage.shared_folder(spark)
    if named:
        assert folder == named


def test_every_path_is_new(spark):
    assert storage.new_path(spark, "t") != storage.new_path(spark, "t")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        storage.shared_folder(Session())


def test_materialized_rows_come_from_files(spark):
    df = spark.range(5).selectExpr("id", "cast(id AS string) AS s", "array(id) AS a")
    read = storage.materialize(df, "rows")
    assert sorted(tuples(read)) == sorted(tuples(df))
    assert read.dtypes == df.dtypes
    assert read.inputFiles()


def test_the_setting_for_shuffle_files_is_left_as_it_was(spark):
    before = spark.conf.get(storage.FILE_CLEANUP)
    counted = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    read = storage.materialize(counted, "counted")
    assert spark.conf.get(storage.FILE_CLEANUP) == before
    # What has been written and what it was written from can both be read again.
    assert sorted(tuples(counted)) == sorted(tuples(read)) == sorted(tuples(storage.materialize(counted, "again")))
