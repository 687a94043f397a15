import pytest
from pyspark.sql import functions as F

from corpusloom import session


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_dir(spark) == named.rstrip("/")
    else:
        assert session.shared_dir(spark) == session.shared_dir(spark)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


class _Context:
    master, applicationId = "spark://host:7077", "app"


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    conf, sparkContext = _Conf(), _Context()


def test_a_cluster_needs_the_setting():
    with pytest.raises(RuntimeError):
        session.shared_dir(_Session())


def test_spread_only_small_scans(spark, tmp_path, monkeypatch):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    assert session.spread(scan).rdd.getNumPartitions() == 4
    monkeypatch.setattr(session, "_BYTES_PER_CORE", 1)
    assert session.spread(scan) is scan


def test_unknown_sizes(spark):
    assert session.estimated_bytes(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")) is None
    assert session.estimated_bytes(spark.range(10)) == 80


def test_only_shuffled_rows_are_written(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t")).where("id > 3")
    assert session.in_stable_order(scan) is scan
    shuffled = scan.groupBy((F.col("id") % 7).alias("k")).count()
    assert session.in_stable_order(shuffled) is not shuffled
    assert session.in_stable_order(shuffled).count() == 7


def test_a_closed_scope_leaves_no_files(spark):
    import os

    base = session.shared_dir(spark).removeprefix("file:")
    with session.scratch_scope(spark):
        kept = session.written(spark.range(10).toDF("x"), "outer")
        with session.scratch_scope(spark):
            assert session.written(spark.range(5).toDF("x"), "inner").count() == 5
        assert kept.count() == 10
        (scope,) = [d for d in os.listdir(f"{base}/corpusloom") if d.startswith("scope-")]
        assert len(os.listdir(f"{base}/corpusloom/{scope}")) == 1
    assert not [d for d in os.listdir(f"{base}/corpusloom") if d.startswith("scope-")]
