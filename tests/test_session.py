import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from codexloom import session


def test_scratch_tables_live_in_the_shared_folder_and_go(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    table = session.written(spark.range(5), "five")
    path = session._scratch[0]
    assert table.count() == 5 and path.startswith(session.scratch_root(spark))
    assert session.drop_scratch(spark) == 1
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_written_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {str(f) for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before, setting = held(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    out = session.written(spark.range(100_000).groupBy((F.col("id") % 5_000).alias("k")).count(), "counts")
    deadline = time.time() + 20
    while held() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not held() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert out.agg(F.sum("count")).first()[0] == 100_000
