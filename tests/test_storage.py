import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from graphload import storage


class FakeConf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if self.value is not None else default


class FakeSession:
    """Only what shared_dir looks at."""

    def __init__(self, master, conf=None):
        self.conf = FakeConf(conf)
        outer = self
        self.chosen = None

        class Option:
            def isEmpty(self):
                return outer.chosen is None

            def isDefined(self):
                return outer.chosen is not None

            def get(self):
                return outer.chosen

        class Jsc:
            def sc(self):
                return self

            def getCheckpointDir(self):
                return Option()

        class Context:
            _jsc = Jsc()

            def setCheckpointDir(self, path):
                outer.chosen = path

        self.sparkContext = Context()
        self.sparkContext.master = master


def test_the_folder_the_cluster_names_is_used():
    session = FakeSession("yarn", "hdfs://shared/cp/")
    assert storage.shared_dir(session) == "hdfs://shared/cp"
    assert session.chosen == "hdfs://shared/cp/"
    assert storage.scratch_path(session, "x").startswith("hdfs://shared/cp/graphload-")


def test_no_temporary_folder_on_a_cluster():
    for master in ("yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            storage.shared_dir(FakeSession(master))


def test_a_temporary_folder_in_local_mode():
    session = FakeSession("local[4]")
    folder = storage.shared_dir(session)
    assert os.path.isdir(folder) and storage.shared_dir(session) == folder


def test_write_once_keeps_the_schema(spark):
    rows = spark.range(3).selectExpr("id", "CAST(NULL AS array<string>) AS none")
    table = storage.write_once(rows, name="t")
    assert table.dtypes == rows.dtypes and table.count() == 3
    named = storage.shared_dir(spark)
    assert any(named in f for f in table.inputFiles())


def test_threads_leave_adaptive_execution_as_it_was(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    with ThreadPoolExecutor(4) as pool:
        frames = [pool.submit(storage.keep_layout, spark.range(100).selectExpr("id", f"id % {n} AS k"),
                              "k") for n in range(2, 10)]
        assert all(f.result().count() == 100 for f in frames)
    assert spark.conf.get("spark.sql.adaptive.enabled") == before == "true"
