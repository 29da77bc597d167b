import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import cloudpickle  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import executors  # noqa: E402

# executors used by tests travel to the tasks by value
cloudpickle.register_pickle_by_value(executors)

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("graphload-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "4g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def one(spark):
    """Value of a Column expression over one row."""
    def value(*columns, **row):
        names = ", ".join(f"{k} {t}" for k, (_, t) in row.items()) or "x int"
        values = tuple(v for v, _ in row.values()) or (1,)
        found = spark.createDataFrame([values], names).select(*columns).first()
        return found[0] if len(columns) == 1 else tuple(found)
    return value
