import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def accounts(spark):
    """A few clean accounts as dictionaries."""
    from dropgate.suite import fixtures as fx

    rows = spark.createDataFrame(fx.accounts(spark, SF).orderBy("order_key").limit(12).collect()).drop("order_key").collect()
    return [r.asDict() for r in rows]


@pytest.fixture(scope="session")
def options():
    from dropgate.operators.rules import Options

    return Options(as_of=datetime.date(2024, 1, 1))
