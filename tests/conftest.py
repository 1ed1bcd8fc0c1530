import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def hours(spark):
    """Two cells, three days of two-hourly speeds; cell 1 is constant and has a null."""
    start = dt.datetime(2024, 2, 28)
    rows = [(c, start + dt.timedelta(hours=2 * i), None if c and i == 3 else (7.0 if c else float(i))) for c in (0, 1) for i in range(36)]
    return spark.createDataFrame(rows, "cell_id int, time timestamp, ws double")
