import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.01"
SMALL_DIR = "/root/testdata/sf0.001"


def make_session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("propensity-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def spark():
    return make_session()
