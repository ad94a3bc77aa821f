import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clientele-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bank(spark):
    """Warehouse over the smallest given tables."""
    if not os.path.isdir(DATA):
        pytest.skip("test tables not present")
    from clientele.plans.warehouse import warehouse

    return warehouse(spark, DATA)
