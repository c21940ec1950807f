import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

TESTS = Path(__file__).resolve().parent
sys.path.insert(0, str(TESTS.parent))
# Python workers start with the same import path.
os.environ["PYTHONPATH"] = os.pathsep.join([str(TESTS.parent), str(TESTS), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def make_pairs(spark):
    """Pairs with ids from a list of (first, second) texts."""

    def make(rows, start_id=0):
        data = [(start_id + i, (de, en)) for i, (de, en) in enumerate(rows)]
        return spark.createDataFrame(data, "id long, translation struct<de: string, en: string>")

    return make
