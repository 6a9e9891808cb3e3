import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sessionloom.session import DEFAULTS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("tests")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri())
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)
