import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared, warehouse = tmp_path_factory.mktemp("shared"), tmp_path_factory.mktemp("warehouse")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": str(warehouse), "spark.driver.memory": "4g",
    }
    builder = SparkSession.builder.master("local[4]")
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
