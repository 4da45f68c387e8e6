"""Session factory: UTC, adaptive execution, one shuffle partition a core for local runs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(name: str = "tidemark", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session.  On a cluster the submitter's own settings are used and this is not needed."""
    n = cores or os.cpu_count() or 1
    settings = {
        "spark.sql.shuffle.partitions": str(n), "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    } | conf
    builder = SparkSession.builder.master(f"local[{n}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
