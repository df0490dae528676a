"""Session defaults. A cluster's own settings always win; these are for local runs, tests and the bench."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, app: str = "sondar", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with AQE on, UTC and small shuffles."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    spark = (
        SparkSession.builder.master(f"local[{cpus or '*'}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
