"""A local session for the command line and tests; on a cluster, bring your own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "4g", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("quarry")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.cleaner.referenceTracking.cleanCheckpoints": "true", "spark.driver.memory": memory, "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Python workers import this package from where the driver did.
        "spark.executorEnv.PYTHONPATH": os.pathsep.join([os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.environ.get("PYTHONPATH", "")]),
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
