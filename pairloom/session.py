"""Session defaults shared by the entry point, the command line, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "pairloom", **conf: str) -> SparkSession:
    """A session with UTC time, AQE and Arrow on; `conf` adds or replaces settings."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
