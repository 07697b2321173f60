"""Sessions with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with adaptive plans, UTC time and the last value winning for repeated map keys."""
    base = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.master(master).appName("corvidex")
    return builder.config(map=base | conf).getOrCreate()
