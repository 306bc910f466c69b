"""Session settings that the jobs in this package are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "tokenlake", **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and Arrow transfer on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Word counts of a stream outgrow the heap; this keeps them on disk.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
