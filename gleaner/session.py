"""Session construction for applications, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app_name: str = "gleaner", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and UTC; any setting can be overridden.

    On a cluster, leave ``master`` out and let spark-submit supply it together
    with ``spark.checkpoint.dir`` and the executor sizes.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # two row groups of text per Arrow batch would be large, so keep batches short
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
