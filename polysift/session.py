"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """Session for tests and the local bench; on a cluster pass ``SETTINGS`` to spark-submit instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("polysift")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

