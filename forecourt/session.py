"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# None of these is needed for right results. They let AQE split skewed join
# partitions even where that costs a shuffle, keep timestamps zone free, and
# keep path partition keys textual (run ids such as "0012" are not numbers).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "forecourt",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the recommended settings; cluster defaults stay in force otherwise."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RECOMMENDED_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
