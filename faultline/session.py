"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# On a large run also set spark.sql.adaptive.coalescePartitions.initialPartitionNum
# to about the largest shuffle's bytes / 128 MB: AQE merges partitions but
# does not split them. Some hundred thousand for 100 TB; small runs would
# only pay for empty partitions.
#
# Result-relevant setting: every timestamp is read and printed in UTC.
# The rest lets AQE size, coalesce and un-skew the shuffles at run time.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**CONF, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
