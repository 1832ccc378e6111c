"""Session helpers: one place for the settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE picks join strategies and partition counts from the sizes it sees at run
# time, and splits skewed join partitions; the library adds no broadcast hints.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of few texts: by default 10,000 texts, or 64 MB of them, travel together."""
    for key, most in (("maxRecordsPerBatch", 2000), ("maxBytesPerBatch", 1 << 24)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or int(now) > most or int(now) <= 0:
            spark.conf.set(key, str(most))
