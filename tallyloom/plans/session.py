"""Session settings that suit these analyses; the caller owns the session and may differ."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Splits hot keys in joins and merges small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8,000 bytes. Sums of hundreds of
    # columns and distances to many centres are such methods unless Spark leaves
    # them out of the fused stage: 90 centres took a quarter of the time.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
