"""Spark session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Transcripts are tens of kilobytes each: small record counts keep one Arrow
    # batch to tens of megabytes instead of hundreds.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # A run's ids against stored tables: a join that has to shuffle filters the large side
    # by a Bloom filter of the ids first.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(app_name: str = "captide", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
