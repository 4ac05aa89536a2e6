"""Intermediate results as written tables.

Writing one cuts lineage, survives lost executors, keeps a result that several
outputs need from being computed for each of them, and gives later joins a true
size to choose a strategy by.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Used by local sessions that name no folder, whose tasks all see this machine's disk.
_LOCAL_FOLDER = "file:///tmp/checkpoints/captide"
# Spark's setting to drop a query's shuffle files when the query ends.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names for checkpoints."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _LOCAL_FOLDER
    return f"{base.rstrip('/')}/captide-{uuid.uuid4().hex}/{name}"


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write rows and read them back."""
    spark = rows.sparkSession
    path = staging_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside drop their shuffle files when they end.

    Otherwise those stay on the executors' disks until the driver collects its garbage.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def stage_counted(
    rows: DataFrame,
    name: str,
    counts: dict[str, Column],
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> tuple[DataFrame, dict[str, int]]:
    """``stage`` of finished rows, and counts of the rows taken while they pass by.

    ``finish`` selects and filters.  The counts then stand above every shuffle, in the
    stage that writes, where a task that is run again is counted once.
    """
    seen = Observation()
    staged = stage(finish(rows.observe(seen, *[c.alias(n) for n, c in counts.items()])), name)
    found = seen.get
    return staged, {n: found.get(n) or 0 for n in counts}
