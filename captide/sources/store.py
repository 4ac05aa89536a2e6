"""The four tables as plain Spark tables, partitioned by a hash of what runs select by.

Videos and transcripts are bucketed by ``video_id`` and partitioned by the same hash, so a
partition is one bucket: joins on the id read both sides in place, and a run that replaces
rows overwrites only the partitions that hold them.  Membership is partitioned by a hash
of the playlist, so a run reads and writes the partition of its playlist alone.

Tables change through Spark's own inserts: new keys are appended, replaced ones go by
dynamic partition overwrite.  A job stages all rows it is going to write first, so a fault
in the data stops it before any table changes; a job cut off between two inserts is
completed by running it again, as every insert may be repeated.  One writer at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.operators.merge import timestamp
from captide.operators.quality import (
    ConstraintViolation,
    changed_partitions,
    checked_columns,
    partition_fingerprints,
    repeated_keys,
)
from captide.schema import BRONZE, KEYS, PART, PART_KEYS, RUN_LOG, SCHEMAS, SILVER
from captide.sources.staging import stage, stage_counted


def part_of(table: str, parts: int) -> Column:
    """Partition of a row; for tables bucketed by it, also the bucket."""
    return F.pmod(F.hash(PART_KEYS[table]), F.lit(parts)).alias(PART)


class Store:
    """Tables under ``root``.

    ``buckets`` is the number of partitions of the id tables, ``text_buckets`` that of the
    two transcript tables; choose it so that one partition of transcripts fits an executor
    core's share of memory.  Both are saved when the store is created.  A handle sees what
    was there when it first read a table, and what its session writes; later runs of
    others are seen by a new handle.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int | None = None,
        text_buckets: int | None = None,
        database: str = "default",
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        asked = {t: (text_buckets or buckets) if t in (BRONZE, SILVER) else buckets for t in SCHEMAS}
        stored = self._layout()
        for table, n in stored.items():
            if asked[table] not in (None, n):
                raise ValueError(f"{table} is stored in {n} partitions, not {asked[table]}")
        shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.parts = {t: stored.get(t) or n or shuffles for t, n in asked.items()}
        self._found, self._opened = bool(stored), set()
        self._prefix = f"{database}.captide_{hashlib.sha1(self.root.encode()).hexdigest()[:10]}"

    # -- layout ----------------------------------------------------------------

    def _layout(self) -> dict[str, int]:
        """Partition counts saved when the store was created; empty without a store."""
        try:
            rows = self.spark.read.schema("table string, parts int").parquet(f"{self.root}/layout")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {r.table: r.parts for r in rows.collect()}  # one row per table

    def created(self) -> list[str]:
        """Tables the store was created with."""
        return sorted(self._layout())

    def create(self) -> None:
        """Start an empty store; does nothing when one exists."""
        if not self._found and not self._layout():
            for table, schema in SCHEMAS.items():
                columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
                empty = self.spark.range(0).select(*columns, F.lit(0).alias(PART))
                empty.write.mode("ignore").partitionBy(PART).parquet(f"{self.root}/{table}")
            rows = [F.struct(F.lit(t).alias("table"), F.lit(n).alias("parts")) for t, n in self.parts.items()]
            layout = self.spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
            layout.write.mode("overwrite").parquet(f"{self.root}/layout")

    def _name(self, table: str) -> str:
        """The table's name in the catalog, where each session enters it once."""
        name = f"{self._prefix}_{table}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[table])
            keys = ", ".join(KEYS[table])
            bucketed = PART_KEYS[table] == keys
            clustered = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.parts[table]} BUCKETS" if bucketed else ""
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {PART} int) USING parquet PARTITIONED BY ({PART}) {clustered} "
                f"LOCATION '{self.root}/{table}'"
            )
        return name

    # -- reading ---------------------------------------------------------------

    def partitioned(self, table: str) -> DataFrame:
        """A table with its partition column, as it was when first read here and written since."""
        self._found = self._found or bool(self._layout())
        if not self._found:
            raise FileNotFoundError(f"no store at {self.root}")
        name = self._name(table)
        if table not in self._opened:
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            self._opened.add(table)
        return self.spark.table(name)

    def read(self, table: str) -> DataFrame:
        return self.partitioned(table).drop(PART)

    def read_members(self, table: str, playlist: str) -> DataFrame:
        """Rows of one playlist, read from its partition alone."""
        rows = self.partitioned(table)
        of_playlist = F.pmod(F.hash(F.lit(playlist)), F.lit(self.parts[table]))
        return rows.where((F.col(PART) == of_playlist) & (F.col(PART_KEYS[table]) == playlist)).drop(PART)

    def read_for(self, table: str, ids: DataFrame) -> DataFrame:
        """Rows of the partitions that listed videos belong to; few ids read little of a large table."""
        return self._in_parts(table, self._parts_of(ids.select(part_of(table, self.parts[table])))).drop(PART)

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.read(t) for t in SCHEMAS}

    def register_views(self) -> None:
        """The tables as temporary views under their own names, for SQL."""
        for table, rows in self.tables().items():
            rows.createOrReplaceTempView(table)

    # -- writing ---------------------------------------------------------------

    def _finished(self, table: str, keep: str) -> Callable[[DataFrame], DataFrame]:
        part = part_of(table, self.parts[table])
        return lambda rows: rows.where(keep).select(*checked_columns(table)).select("*", part)

    def _unique(self, table: str, staged: DataFrame) -> DataFrame:
        if not repeated_keys(table, staged).isEmpty():
            raise ConstraintViolation(f"{table}: repeated keys")
        return staged

    def staged(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows to be written, computed and checked before any table is changed.

        A null or value that the table does not allow fails here, as do repeated keys.
        """
        return self._unique(table, stage(self._finished(table, "true")(rows), table))

    def staged_counted(
        self, table: str, rows: DataFrame, counts: dict[str, Column], keep: str
    ) -> tuple[DataFrame, dict[str, int]]:
        """``staged`` of the rows that ``keep`` selects, and counts of all rows, in one pass."""
        held, found = stage_counted(rows, table, counts, self._finished(table, keep))
        return self._unique(table, held), found

    def _write(self, table: str, rows: DataFrame, overwrite: bool) -> None:
        name = self._name(table)
        # A partition goes to one task; only one too large for a task is split.
        dealt = rows.select(*SCHEMAS[table].names, PART).hint("rebalance", PART)
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            dealt.write.insertInto(name, overwrite=overwrite)
        finally:
            self.spark.conf.set(mode, before)

    def insert(self, table: str, staged: DataFrame) -> None:
        """Append staged rows, whose keys must be new."""
        keys, parts = list(KEYS[table]), self._parts_of(staged)
        held = self._in_parts(table, parts).join(staged.select(*keys), keys, "left_semi")
        if not held.isEmpty():
            raise ConstraintViolation(f"{table}: keys already present")
        self._write(table, staged, overwrite=False)

    def replace(self, table: str, staged: DataFrame) -> None:
        """Put staged rows in the place of stored ones with equal keys; new keys are appended.

        Only the partitions that hold such a key are written again.
        """
        keys, parts = list(KEYS[table]), self._parts_of(staged)
        stored = self._in_parts(table, parts)
        # At most one row per partition of the table.
        hits = stored.join(staged.select(*keys), keys, "left_semi").select(PART).distinct().collect()
        touched = F.col(PART).isin([r[PART] for r in hits])
        if hits:
            rest = stored.where(touched).join(staged.select(*keys), keys, "left_anti")
            self._write(table, rest.unionByName(staged.where(touched)), overwrite=True)
        fresh = staged.where(~touched) if hits else staged
        if not fresh.isEmpty():
            self._write(table, fresh, overwrite=False)

    def _parts_of(self, staged: DataFrame) -> list[int]:
        return sorted(r[PART] for r in staged.select(PART).distinct().collect())  # at most one per partition

    def _in_parts(self, table: str, parts: list[int]) -> DataFrame:
        rows = self.partitioned(table)
        return rows.where(F.col(PART).isin(parts)) if parts else rows.limit(0)

    # -- audits ----------------------------------------------------------------

    def record(self, table: str, parts: list[int]) -> None:
        """Keep the fingerprints of partitions as they are now, for a later audit."""
        found = partition_fingerprints(table, self._in_parts(table, parts))
        rows = found.withColumns({"table": F.lit(table), "recorded": F.current_timestamp()})
        rows.write.mode("append").parquet(f"{self.root}/fingerprints")

    def recorded(self, table: str) -> DataFrame:
        """The last fingerprints of a table's partitions."""
        kept = self.spark.read.schema(f"{PART} int, n long, folded long, total string, table string, recorded timestamp")
        rows = kept.parquet(f"{self.root}/fingerprints").where(F.col("table") == table)
        last = F.max_by(F.struct("n", "folded", "total"), "recorded").alias("last")
        return rows.groupBy(PART).agg(last).select(PART, "last.*")

    def audit(self, table: str, parts: list[int]) -> list[int]:
        """Of the given partitions, those that are not as they were recorded or repeat a key.

        No other partition is read.
        """
        rows = self._in_parts(table, parts)
        before = self.recorded(table).where(F.col(PART).isin(parts))
        changed = changed_partitions(before, partition_fingerprints(table, rows)).select(PART)
        repeated = rows.groupBy(PART, *KEYS[table]).count().where("count > 1").select(PART)
        return sorted(r[PART] for r in changed.union(repeated).distinct().collect())  # at most one per partition

    # -- logs ------------------------------------------------------------------

    def log_failures(self, failures: DataFrame, run_ts: datetime | str) -> None:
        """Append a run's failed fetches to the failure log."""
        failures.withColumn("run_ts", timestamp(run_ts)).write.mode("append").parquet(
            f"{self.root}/fetch_failures"
        )

    def log_rejected(self, rejected: DataFrame, run_ts: datetime | str) -> None:
        """Append what a run could not read to the quarantine table."""
        rejected.withColumn("run_ts", timestamp(run_ts)).write.mode("append").parquet(f"{self.root}/rejected")

    def log_run(self, action: str, result: dict, run_ts: datetime | str) -> None:
        """Append a run's summary to the run log, a table with a column per count."""
        known = {"action": F.lit(action), "run_ts": timestamp(run_ts)} | {
            k: F.lit(v) for k, v in result.items() if k in RUN_LOG.names and not isinstance(v, (list, dict))
        }
        columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN_LOG]
        self.spark.range(0, 1, 1, 1).select(*columns).write.mode("append").parquet(f"{self.root}/run_log")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG).parquet(f"{self.root}/run_log")
