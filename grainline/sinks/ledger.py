"""Run ledger: an append-only table of run states. The latest state per table decides.

Each append is a small file. ``compact`` writes what is there as one snapshot together with the names of the files it
covers; readers take the newest complete snapshot and the files it does not cover, so a compaction may run beside readers
and writers. ``prune`` removes covered files later.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.sinks import store

SCHEMA = "run_id string, table_name string, status string, row_count bigint, logged_at timestamp, detail string"
STARTED, COMMITTED, FAILED = "IN_PROGRESS", "COMMITTED", "FAILED"
# Names with an underscore are passed over by a read of the folder above.
SNAPSHOTS = "_snapshots"


def append(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Rows of (run_id, table_name, status, row_count, logged_at, detail)."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _snapshot(spark: SparkSession, path: str) -> str | None:
    """The newest complete snapshot."""
    done = [n for n in store.names(spark, f"{path}/{SNAPSHOTS}") if store.exists(spark, f"{path}/{SNAPSHOTS}/{n}/rows/_SUCCESS")]
    return f"{path}/{SNAPSHOTS}/{done[-1]}" if done else None


def _named(spark: SparkSession, path: str) -> DataFrame:
    """All rows with the file they were appended in. Files that the snapshot covers are not opened.

    The names on the driver are few: a file per state of a run since the last compaction and prune.
    """
    at = _snapshot(spark, path)
    covered = {r["file"] for r in spark.read.schema("file string").parquet(f"{at}/covered").collect()} if at else set()
    fresh = [n for n in store.names(spark, path) if n.endswith(".parquet") and n[0] not in "._" and n not in covered]
    rows = spark.read.schema(f"{SCHEMA}, file string").parquet(f"{at}/rows") if at else spark.createDataFrame([], f"{SCHEMA}, file string")
    if fresh:
        log = spark.read.schema(SCHEMA).parquet(*[f"{path}/{n}" for n in fresh]).select("*", F.col("_metadata.file_name").alias("file"))
        rows = rows.unionByName(log) if at else log
    return rows


def read(spark: SparkSession, path: str) -> DataFrame:
    if not store.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return _named(spark, path).drop("file")


def compact(spark: SparkSession, path: str) -> None:
    """Write the whole ledger as one file. Appends that come in meanwhile are not covered and stay in the log."""
    rows = _named(spark, path)
    at = f"{path}/{SNAPSHOTS}/{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:6]}"
    # one frame and so one listing: what is covered is what the rows were read from, and what an earlier snapshot covered
    rows.select("file").distinct().coalesce(1).write.parquet(f"{at}/covered")
    rows.coalesce(1).write.parquet(f"{at}/rows")


def prune(spark: SparkSession, path: str, older_than: datetime) -> list[str]:
    """Remove the log files that a snapshot from before ``older_than`` covers, and the snapshots before it.

    A reader that began after that snapshot does not need them. The names are few: a file per state of a run.
    """
    stamp = f"{older_than.astimezone(timezone.utc):%Y%m%d%H%M%S%f}"
    found = [n for n in store.names(spark, f"{path}/{SNAPSHOTS}") if n < stamp and store.exists(spark, f"{path}/{SNAPSHOTS}/{n}/rows/_SUCCESS")]
    if not found:
        return []
    covered = {r["file"] for r in spark.read.parquet(f"{path}/{SNAPSHOTS}/{found[-1]}/covered").collect()}
    gone = [n for n in store.names(spark, path) if n in covered] + [f"{SNAPSHOTS}/{n}" for n in found[:-1]]
    for name in gone:
        store.remove(spark, f"{path}/{name}")
    return gone


def committed(spark: SparkSession, path: str, table: str, as_of: str | None = None) -> DataFrame:
    """(attempt, logged_at) of the committed runs of a table; with ``as_of`` up to the last commit of that run."""
    done = read(spark, path).where((F.col("table_name") == table) & (F.col("status") == COMMITTED))
    if as_of is not None:
        until = done.where(F.col("run_id") == as_of).agg(F.max("logged_at")).first()[0]
        if until is None:
            raise ValueError(f"run {as_of} did not publish {table}")
        done = done.where(F.col("logged_at") <= F.lit(until))
    return done.select(F.col("detail").alias("attempt"), "logged_at")


def previous_run(spark: SparkSession, path: str, table: str, run_id: str) -> str | None:
    """The run that published the table last before the given one did."""
    done = read(spark, path).where((F.col("table_name") == table) & (F.col("status") == COMMITTED))
    first = done.where(F.col("run_id") == run_id).agg(F.min("logged_at")).first()[0]
    if first is None:
        raise ValueError(f"run {run_id} did not publish {table}")
    return done.where(F.col("logged_at") < F.lit(first)).agg(F.max_by("run_id", "logged_at")).first()[0]


def latest(ledger: DataFrame, entity: str, status: str, order: list[str], rows: str) -> DataFrame:
    """Latest state per entity and the row count of its latest committed run.

    ``max_by`` keeps one row per entity and task, however long the history of an entity is.
    """
    when = F.struct(*order)
    committed = F.when(F.col(status) == COMMITTED, when)
    return ledger.groupBy(entity).agg(
        F.count(F.lit(1)).alias("entries"),
        F.max_by(status, when).alias("latest_status"),
        F.max_by(rows, committed).alias("committed_rows"),
    )
