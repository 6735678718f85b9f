"""Retention: folders of attempts that no reader can need any more are removed.

Mark: what the tables were at a point in time, and all that was committed later. Sweep: every other attempt whose run has
not written to the ledger since. A reader that began after that point finds all its files.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from grainline.plans.curate import latest_attempts
from grainline.plans.incremental import PRESENT, RECORD, attempt_paths
from grainline.sinks import ledger, store
from grainline.spec import TableSpec


def needed_attempts(spark: SparkSession, target: str, spec: TableSpec, since: datetime) -> set[str]:
    """Attempts that hold rows of the table as it was at ``since`` or at any time later. A name per run at most."""
    done = ledger.committed(spark, f"{target}/ledger", spec.name)
    needed = {r.attempt for r in done.where(F.col("logged_at") >= F.lit(since)).collect()}
    before = done.where(F.col("logged_at") < F.lit(since))
    if before.isEmpty():
        return needed
    root = f"{target}/files/{spec.name}"
    held = set(store.names(spark, root))
    paths = [p for p in attempt_paths(root, [r.attempt for r in before.collect()]) if p.rsplit("/", 1)[1] in held]
    if paths:
        records = spark.read.schema(f"{RECORD}, attempt string").option("basePath", root).parquet(*paths).join(before, "attempt")
        last = records.groupBy("path").agg(F.max_by(F.struct("state", "rows_attempt"), "logged_at").alias("r")).select("r.*")
        needed |= {r.rows_attempt for r in last.where(F.col("state") == PRESENT).select("rows_attempt").distinct().collect()}
    whole = set(store.names(spark, f"{target}/tables/{spec.name}"))
    before = before.where(F.col("attempt").isin([n.removeprefix("attempt=") for n in whole]))
    if whole and not before.isEmpty():
        needed |= {r._attempt for r in latest_attempts(spark, target, spec, before).select("_attempt").distinct().collect()}
    return needed


def sweep(spark: SparkSession, target: str, specs: list[TableSpec], since: datetime) -> list[str]:
    """Remove the folders of attempts not needed since a point in time; returns them.

    Kept are attempts that a table needs at ``since`` or later, and attempts of runs with a ledger row since then, which
    may still be under way. Records of files and partitions are kept for every committed attempt: later runs compare with
    them, and a read as of a run that was swept fails instead of returning fewer rows.
    """
    book = ledger.read(spark, f"{target}/ledger")
    busy = {r.run_id for r in book.where(F.col("logged_at") >= F.lit(since)).select("run_id").distinct().collect()}
    gone = []
    for spec in specs:
        needed = needed_attempts(spark, target, spec, since)
        committed = {r.attempt for r in ledger.committed(spark, f"{target}/ledger", spec.name).collect()}
        for kind, keep in (("tables", needed), ("increments", needed), ("partitions", committed), ("files", committed)):
            for name in store.names(spark, f"{target}/{kind}/{spec.name}"):
                attempt = name.removeprefix("attempt=")
                # an attempt is named by its run, a dash and twelve characters
                if name.startswith("attempt=") and attempt not in keep and attempt[:-13] not in busy:
                    gone.append(f"{target}/{kind}/{spec.name}/{name}")
    for path in gone:
        store.remove(spark, path)
    return gone
