"""Incremental publication: a run reads only the files that are new or changed since the last one.

Every row is stored with the file it came from, and every run records, per table, the state of each file that changed:
its size, time and MD5, whether it is still there, and the attempt that holds its rows. The published table is the rows of
the latest attempt of each file that is present. Files are matched by size and time first; only those that differ are
hashed, and only those whose hash differs are read. Gates on new rows concern the new rows; keys and references are
checked on the table as it will be.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.operators.keys import key_profile
from grainline.operators.references import reference_check
from grainline.operators.rules import evaluate_tagged
from grainline.operators.scorecard import as_rule, preserved_rows, scorecard
from grainline.plans.curate import BROKEN, GateFailure, Staged, attempt_paths, file_rules, stage
from grainline.session import settle
from grainline.sinks import ledger, store
from grainline.sources.delimited import all_paths, data_lines, file_findings, list_files, read_raw
from grainline.sources.manifest import hashed_files
from grainline.spec import TableSpec

SOURCE = "source_file"
RECORD = "path string, size_bytes bigint, modified timestamp, md5 string, state string, rows_attempt string"
PRESENT, GONE = "present", "gone"


def known_files(spark: SparkSession, target: str, table: str, as_of: str | None = None) -> DataFrame:
    """The latest record of every file a table was ever published from."""
    done = ledger.committed(spark, f"{target}/ledger", table, as_of)
    root = f"{target}/files/{table}"
    # attempts of whole publications into the same target have no file records
    held = set(store.names(spark, root))
    paths = attempt_paths(root, [r.attempt for r in done.collect() if f"attempt={r.attempt}" in held])
    if not paths:
        return spark.createDataFrame([], RECORD)
    records = spark.read.schema(f"{RECORD}, attempt string").option("basePath", root).parquet(*paths).join(done, "attempt")
    names = [c.split()[0] for c in RECORD.split(", ")]
    return records.groupBy("path").agg(F.max_by(F.struct(*names[1:]), "logged_at").alias("r")).select("path", "r.*")


def file_changes(spark: SparkSession, root: str, known: DataFrame, pattern: str = "*.csv") -> DataFrame:
    """(path, size_bytes, modified, md5, change, rows_attempt) of every file that differs from its record, or has none.

    Changes: new, changed, touched (other time, same content), gone. Unchanged files are not listed and not opened.
    """
    now = list_files(spark, root, pattern).select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))
    before = known.select("path", *[F.col(c).alias(f"_{c}") for c in ("size_bytes", "modified", "md5", "state", "rows_attempt")])
    both = now.withColumn("listed", F.lit(True)).join(before, "path", "full_outer")
    there = F.coalesce(F.col("_state") == PRESENT, F.lit(False))
    same = there & (F.col("size_bytes") == F.col("_size_bytes")) & (F.col("modified") == F.col("_modified"))
    opened = settle(both.where(F.col("listed") & ~F.coalesce(same, F.lit(False))), "changed-files")
    hashed = hashed_files(opened.select("path", "size_bytes")).select("path", "md5")
    equal = F.col("md5") == F.col("_md5")
    change = F.when(~there, "new").when(equal, "touched").otherwise("changed")
    present = opened.join(hashed, "path").select("path", "size_bytes", "modified", "md5", change.alias("change"), "_rows_attempt")
    gone = both.where(F.col("listed").isNull() & there).select(
        "path", F.col("_size_bytes").alias("size_bytes"), F.col("_modified").alias("modified"), F.col("_md5").alias("md5"),
        F.lit(GONE).alias("change"), "_rows_attempt",
    )
    return present.unionByName(gone).withColumnRenamed("_rows_attempt", "rows_attempt")


def _stored(spark: SparkSession, target: str, spec: TableSpec, files: DataFrame) -> DataFrame:
    """The rows, with their file, of (path, rows_attempt); only the folders of these attempts are read."""
    root = f"{target}/increments/{spec.name}"
    attempts = [r.rows_attempt for r in files.select("rows_attempt").distinct().collect()]
    schema = f"{spec.schema.simpleString()[7:-1].replace(':', ' ')}, {SOURCE} string"
    if not attempts:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, attempt string").option("basePath", root).parquet(*attempt_paths(root, attempts))
    wanted = files.select(F.col("path").alias(SOURCE), F.col("rows_attempt").alias("attempt"))
    return rows.join(wanted, [SOURCE, "attempt"], "left_semi").select(*spec.names, SOURCE)


def read_incremental(spark: SparkSession, target: str, spec: TableSpec, as_of: str | None = None) -> DataFrame:
    """The published rows; with ``as_of`` those after that run. Before the first commit there are none."""
    files = known_files(spark, target, spec.name, as_of).where(F.col("state") == PRESENT)
    return _stored(spark, target, spec, files).select(*spec.names)


def _raw(spark: SparkSession, files: list[str], spec: TableSpec, pattern: str) -> DataFrame:
    """The rows of the given files, with their file in the spelling of the listing."""
    raw = read_raw(spark, files, spec, pattern, SOURCE)
    decoded = F.url_decode(F.replace(SOURCE, F.lit("+"), F.lit("%2B")))
    return raw.withColumn(SOURCE, F.regexp_replace(decoded, "^file:/+", "file:/"))


def curate_incremental(
    spark: SparkSession, specs: list[TableSpec], sources: dict[str, str], target: str, run_id: str, pattern: str = "*.csv"
) -> DataFrame:
    """Publish what changed in the folders of the given tables; returns the rule results.

    Below ``target`` the run writes ``increments/``, ``files/``, ``reports/`` and ``ledger/``. A failed gate publishes
    nothing. The names of new and changed files pass through the driver, as those of any scan do.
    """
    book, attempt = f"{target}/ledger", f"{run_id}-{uuid.uuid4().hex[:12]}"
    now = lambda: datetime.now(timezone.utc)
    ledger.append(spark, book, [(run_id, s.name, ledger.STARTED, None, now(), None) for s in specs])
    try:
        after, changes, checks = {}, {}, []
        for s in specs:
            known = settle(known_files(spark, target, s.name), "known-files")
            changes[s.name] = settle(file_changes(spark, sources[s.name], known, pattern), "file-changes")
            todo = [r.path for r in changes[s.name].where("change in ('new', 'changed')").select("path").collect()]
            empty = all_paths(spark, sources[s.name], pattern).join(list_files(spark, sources[s.name], pattern), "path", "left_anti")
            empty = empty.select("path", F.lit("empty_file").alias("finding"), F.lit(None).cast("string").alias("column_name"))
            keep = known.where(F.col("state") == PRESENT).join(changes[s.name].where("change <> 'touched'"), "path", "left_anti")
            rows = _stored(spark, target, s, keep)
            if todo:
                lines = data_lines(spark, todo, pattern)
                expected = lines.agg(F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"))
                staged = stage(_raw(spark, todo, s, pattern), s, f"{target}/increments/{s.name}/attempt={attempt}", expected, keep=(SOURCE,))
                checks += _new_row_rules(staged) + file_rules(file_findings(spark, todo, s, pattern).unionByName(empty), lines, s.name)
                rows = rows.unionByName(staged.rows.drop(BROKEN))
            elif not empty.isEmpty():
                raise GateFailure(f"run {run_id}: empty files below {sources[s.name]}")
            after[s.name] = (s, rows)
        results_path = f"{target}/reports/{run_id}/rules"
        scorecard(checks + _whole_rules(after)).write.mode("overwrite").parquet(results_path)
        results = spark.read.parquet(results_path)
        # bounded: one row per failed rule of the specification
        failed = [f"{r.table_name}.{r.rule_id}" for r in results.where("status = 'FAIL'").collect()]
        if failed:
            raise GateFailure(f"run {run_id}: {len(failed)} failed rules: {', '.join(sorted(failed))}")
        totals = {r.table_name: r.total for r in results.where("rule_id = 'key_duplicate'").collect()}
        for s in specs:
            fresh = F.col("change").isin("new", "changed")
            changes[s.name].select(
                "path", "size_bytes", "modified", "md5", F.when(F.col("change") == GONE, GONE).otherwise(PRESENT).alias("state"),
                F.when(fresh, attempt).otherwise(F.col("rows_attempt")).alias("rows_attempt"),
            ).write.parquet(f"{target}/files/{s.name}/attempt={attempt}")
    except Exception as problem:
        detail = f"{type(problem).__name__}: {problem}"
        ledger.append(spark, book, [(run_id, s.name, ledger.FAILED, None, now(), detail) for s in specs])
        raise
    ledger.append(spark, book, [(run_id, s.name, ledger.COMMITTED, totals[s.name], now(), attempt) for s in specs])
    return results


def _new_row_rules(staged: Staged) -> list[DataFrame]:
    kept = preserved_rows(staged.expected, staged.rows)
    return [
        evaluate_tagged(staged.rows, staged.rules, staged.spec.name, BROKEN),
        as_rule(kept, staged.spec.name, "row_preservation", "Grain", F.abs(F.col("lost_rows")), F.col("source_rows")),
    ]


def _whole_rules(after: dict[str, tuple[TableSpec, DataFrame]]) -> list[DataFrame]:
    """Keys, emptiness and references of the tables as they will be; only key columns are read."""
    found = []
    for spec, rows in after.values():
        keys = key_profile(rows, list(spec.key))
        found.append(as_rule(keys, spec.name, "key_duplicate", "Grain", F.col("surplus_rows"), F.col("total_rows")))
        found.append(as_rule(keys, spec.name, "empty_table", "Grain", (F.col("total_rows") == 0).cast("bigint"), F.lit(1)))
        for r in spec.references:
            if r.parent in after:
                check = reference_check(rows, r.column, after[r.parent][1], r.parent_column, f"{r.column}->{r.parent}", r.optional)
                name = F.concat(F.lit("reference:"), F.col("reference"))
                found.append(as_rule(check, spec.name, name, "FK Integrity", F.col("orphan_rows"), F.col("checked_rows")))
    return found
