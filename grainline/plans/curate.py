"""Raw exports to published tables: stage all, gate all, then publish.

Per table the raw text is parsed once, into the folder of this run, with the ids of the rules that
each row breaks. Gates and rejects read that copy, column-pruned; counts therefore come from
written data and stay right when a lost executor makes tasks run again, which accumulators do not
promise. To publish is to append COMMITTED rows for all tables to the ledger, in one file: no row
is copied or overwritten, and readers follow the ledger, so they see all tables of a run or none.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.operators.business import business_rules
from grainline.operators.curation import conversion_rules, convert, table_rules
from grainline.operators.drift import drift
from grainline.operators.keys import duplicate_rows, key_profile
from grainline.operators.references import orphan_rows, reference_check
from grainline.operators.rules import Rule, broken_ids, evaluate_tagged
from grainline.operators.scorecard import as_rule, preserved_rows, scorecard
from grainline.sinks import ledger
from grainline.sinks.parquet import MAX_RECORDS_PER_FILE, by_partition, write_rejects
from grainline.sinks.reports import quality_report, write_json
from grainline.sources.delimited import data_lines, file_findings, read_raw
from grainline.spec import TableSpec

BROKEN = "broken_rules"


class GateFailure(RuntimeError):
    """At least one rule failed; nothing was published."""


@dataclass(frozen=True)
class Staged:
    """A staged table. ``expected`` is one row with source_rows, counted apart from the staged rows."""

    spec: TableSpec
    expected: DataFrame
    rows: DataFrame
    rules: list[Rule]


def stage(
    raw: DataFrame, spec: TableSpec, path: str, expected: DataFrame, max_records: int = MAX_RECORDS_PER_FILE, keep: tuple[str, ...] = ()
) -> Staged:
    """Write the typed rows together with the ids of the rules each one breaks, and further columns as they are."""
    rules = table_rules(spec) + conversion_rules(spec) + business_rules(spec)
    projected = raw.select(
        *[convert(c, spec).alias(c.name) for c in spec.columns], *keep, broken_ids(rules).alias(BROKEN)
    )
    placed = by_partition(projected, list(spec.partitions)) if spec.partitions else projected
    writer = placed.write.option("maxRecordsPerFile", max_records).option("compression", "snappy")
    if spec.partitions:
        writer = writer.partitionBy(*spec.partitions)
    writer.parquet(path)
    return Staged(spec, expected, raw.sparkSession.read.schema(projected.schema).parquet(path), rules)


def file_rules(findings: DataFrame, files: DataFrame, table: str) -> list[DataFrame]:
    """Rule results on the delivered files. ``files`` has one row per file with content."""
    wanted = {
        "empty_file": "FAIL", "missing_label": "FAIL", "missing_column": "WARN", "extra_column": "WARN", "outside_pattern": "WARN",
    }
    both = findings.select("path", "finding").distinct().unionByName(
        files.select(F.col("file").alias("path"), F.lit("file").alias("finding"))
    )
    counts = both.agg(*[F.count_if(F.col("finding") == n).alias(n) for n in ("file", *wanted)])
    total = F.col("file") + F.col("empty_file")
    return [as_rule(counts, table, f"schema:{n}", "Schema", F.col(n), total, on_breach=b) for n, b in wanted.items()]


def gate(staged: Staged) -> DataFrame:
    """All rule results of one staged table: row rules, key uniqueness, emptiness, row preservation."""
    spec, rows = staged.spec, staged.rows
    kept = preserved_rows(staged.expected, rows)
    keys = key_profile(rows, list(spec.key))
    parts = [
        evaluate_tagged(rows, staged.rules, spec.name, BROKEN),
        as_rule(keys, spec.name, "key_duplicate", "Grain", F.col("surplus_rows"), F.col("total_rows")),
        as_rule(keys, spec.name, "empty_table", "Grain", (F.col("total_rows") == 0).cast("bigint"), F.lit(1)),
        as_rule(kept, spec.name, "row_preservation", "Grain", F.abs(F.col("lost_rows")), F.col("source_rows")),
    ]
    for alternate in spec.alternate_keys:
        profile = key_profile(rows, list(alternate))
        name = "alternate_key:" + "+".join(alternate)
        parts.append(
            as_rule(profile, spec.name, name, "Grain", F.col("surplus_rows"), F.col("total_rows"), on_breach="WARN")
        )
    return scorecard(parts)


def reference_results(staged: list[Staged]) -> list[DataFrame]:
    """Rule results for every reference whose parent is staged in the same run."""
    rows = {s.spec.name: s.rows for s in staged}
    found = []
    for s in staged:
        for r in s.spec.references:
            if r.parent in rows:
                check = reference_check(
                    s.rows, r.column, rows[r.parent], r.parent_column, f"{r.column}->{r.parent}", r.optional
                )
                found.append(
                    as_rule(check, s.spec.name, F.concat(F.lit("reference:"), F.col("reference")), "FK Integrity",
                            F.col("orphan_rows"), F.col("checked_rows"))
                )
    return found


def rejected_rows(s: Staged, parents: dict[str, DataFrame]) -> DataFrame:
    """All rows that break a row rule, repeat a key or miss a parent, with the rule_id; a row once per rule."""
    plain = s.rows.drop(BROKEN)
    bad = s.rows.where(F.size(BROKEN) > 0).withColumn("rule_id", F.explode(BROKEN)).drop(BROKEN)
    bad = bad.unionByName(duplicate_rows(plain, list(s.spec.key)).withColumn("rule_id", F.lit("key_duplicate")))
    for r in s.spec.references:
        if r.parent in parents:
            lost = orphan_rows(plain, r.column, parents[r.parent], r.parent_column, r.optional)
            bad = bad.unionByName(lost.withColumn("rule_id", F.lit(f"reference:{r.column}->{r.parent}")))
    return bad


def curate(
    spark: SparkSession, specs: list[TableSpec], sources: dict[str, str], target: str, run_id: str,
    max_records: int = MAX_RECORDS_PER_FILE, pattern: str = "*.csv",
) -> DataFrame:
    """Run the tables in the given order and return their rule results.

    ``sources`` maps a table to its folder. Below ``target`` the run writes ``tables/``,
    ``rejects/``, ``reports/``, ``partitions/`` and ``ledger/``. Each attempt has folders of its own.
    """
    book = f"{target}/ledger"
    attempt = f"{run_id}-{uuid.uuid4().hex[:12]}"
    now = lambda: datetime.now(timezone.utc)
    ledger.append(spark, book, [(run_id, s.name, ledger.STARTED, None, now(), None) for s in specs])
    try:
        staged, checks = [], []
        for s in specs:
            lines = data_lines(spark, sources[s.name], pattern)
            expected = lines.agg(F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"))
            raw = read_raw(spark, sources[s.name], s, pattern)
            staged.append(stage(raw, s, f"{target}/tables/{s.name}/attempt={attempt}", expected, max_records))
            checks += file_rules(file_findings(spark, sources[s.name], s, pattern), lines, s.name)
        results_path = f"{target}/reports/{run_id}/rules"
        found = [gate(s) for s in staged] + checks + reference_results(staged)
        scorecard(found).write.mode("overwrite").parquet(results_path)
        results = spark.read.parquet(results_path)
        write_json(quality_report(results, run_id), f"{target}/reports/{run_id}/quality")
        parents = {s.spec.name: s.rows for s in staged}
        for s in staged:
            write_rejects(rejected_rows(s, parents), f"{target}/rejects/{run_id}/{s.spec.name}", ["rule_id", *s.spec.key])
        # bounded: one row per failed rule of the specification
        failed = [f"{r.table_name}.{r.rule_id}" for r in results.where("status = 'FAIL'").collect()]
        if failed:
            raise GateFailure(f"run {run_id}: {len(failed)} failed rules: {', '.join(sorted(failed))}")
        totals = {r.table_name: r.total for r in results.where("rule_id = 'key_duplicate'").collect()}
        for s in staged:
            if s.spec.partitions:
                labels = s.rows.select(*s.spec.partitions).distinct()
                labels.write.parquet(f"{target}/partitions/{s.spec.name}/attempt={attempt}")
    except Exception as problem:
        detail = f"{type(problem).__name__}: {problem}"
        ledger.append(spark, book, [(run_id, s.name, ledger.FAILED, None, now(), detail) for s in specs])
        raise
    ledger.append(spark, book, [(run_id, s.name, ledger.COMMITTED, totals[s.name], now(), attempt) for s in specs])
    return results


def attempt_paths(root: str, attempts: list[str]) -> list[str]:
    return [f"{root}/attempt={a}" for a in sorted(set(attempts))]


def latest_attempts(spark: SparkSession, target: str, spec: TableSpec, done: DataFrame) -> DataFrame:
    """(labels, _attempt): the attempt of the latest run per partition, or of the table."""
    labels = list(spec.partitions)
    if labels:
        kinds = ", ".join(f"{n} string" for n in labels)
        root = f"{target}/partitions/{spec.name}"
        # one name per committed run; the folders of failed attempts are not looked at
        paths = attempt_paths(root, [r.attempt for r in done.select("attempt").distinct().collect()])
        kept = spark.read.schema(f"{kinds}, attempt string").option("basePath", root).parquet(*paths)
        done = kept.join(done, "attempt")
    return done.groupBy(*labels).agg(F.max_by("attempt", "logged_at").alias("_attempt"))


def read_curated(spark: SparkSession, target: str, spec: TableSpec, as_of: str | None = None) -> DataFrame:
    """The published rows of a table: for each partition, those of its latest COMMITTED run; labels stay text.

    ``as_of`` names a run: the table as it was after that run. A table without partitions is replaced as a whole. Before
    the first commit there are no rows. Only the folders of attempts that hold a published partition are read.
    """
    done = ledger.committed(spark, f"{target}/ledger", spec.name, as_of)
    if done.isEmpty():
        return spark.createDataFrame([], spec.schema)
    latest = latest_attempts(spark, target, spec, done)
    root = f"{target}/tables/{spec.name}"
    paths = attempt_paths(root, [r._attempt for r in latest.select("_attempt").distinct().collect()])
    if not paths:
        return spark.createDataFrame([], spec.schema)
    stored = spark.read.schema(f"{spec.schema.simpleString()[7:-1].replace(':', ' ')}, attempt string")
    rows = stored.option("basePath", root).parquet(*paths)
    same = rows["attempt"] == latest["_attempt"]
    for n in spec.partitions:
        same = same & rows[n].eqNullSafe(latest[n])
    return rows.join(latest, same, "left_semi").select(*spec.names)


def publication_drift(spark: SparkSession, target: str, spec: TableSpec, run_id: str, columns: list[str], **limits) -> DataFrame:
    """``drift`` of what a run published against the run before it in the ledger; the first run is all NEW."""
    before = ledger.previous_run(spark, f"{target}/ledger", spec.name, run_id)
    old = read_curated(spark, target, spec, as_of=before) if before else spark.createDataFrame([], spec.schema)
    return drift(old, read_curated(spark, target, spec, as_of=run_id), list(spec.partitions), columns, **limits)
