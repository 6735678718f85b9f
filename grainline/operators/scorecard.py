"""Scorecards and verdicts over rule results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.functions.compare import percent
from grainline.operators.rules import verdict

STATUSES = ("PASS", "WARN", "FAIL")

# The verdict texts.
READY = "READY FOR PHASE 2"
CAUTION = "REVIEW WARNINGS, PROCEED WITH CAUTION"
NOT_READY = "NOT READY - FIX FAILURES BEFORE PHASE 2"


def scorecard(parts: list[DataFrame]) -> DataFrame:
    """The union of rule results from several tables."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def side_by_side(frames: list[DataFrame]) -> DataFrame:
    """One-row frames with different columns as one row, by union and maximum rather than by join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def preserved_rows(expected: DataFrame, curated: DataFrame) -> DataFrame:
    """Rows before and after, and their difference; any difference is a loss or a duplication.

    ``expected`` is one row with ``source_rows``, counted by other means than the curated rows.
    """
    counts = side_by_side([expected.select("source_rows"), curated.agg(F.count(F.lit(1)).alias("curated_rows"))])
    return counts.withColumn("lost_rows", F.col("source_rows") - F.col("curated_rows"))


def as_rule(
    metrics: DataFrame, table: str, rule_id: str | Column, category: str, violations: Column, total: Column,
    on_breach: str = "FAIL", limit_pct: float = 0.0, within_limit: str = "WARN",
) -> DataFrame:
    """A one-row metrics frame in the shape of a rule result."""
    name = F.lit(rule_id) if isinstance(rule_id, str) else rule_id
    pct = F.coalesce(percent(violations, total), F.lit(0.0))
    return metrics.select(
        F.lit(table).alias("table_name"),
        name.alias("rule_id"),
        F.lit(category).alias("category"),
        verdict(violations, pct, F.lit(float(limit_pct)), F.lit(within_limit), F.lit(on_breach)).alias("status"),
        violations.cast("bigint").alias("violations"),
        total.cast("bigint").alias("total"),
        pct.alias("pct"),
    )


def by_category(results: DataFrame) -> DataFrame:
    """Tests per category and status, with the total."""
    return results.groupBy("category").agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES],
        F.count(F.lit(1)).alias("total"),
    )


def overall(results: DataFrame) -> DataFrame:
    """One row: tests per status and the verdict."""
    counts = results.agg(
        F.count(F.lit(1)).alias("total_tests"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES],
    )
    text = (
        F.when(F.col("fail") > 0, F.lit(NOT_READY)).when(F.col("warn") > 0, F.lit(CAUTION)).otherwise(F.lit(READY))
    )
    return counts.withColumn("verdict", text)


def readiness(metrics: DataFrame, checks: dict[str, Column], ready: str, not_ready: str) -> DataFrame:
    """Named checks over a one-row metrics frame: one row per check, with the joint verdict."""
    passed = reduce(lambda a, b: a & b, checks.values())
    cells = [F.struct(F.lit(n).alias("check_name"), c.alias("passed")) for n, c in checks.items()]
    share = percent(reduce(lambda a, b: a + b, [c.cast("int") for c in checks.values()]), F.lit(len(checks)))
    return metrics.select(
        F.explode(F.array(*cells)).alias("c"),
        share.alias("passed_pct"),
        F.when(passed, F.lit(ready)).otherwise(F.lit(not_ready)).alias("verdict"),
    ).select("c.*", "passed_pct", "verdict")


def against_baseline(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Row counts against (table_name, expected_rows); tables without a baseline are listed as such."""
    return counts.join(expected.select("table_name", "expected_rows"), "table_name", "left").withColumn(
        "status",
        F.when(F.col("expected_rows").isNull(), F.lit("NO BASELINE"))
        .when(F.col("expected_rows") == F.col("row_count"), F.lit("MATCH"))
        .otherwise(F.lit("MISMATCH")),
    )
