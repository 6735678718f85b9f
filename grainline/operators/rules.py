"""Row rules: any number of them evaluated in one aggregation over one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.functions.compare import percent


@dataclass(frozen=True, eq=False)
class Rule:
    """``violation`` is true for an offending row.

    ``null_policy`` says what a NULL verdict means: "ignore" it or count it as a
    "violation". Up to ``limit_pct`` percent of violations yields ``within_limit``, more
    yields ``on_breach``.
    """

    rule_id: str
    category: str
    violation: Column
    null_policy: str = "ignore"
    limit_pct: float = 0.0
    within_limit: str = "WARN"
    on_breach: str = "FAIL"

    @property
    def broken(self) -> Column:
        return F.coalesce(self.violation, F.lit(self.null_policy == "violation"))


def verdict(violations: Column, pct: Column, limit: Column, within: Column, breach: Column) -> Column:
    """PASS without violations, else ``within`` up to the limit, else ``breach``."""
    return (
        F.when(violations == 0, F.lit("PASS"))
        .when(F.coalesce(pct <= limit, F.lit(False)), within)
        .otherwise(breach)
    )


def _rule_rows(counted: DataFrame, rules: list[Rule], table: str, violations: list[Column]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(r.category).alias("category"),
            n.cast("bigint").alias("violations"),
            F.lit(float(r.limit_pct)).alias("limit_pct"),
            F.lit(r.within_limit).alias("within"),
            F.lit(r.on_breach).alias("breach"),
        )
        for r, n in zip(rules, violations)
    ]
    long = counted.select(F.col("_total"), F.explode(F.array(*entries)).alias("r")).select("_total", "r.*")
    pct = percent(F.col("violations"), F.col("_total"))
    # an empty table breaks no row rule, so its share is 0
    pct = F.coalesce(pct, F.lit(0.0))
    return long.select(
        F.lit(table).alias("table_name"),
        "rule_id",
        "category",
        verdict(F.col("violations"), pct, F.col("limit_pct"), F.col("within"), F.col("breach")).alias("status"),
        "violations",
        F.col("_total").alias("total"),
        pct.alias("pct"),
    )


def evaluate(df: DataFrame, rules: list[Rule], table: str = "") -> DataFrame:
    """One row per rule: (table_name, rule_id, category, status, violations, total, pct)."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(r.broken).alias(f"_{i}") for i, r in enumerate(rules)],
    )
    return _rule_rows(counted, rules, table, [F.col(f"_{i}") for i in range(len(rules))])


def tagged(df: DataFrame, rules: list[Rule], column: str = "broken_rules") -> DataFrame:
    """The rows with the array of rule ids each one breaks."""
    return df.withColumn(column, broken_ids(rules))


def broken_ids(rules: list[Rule]) -> Column:
    """The array of broken rule ids.

    ``array_except`` drops the NULLs inside generated code; ``array_compact`` is a lambda, for
    which Spark would interpret every rule.
    """
    ids = F.array(*[F.when(r.broken, F.lit(r.rule_id)) for r in rules])
    return F.array_except(ids, F.array(F.lit(None).cast("string")))


def evaluate_tagged(df: DataFrame, rules: list[Rule], table: str = "", column: str = "broken_rules") -> DataFrame:
    """The result of ``evaluate``, from rows that already carry their broken rules."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[
            F.count_if(F.array_contains(column, r.rule_id)).alias(f"_{i}")
            for i, r in enumerate(rules)
        ],
    )
    return _rule_rows(counted, rules, table, [F.col(f"_{i}") for i in range(len(rules))])


def rejects(df: DataFrame, rules: list[Rule], keep: list[str] | None = None) -> DataFrame:
    """One row per (offending row, broken rule). Row-local: no shuffle.

    The outer form of explode matters: for the plain form the optimizer adds a filter on the
    size of the array below it, and with it a second evaluation of every rule.
    """
    columns = keep or df.columns
    rows = df.select(*columns, broken_ids(rules).alias("_broken"))
    return rows.select(F.explode_outer("_broken").alias("rule_id"), *columns).where(F.col("rule_id").isNotNull())


def reject_sample(df: DataFrame, rule: Rule, order: list[str], limit: int = 500) -> DataFrame:
    """The first offenders of one rule in key order, for a report a person reads."""
    return df.where(rule.broken).orderBy(*order).limit(limit)
