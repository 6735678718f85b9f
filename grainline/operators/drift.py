"""Drift between two states of a table: rows and distributions per partition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The statuses of a partition.
STABLE, COUNT_DRIFT, VALUE_DRIFT, ADDED, REMOVED = "STABLE", "COUNT DRIFT", "VALUE DRIFT", "NEW", "MISSING"


def value_counts(df: DataFrame, labels: list[str], columns: list[str]) -> DataFrame:
    """(labels, column_name, value, n): counts of the values of some columns, as text, per partition, in one scan."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    rows = df.select(*labels, F.explode(F.array(*cells)).alias("cell")).select(*labels, "cell.*")
    return rows.groupBy(*labels, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def drift(
    before: DataFrame, after: DataFrame, labels: list[str], columns: list[str], count_limit: float = 20.0, distance_limit: float = 0.1
) -> DataFrame:
    """(labels, column_name, rows_before, rows_after, change_pct, distance, status) per partition and column.

    ``distance`` is the total variation distance of the values: half the sum of the differences of their shares, worked
    out in whole numbers. A partition drifts when its rows change by more than ``count_limit`` percent or a distance
    exceeds ``distance_limit``; one that only one side has is NEW or MISSING. Values are counted before the sides meet.
    """
    sides = [
        value_counts(before, labels, columns).withColumnsRenamed({"n": "b"}).withColumn("a", F.lit(0).cast("bigint")),
        value_counts(after, labels, columns).withColumnsRenamed({"n": "a"}).withColumn("b", F.lit(0).cast("bigint")),
    ]
    values = sides[0].unionByName(sides[1]).groupBy(*labels, "column_name", "value").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    group = [*labels, "column_name"]
    totals = values.groupBy(*[F.col(n).alias(f"_{n}") for n in group]).agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"))
    same = reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in group])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    joined = values.join(totals, same)
    apart = F.sum(F.abs(wide("b") * wide("rows_after") - wide("a") * wide("rows_before"))).alias("apart")
    found = joined.groupBy(*group, "rows_before", "rows_after").agg(apart)
    distance = F.round(F.try_divide(F.col("apart").cast("double"), 2.0 * F.col("rows_before") * F.col("rows_after")), 6)
    change = F.round(F.try_divide(100.0 * (F.col("rows_after") - F.col("rows_before")), F.col("rows_before")), 4)
    status = (
        F.when(F.col("rows_before") == 0, ADDED).when(F.col("rows_after") == 0, REMOVED)
        .when(F.abs(F.col("change_pct")) > count_limit, COUNT_DRIFT).when(F.col("distance") > distance_limit, VALUE_DRIFT).otherwise(STABLE)
    )
    return found.select(
        *labels, "column_name", "rows_before", "rows_after", change.alias("change_pct"),
        F.when((F.col("rows_before") > 0) & (F.col("rows_after") > 0), distance).alias("distance"),
    ).withColumn("status", status)
