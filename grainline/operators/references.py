"""Foreign keys.

Counts come from the distinct keys of the child with their row counts, so the join sees
one row per key and neither a hot key nor a mostly NULL key reaches a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainline.functions.compare import percent


def reference_check(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str, optional: bool = False
) -> DataFrame:
    """One row: rows checked, orphans and overlap percent of a foreign key.

    A NULL key is an orphan, unless the key is optional: then NULL rows are not checked.
    """
    per_key = child.groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    if optional:
        per_key = per_key.where(F.col("_k").isNotNull())
    known = parent.select(F.col(parent_column).alias("_k"), F.lit(True).alias("_hit")).where(F.col("_k").isNotNull())
    joined = per_key.join(known.distinct(), "_k", "left")
    hit = F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_n"))), F.lit(0))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return joined.agg(total.alias("checked_rows"), hit.alias("_found")).select(
        F.lit(name).alias("reference"),
        "checked_rows",
        (F.col("checked_rows") - F.col("_found")).alias("orphan_rows"),
        percent(F.col("_found"), F.col("checked_rows")).alias("overlap_pct"),
    )


def common_type(a: T.DataType, b: T.DataType) -> str:
    """The type in which a key and what it refers to are compared; numbers as numbers, whatever their types."""
    exact = {"byte": 3, "short": 5, "integer": 10, "long": 19}

    def decimal(t):
        return (t.precision, t.scale) if isinstance(t, T.DecimalType) else (exact[t.typeName()], 0) if t.typeName() in exact else None

    if a == b:
        return a.simpleString()
    one, two = decimal(a), decimal(b)
    if one and two:
        scale = max(one[1], two[1])
        return f"decimal({min(38, max(one[0] - one[1], two[0] - two[1]) + scale)},{scale})"
    if all(decimal(t) or t.typeName() in ("float", "double") for t in (a, b)):
        return "double"
    moments = ("date", "timestamp", "timestamp_ntz")
    return "timestamp_ntz" if a.typeName() in moments and b.typeName() in moments else "string"


def reference_checks(child: DataFrame, edges: list[tuple]) -> DataFrame:
    """``reference_check`` for several keys of one table, read once.

    ``edges`` holds (name, column, parent, parent column, optional). Both sides of an edge are cast to their common type,
    so 1 and 1.00 are the same key; then the keys are unpivoted as text and grouped by (reference, key), the parents
    likewise, so that one join serves all of them. A table without rows has no result.
    """
    kind = {n: common_type(child.schema[c].dataType, p.schema[pc].dataType) for n, c, p, pc, _ in edges}
    cells = [F.struct(F.lit(n).alias("reference"), F.lit(o).alias("_o"), F.col(c).cast(kind[n]).cast("string").alias("_k")) for n, c, _, _, o in edges]
    per_key = (
        child.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
        .where(~F.col("_o") | F.col("_k").isNotNull())
        .groupBy("reference", "_k").agg(F.count(F.lit(1)).alias("_n"))
    )
    known = [
        p.select(F.lit(n).alias("reference"), F.col(pc).cast(kind[n]).cast("string").alias("_k")).where(F.col("_k").isNotNull()).distinct()
        for n, _, p, pc, _ in edges
    ]
    parents = known[0]
    for more in known[1:]:
        parents = parents.unionByName(more)
    joined = per_key.join(parents.withColumn("_hit", F.lit(True)), ["reference", "_k"], "left")
    return joined.groupBy("reference").agg(
        F.sum("_n").alias("checked_rows"), F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_n"))), F.lit(0)).alias("_found")
    ).select(
        "reference",
        "checked_rows",
        (F.col("checked_rows") - F.col("_found")).alias("orphan_rows"),
        percent(F.col("_found"), F.col("checked_rows")).alias("overlap_pct"),
    )


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str, optional: bool = False) -> DataFrame:
    """The child rows whose key has no parent.

    NULL keys can match nothing and would all hash to one partition, so they bypass the join.
    """
    keys = parent.select(F.col(parent_column).alias(column))
    unmatched = child.where(F.col(column).isNotNull()).join(keys, column, "left_anti").select(*child.columns)
    return unmatched if optional else unmatched.unionByName(child.where(F.col(column).isNull()))


def unreferenced(parent: DataFrame, parent_column: str, child: DataFrame, column: str) -> DataFrame:
    """Parent rows no child points to."""
    used = child.select(F.col(column).alias(parent_column)).distinct()
    return parent.join(used, parent_column, "left_anti").select(*parent.columns)


def unexpected_values(df: DataFrame, column: str, expected: list) -> DataFrame:
    """Distinct non-NULL values outside the expected set, with their row counts."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(expected))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
