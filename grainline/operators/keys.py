"""Keys and grain. All counts come from a grouped count, which combines on the map side.

A hot key is therefore one partial row per task, however many rows carry it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.functions.compare import percent


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in columns])


def key_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """Totals, NULLs and the three measures called "duplicates", in one row.

    surplus_rows: rows beyond the first of each key. duplicated_keys: keys seen more than
    once. rows_in_duplicates: all rows of those keys.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    whole = ~any_null(keys)
    twice = whole & (F.col("n") > 1)
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(~whole, F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count_if(whole).alias("distinct_keys"),
        F.count_if(twice).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(twice, F.col("n"))), F.lit(0)).alias("rows_in_duplicates"),
    )
    surplus = F.col("rows_in_duplicates") - F.col("duplicated_keys")
    return counts.select(
        F.lit("+".join(keys)).alias("key_columns"),
        "total_rows",
        "null_rows",
        "distinct_keys",
        surplus.alias("surplus_rows"),
        "duplicated_keys",
        "rows_in_duplicates",
        ((F.col("null_rows") == 0) & (F.col("duplicated_keys") == 0)).alias("is_key"),
    )


def repeated_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Total rows, distinct keys and rows beyond the first of each key, where a key with NULLs is a key like any other."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        total.alias("total_rows"), F.count(F.lit(1)).alias("distinct_keys"), (total - F.count(F.lit(1))).alias("surplus_rows")
    )


def null_key_breakdown(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    return df.where(any_null(keys)).groupBy(*by).agg(F.count(F.lit(1)).alias("null_count"))


def composite_nulls(df: DataFrame, keys: list[str]) -> DataFrame:
    """NULLs per key column and rows with any NULL, in one aggregation."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(k).isNull()).alias(f"{k}_nulls") for k in keys],
        F.count_if(any_null(keys)).alias("null_key_rows"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys without NULL seen more than once, with their number of rows."""
    return (
        df.where(~any_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .where(F.col("occurrence_count") > 1)
    )


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row of a duplicated key.

    A window over the key would put all rows of a hot key into one task. The semi join
    keeps one row per key on its right, and AQE may split a hot left partition.
    """
    return df.join(duplicate_keys(df, keys).select(*keys), keys, "left_semi")


def duplicate_distribution(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys occur twice, three times and so on."""
    return duplicate_keys(df, keys).groupBy("occurrence_count").agg(F.count(F.lit(1)).alias("key_count"))


def composite_distinct(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct combinations, those with NULLs included."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("distinct_rows"))


def rows_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, and the fewest, most and mean rows per key. NULL keys are left out."""
    per_key = df.where(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("key_count"),
        F.min("n").alias("min_rows"),
        F.max("n").alias("max_rows"),
        F.round(F.try_divide(F.sum("n"), F.count(F.lit(1))), 4).alias("avg_rows"),
    )


def rows_per_value(df: DataFrame, column: str) -> DataFrame:
    """All rows, NULLs included, per distinct value that is not NULL."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(column).alias("distinct_values"),
        F.round(F.try_divide(F.sum("n"), F.count(column)), 4).alias("avg_rows"),
    )


def repeated_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column combinations without NULL that occur on more than one row."""
    return duplicate_keys(df, columns).withColumnRenamed("occurrence_count", "row_count")


def distinct_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Number of distinct non-NULL values per non-NULL key.

    Two group-bys instead of a distinct count: the first spreads a hot key over its values.
    """
    pairs = df.where(F.col(key).isNotNull()).select(key, value).distinct()
    return pairs.groupBy(key).agg(F.count(value).alias("distinct_values"))


def candidate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values, NULLs and unique ratio of each column.

    The columns are unpivoted and grouped by (column, value): every row is read once, and
    a value repeated within a task leaves it as one partial count.
    """
    values = unpivoted(df, columns)
    per_value = values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    per_column = per_value.groupBy("column_name").agg(
        F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
        F.sum("n").alias("total_rows"),
    )
    return per_column.select(
        "column_name",
        "total_rows",
        "distinct_values",
        "null_rows",
        F.round(F.try_divide(F.col("distinct_values"), F.col("total_rows")), 4).alias("unique_ratio"),
    )


def unpivoted(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value as text), one row per cell."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def duplicate_definitions(df: DataFrame, columns: list[str], top: int | None = 10) -> DataFrame:
    """Attribute combinations held by several rows, most frequent first."""
    found = duplicate_keys(df, columns).withColumnRenamed("occurrence_count", "row_count")
    return found if top is None else found.orderBy(F.desc("row_count"), *columns).limit(top)


def join_fanout(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows an inner join on ``key`` would return, computed without performing it."""
    ln = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("left_rows"))
    rn = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("right_rows"))
    return fanout_from_counts(ln, rn, key)


def fanout_from_counts(ln: DataFrame, rn: DataFrame, key: str) -> DataFrame:
    both = ln.join(rn, key, "left")
    pairs = F.col("left_rows") * F.coalesce(F.col("right_rows"), F.lit(0))
    return both.agg(
        F.sum("left_rows").alias("left_rows"),
        F.sum(pairs).alias("joined_rows"),
        F.coalesce(F.max("right_rows"), F.lit(0)).alias("max_matches"),
        F.round(F.try_divide(F.sum(pairs), F.sum("left_rows")), 4).alias("fanout_factor"),
    )


def exactly_one(parents: DataFrame, parent_key: str, links: DataFrame, link_key: str, condition: Column) -> DataFrame:
    """Parents without a qualifying link, and parents with more than one, as one row."""
    per_key = links.where(condition).groupBy(link_key).agg(F.count(F.lit(1)).alias("n"))
    all_keys = parents.select(F.col(parent_key).alias(link_key)).distinct()
    joined = all_keys.join(per_key, link_key, "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    return joined.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(n == 0).alias("without"),
        F.count_if(n == 1).alias("exactly_one"),
        F.count_if(n > 1).alias("more_than_one"),
    )


def flag_coverage(df: DataFrame, key: str, flag: str, values: list[str]) -> DataFrame:
    """Distinct keys in total and per flag value."""
    pairs = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max((F.col(flag) == v)).alias(f"_{i}") for i, v in enumerate(values)]
    )
    return pairs.agg(
        F.count(F.lit(1)).alias("all_keys"),
        *[F.count_if(F.col(f"_{i}")).alias(f"{v.lower()}_keys") for i, v in enumerate(values)],
    )


def prefix_rate(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that satisfy a condition, with their share."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(condition).alias("matching_rows"),
        percent(F.count_if(condition), F.count(F.lit(1))).alias("match_pct"),
    )
