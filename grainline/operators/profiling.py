"""Profiles: inventories, distributions, crosstabs, completeness and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainline.functions.compare import percent
from grainline.operators.keys import any_null, unpivoted


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table."""
    return _stack(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
         for n, df in tables.items()]
    )


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: position, type and the rows and columns of its table."""
    frames = []
    for name, df in tables.items():
        cells = [
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("data_type"))
            for i, (c, t) in enumerate(df.dtypes, start=1)
        ]
        frames.append(
            df.agg(F.count(F.lit(1)).alias("row_count"))
            .select("row_count", F.explode(F.array(*cells)).alias("c"))
            .select(F.lit(name).alias("table_name"), "c.*", "row_count", F.lit(len(df.columns)).alias("column_count"))
        )
    return _stack(frames)


def empty_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Whether each table has no row at all. Reads one row per table, not the table."""
    return _stack(
        [df.limit(1).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), (F.col("n") == 0).alias("is_empty"))
         for n, df in tables.items()]
    )


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count, null percent and success percent per column, in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    long = counted.select("total_rows", F.explode(F.array(*cells)).alias("c")).select("c.*", "total_rows")
    return long.select(
        "column_name",
        "null_count",
        "total_rows",
        percent(F.col("null_count"), F.col("total_rows")).alias("null_pct"),
        percent(F.col("total_rows") - F.col("null_count"), F.col("total_rows")).alias("success_pct"),
    )


def total_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    counts = [F.count_if(F.col(c).isNull()) for c in columns]
    return df.agg(F.count(F.lit(1)).alias("total_rows"), reduce(lambda a, b: a + b, counts).alias("null_cells"))


def value_counts(df: DataFrame, columns: list[str], keep_null: bool = False) -> DataFrame:
    """Rows per value or combination of values."""
    rows = df if keep_null else df.where(~any_null(columns))
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))


def top_groups(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """The k largest groups; ties are broken by the group itself."""
    return value_counts(df, columns).orderBy(F.desc("row_count"), *columns).limit(k)


def share_within(df: DataFrame, group: str, value: str) -> DataFrame:
    """Percent of each value within its group, whose total is joined: a group of many values stays spread."""
    counted = value_counts(df, [group, value])
    total = counted.groupBy(group).agg(F.sum("row_count").alias("_total"))
    shares = counted.join(total, group)
    return shares.withColumn("share_pct", percent(F.col("row_count"), F.col("_total"))).drop("_total")


def crosstab(df: DataFrame, rows: Column, columns: Column, values: list, names: list[str], row_name: str) -> DataFrame:
    """Row counts of one indicator against another; ``values`` fixes the output columns."""
    pairs = df.select(rows.alias(row_name), columns.alias("_c")).where(
        F.col(row_name).isNotNull() & F.col("_c").isNotNull()
    )
    return pairs.groupBy(row_name).agg(
        *[F.count_if(F.col("_c") == v).alias(n) for v, n in zip(values, names)]
    )


def crosstab_margins(df: DataFrame, rows: str, columns: str, values: list, names: list[str]) -> DataFrame:
    """Crosstab with an ``All`` row and an ``all_columns`` total; rows with a NULL are dropped."""
    pairs = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return (
        pairs.rollup(rows)
        .agg(
            F.grouping_id().alias("_g"),
            *[F.count_if(F.col(columns) == v).alias(n) for v, n in zip(values, names)],
            F.count(F.lit(1)).alias("all_columns"),
        )
        .select(F.when(F.col("_g") == 1, F.lit("All")).otherwise(F.col(rows)).alias(rows), *names, "all_columns")
    )


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows that satisfy each named condition, in one pass, as (condition, row_count)."""
    counted = df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
    cells = [F.struct(F.lit(n).alias("condition"), F.col(n).alias("row_count")) for n in conditions]
    return counted.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def date_ranges(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    counted = df.agg(
        *[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    )
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}_min").alias("first_date"),
            F.col(f"{c}_max").alias("last_date"),
        )
        for c in columns
    ]
    return counted.select(F.lit(table).alias("table_name"), F.explode(F.array(*cells)).alias("c")).select("table_name", "c.*")


def distinct_years(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(F.year(column).alias("year")).distinct()


def null_pattern(df: DataFrame, category: str, columns: list[str]) -> DataFrame:
    """Rows per category and combination of NULL indicators. NULL categories are left out."""
    marks = [F.col(c).isNull().alias(f"{c}_null") for c in columns]
    return df.where(F.col(category).isNotNull()).groupBy(category, *marks).agg(F.count(F.lit(1)).alias("row_count"))


def column_profile(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Long profile (table_name, column_name, metric, value): rows, nulls, distinct, most_frequent.

    One unpivot and two group-bys for all columns; the first one combines on the map side.
    """
    cells = unpivoted(df, columns or df.columns)
    per_value = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    filled = F.col("value").isNotNull()
    per_column = per_value.groupBy("column_name").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(filled).alias("distinct"),
        F.coalesce(F.max(F.when(filled, F.col("n"))), F.lit(0)).alias("most_frequent"),
    )
    metrics = ["rows", "nulls", "distinct", "most_frequent"]
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]
    return per_column.select(
        F.lit(table).alias("table_name"), "column_name", F.explode(F.array(*pairs)).alias("m")
    ).select("table_name", "column_name", "m.*")


def samples(df: DataFrame, key: list[str], columns: list[str], n: int = 5) -> DataFrame:
    """First, last and scattered rows. The scatter orders by a hash of the key, so it repeats."""
    scattered = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]))
    kept = df.select(*dict.fromkeys([*key, *columns]))
    pieces = [
        ("head", kept.orderBy(*key)),
        ("tail", kept.orderBy(*[F.desc(k) for k in key])),
        ("random", kept.orderBy(scattered, *key)),
    ]
    return _stack([piece.limit(n).select(F.lit(name).alias("sample"), *columns) for name, piece in pieces])
