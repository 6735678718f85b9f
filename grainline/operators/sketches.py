"""Profiles that can be merged: exact counts and extremes next to sketches of distinct values and quantiles.

The profile of a partition is one row per column. Stored profiles of many partitions are merged without reading any row
of the tables again; a new partition adds its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 200
# Error bounds: share of the distinct values, three standard errors, and of the rows, by rank.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.0165


def profile(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, column_name, row_count, null_count, min, max, distinct_sketch, quantile_sketch), one scan for all columns.

    Extremes and quantiles are those of the values as double; columns that are not numbers have none.
    """
    numeric = {f.name for f in df.schema if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}
    aggregates = []
    for k, c in enumerate(columns):
        value = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        key = F.xxhash64(c) if c in numeric else F.xxhash64(F.col(c).cast("string"))
        aggregates += [
            F.count(F.lit(1)).alias(f"row_count{k}"), F.count_if(F.col(c).isNull()).alias(f"null_count{k}"),
            F.min(value).alias(f"min{k}"), F.max(value).alias(f"max{k}"),
            F.hll_sketch_agg(F.when(F.col(c).isNotNull(), key), F.lit(LG_K)).alias(f"distinct_sketch{k}"),
            F.kll_sketch_agg_double(value, F.lit(KLL_K)).alias(f"quantile_sketch{k}"),
        ]
    names = ("row_count", "null_count", "min", "max", "distinct_sketch", "quantile_sketch")
    wide = df.groupBy(*by).agg(*aggregates)
    cells = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}{k}").alias(n) for n in names]) for k, c in enumerate(columns)]
    return wide.select(*by, F.explode(F.array(*cells)).alias("cell")).select(*by, "cell.*")


def merged(profiles: DataFrame, by: list[str]) -> DataFrame:
    """Profiles of fewer, larger groups; an empty ``by`` merges all."""
    return profiles.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct_sketch", F.lit(False)).alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def estimates(profiles: DataFrame, probabilities: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profiles with ``distinct_values`` and quantiles ``q25``, ... in place of their sketches."""
    has = F.kll_sketch_get_n_double("quantile_sketch") > 0
    quantiles = [
        F.when(has, F.kll_sketch_get_quantile_double(F.col("quantile_sketch"), F.lit(float(p)))).alias(f"q{round(p * 100)}") for p in probabilities
    ]
    return profiles.withColumn("distinct_values", F.hll_sketch_estimate("distinct_sketch")).select(
        *[c for c in profiles.columns if not c.endswith("_sketch")], "distinct_values", *quantiles
    )
