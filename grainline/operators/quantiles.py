"""Exact descriptive statistics and quantiles.

The rows are grouped once to (column, value, number of rows) and written, sorted by range of column and value. Ranks then
come from running sums within each range and the totals of the ranges before it, so no task holds all values of a column
and no value is rounded or scaled. The result is a plan over the written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainline.session import scratch

QUARTILES = (0.25, 0.5, 0.75)


def exact_type(df: DataFrame, columns: list[str]) -> str:
    """A decimal that holds every value of whole-number and decimal columns as it is."""
    digits = {"byte": (3, 0), "short": (5, 0), "integer": (10, 0), "long": (19, 0)}
    sizes = []
    for c in columns:
        kind = df.schema[c].dataType
        if not isinstance(kind, T.DecimalType) and kind.typeName() not in digits:
            raise TypeError(f"{c}: {kind.simpleString()} has no exact decimal type")
        sizes.append((kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else digits[kind.typeName()])
    scale = max((s for _, s in sizes), default=0)
    whole = max((p - s for p, s in sizes), default=1)
    if whole + scale > 38:
        raise TypeError(f"{columns}: {whole} digits before and {scale} after the point do not fit a decimal")
    return f"decimal({whole + scale},{scale})"


def _counted(df: DataFrame, columns: list[str], weight: str | None, kind: str = "double") -> DataFrame:
    """Written rows (column_name, v, n, part): each value of each column once. NULL and NaN are left out."""
    value = lambda c: F.nanvl(F.col(c).cast(kind), F.lit(None)) if kind == "double" else F.col(c).cast(kind)
    cells = [F.struct(F.lit(c).alias("column_name"), value(c).alias("v")) for c in columns]
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    values = df.select(w.alias("w"), F.explode(F.array(*cells)).alias("cell")).select("w", "cell.*").where(F.col("v").isNotNull())
    ranged = values.groupBy("column_name", "v").agg(F.sum("w").alias("n")).repartitionByRange("column_name", "v")
    path = scratch(df.sparkSession, "quantiles")
    # the number of the range is written with the rows: it stays the same however the table is read
    ranged.withColumn("part", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _at_ranks(counted: DataFrame, columns: list[str], probabilities: tuple[float, ...]) -> DataFrame:
    """column_name, probability, value with linear interpolation between neighbours."""
    # one row per column and range of the write
    totals = counted.groupBy("column_name", "part").agg(F.sum("n").alias("held"))
    before = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("column_name", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    upto = Window.partitionBy("column_name", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        counted.withColumn("last", F.sum("n").over(upto))
        .join(offsets, ["column_name", "part"])
        .select("column_name", "v", (F.col("offset") + F.col("last")).alias("last"), "n")
    )
    # two ranks per column and probability, both fixed by the arguments
    place = (F.col("rows") - 1) * F.col("probability")
    wanted = (
        counted.groupBy("column_name").agg(F.sum("n").alias("rows"))
        .select("column_name", "rows", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability"))
        .select("column_name", "probability", F.floor(place).alias("low"), F.least(F.floor(place) + 1, F.col("rows") - 1).alias("high"),
                (place - F.floor(place)).alias("share"))
        .limit(len(columns) * len(probabilities))
    )
    within = lambda rank: (F.col(rank) < F.col("last")) & (F.col(rank) >= F.col("last") - F.col("n"))
    found = ranked.join(F.broadcast(wanted), "column_name").where(within("low") | within("high"))
    return found.groupBy("column_name", "probability", "share").agg(
        F.max(F.when(within("low"), F.col("v"))).alias("a"), F.max(F.when(within("high"), F.col("v"))).alias("b")
    ).select("column_name", "probability", _between(counted.schema["v"].dataType).alias("value"))


def _between(kind: T.DataType):
    """Linear interpolation between a and b; decimals gain as many digits after the point as they have room for, up to 9."""
    a, b, share = F.col("a"), F.col("b"), F.col("share")
    if not isinstance(kind, T.DecimalType):
        return F.when(a == b, a).otherwise(a + (b - a) * share)
    scale = min(kind.scale + 9, 38 - (kind.precision - kind.scale))
    room = f"decimal({kind.precision - kind.scale + scale},{scale})"
    # the difference alone is multiplied by a share below 1, so the larger part stays exact
    step = ((b - a).cast("decimal(28,9)") * share.cast("decimal(10,9)")).cast(room)
    return F.when(a == b, a.cast(room)).otherwise((a.cast(room) + step).cast(room))


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: tuple[float, ...] = QUARTILES, weight: str | None = None
) -> DataFrame:
    """(column_name, probability, value) with linear interpolation between neighbours.

    ``weight`` names a count column when each row stands for several equal rows. NULL and NaN are left out; a column
    without values has no row.
    """
    return _at_ranks(_counted(df, columns, weight), columns, probabilities)


def describe(df: DataFrame, columns: list[str], weight: str | None = None, digits: int | None = 4, exact: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each column, one row per column always.

    A column without values has count 0 and NULL otherwise. ``digits`` rounds the result, never the input; None keeps it.
    Values are doubles, so whole numbers beyond 2^53 are rounded; ``exact`` takes whole-number and decimal columns only and
    gives minimum, quartiles and maximum as decimals, unrounded (mean and deviation are doubles).
    """
    counted = _counted(df, columns, weight, exact_type(df, columns) if exact else "double")
    rows, n, v = F.sum("n"), F.col("n"), F.col("v").cast("double")
    moments = counted.groupBy("column_name").agg(
        rows.alias("count"), (F.sum(n * v) / rows).alias("mean"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    # deviations from the mean, as differences of large squares would cancel
    square = F.sum(n * (v - F.col("mean")) * (v - F.col("mean")))
    spread = (
        counted.join(F.broadcast(moments.select("column_name", "mean", F.col("count").alias("rows"))), "column_name")
        .groupBy("column_name", "rows").agg(square.alias("s"))
        .select("column_name", F.sqrt(F.try_divide(F.col("s"), F.col("rows") - 1)).alias("std"))
    )
    quartile = lambda p: F.max(F.when(F.col("probability") == p, F.col("value")))
    quartiles = _at_ranks(counted, columns, QUARTILES).groupBy("column_name").agg(
        *[quartile(p).alias(f"q{int(p * 100)}") for p in QUARTILES]
    )
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    out = names.join(moments, "column_name", "left").join(spread, "column_name", "left").join(quartiles, "column_name", "left")
    kept = ("min", "q25", "q50", "q75", "max") if exact else ()
    shown = [F.col(c) if digits is None or c in kept else F.round(c, digits).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    return out.select("column_name", F.coalesce("count", F.lit(0)).alias("count"), *shown)
