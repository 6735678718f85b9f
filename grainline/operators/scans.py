"""Running values over the ordered rows of a key, with no task that holds a whole key.

The rows are written in ranges of (keys, order): ranges have about the same number of rows, wherever the values of the
order lie, and a hot key is cut into many. Within a range a window gives the running values; what the ranges before it
hold of the same key is carried in. Only the keys at the edges of ranges are carried, at most one row per range and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainline.operators.keys import any_null
from grainline.session import settle

PART = "_range"


def in_ranges(df: DataFrame, keys: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """The rows, written in ranges of (keys, order) with the number of their range.

    Rows without a key or a place in the order are left out. ``ranges`` defaults to the shuffle partitions of the session.
    """
    placed = df.where(~any_null([*keys, *order]))
    by = [F.col(c) for c in (*keys, *order)]
    ranged = placed.repartitionByRange(ranges, *by) if ranges else placed.repartitionByRange(*by)
    # the number of the range is written with the rows: it stays the same however the table is read
    return settle(ranged.withColumn(PART, F.spark_partition_id()), "ranges")


def _carried(ranged: DataFrame, keys: list[str], order: list[str], sums: dict[str, str], lasts: dict[str, str]) -> DataFrame:
    """Per range and key that began in an earlier range: sums and last values of all ranges before."""
    at = F.struct(*keys)
    edges = ranged.groupBy(PART).agg(F.min(at).alias("low"), F.max(at).alias("high"))
    ends = edges.select(PART, F.explode(F.array("low", "high")).alias("at"))
    cut = ends.groupBy("at").agg(F.min(PART).alias("first"), F.max(PART).alias("last")).where("first < last").select("at.*")
    place = F.struct(*order)
    totals = ranged.join(cut, keys, "left_semi").groupBy(PART, *keys).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(n) for n, c in lasts.items()],
    )
    # one row per range of a key
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        PART, *keys,
        *[F.sum(n).over(before).alias(f"_carried_{n}") for n in sums],
        *[F.last(n, ignorenulls=True).over(before).alias(f"_carried_{n}") for n in lasts],
    )


def running(
    ranged: DataFrame, keys: list[str], order: list[str],
    sums: dict[str, str] | None = None, fills: dict[str, str] | None = None, previous: dict[str, str] | None = None,
) -> DataFrame:
    """Add running values to rows written by ``in_ranges``; each mapping is output name to column.

    ``sums``: sum up to and with the row. ``fills``: last value that is not NULL, up to and with the row; ``previous``:
    the same without the row. ``order`` must tell the rows of a key apart, or ties take any order.
    """
    sums, fills, previous = sums or {}, fills or {}, previous or {}
    lasts = {**fills, **previous}
    inside = Window.partitionBy(PART, *keys).orderBy(*order)
    upto, before = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    local: list[Column] = [
        *[F.sum(c).over(upto).alias(n) for n, c in sums.items()],
        *[F.last(c, ignorenulls=True).over(upto).alias(n) for n, c in fills.items()],
        *[F.last(c, ignorenulls=True).over(before).alias(n) for n, c in previous.items()],
    ]
    carried = _carried(ranged, keys, order, sums, lasts)
    rows = ranged.select("*", *local).join(carried, [PART, *keys], "left")
    whole = [
        *[(F.col(n) + F.coalesce(F.col(f"_carried_{n}"), F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(F.col(n), F.col(f"_carried_{n}")).alias(n) for n in lasts],
    ]
    return rows.select(*[c for c in ranged.columns if c != PART], *whole)
