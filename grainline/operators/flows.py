"""Units through the supply chain: first-in-first-out consumption, and recalled units along a chain of references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.operators.keys import any_null
from grainline.operators.scans import in_ranges, running
from grainline.session import settle

_END = (1 << 63) - 1
# Links of a task that spreads units.
TASK_LINKS = 250_000


def _intervals(rows: DataFrame, keys: list[str], order: list[str], name: str, units: str, ranges: int | None) -> DataFrame:
    """(keys, name, low, high): the units of a row as an interval of all units of its key, in order."""
    kept = rows.where(F.col(units) > 0).select(*keys, *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)], F.col(name).alias("_id"), F.col(units).cast("bigint").alias("_units"))
    by = [f"_o{k}" for k in range(len(order))] + ["_id"]
    summed = running(in_ranges(kept, keys, by, ranges), keys, by, sums={"_high": "_units"})
    return summed.select(*keys, "_id", (F.col("_high") - F.col("_units")).alias("_low"), "_high")


def fifo(
    supply: DataFrame, use: DataFrame, keys: list[str], supply_id: str, supply_order: list[str], supply_units: str,
    use_id: str, use_order: list[str], use_units: str, ranges: int | None = None,
) -> DataFrame:
    """(keys, supply_id, use_id, units): which use took how many units of which supply, first in first out per key.

    Supplies and uses of a key are laid end to end, each from 0 on; where two intervals overlap, the use took from the
    supply. Each border starts one segment, and the supply and the use that hold there are the last ones that began: no
    pair is tried, and the number of segments is that of the rows. Units used beyond all supply have a NULL supply, units
    never used a NULL use, so the units of every row add up. Rows without positive units, key, order or id are left out.
    """
    sides = {
        "_s": _intervals(supply, keys, supply_order, supply_id, supply_units, ranges),
        "_u": _intervals(use, keys, use_order, use_id, use_units, ranges),
    }
    kinds = {name: f"struct<id:{rows.schema['_id'].dataType.simpleString()},high:bigint>" for name, rows in sides.items()}
    either = lambda at, kind, held: (at.alias("_at"), F.lit(kind).alias("_kind"), *[
        (held if n == name else F.lit(None)).cast(kinds[n]).alias(n) for n in sides
    ])
    begun, totals = [], []
    for k, (name, rows) in enumerate(sides.items()):
        begun.append(rows.select(*keys, *either(F.col("_low"), k, F.struct(F.col("_id").alias("id"), F.col("_high").alias("high")))))
        totals.append(rows.select(*keys, *[(F.col("_high") if n == name else F.lit(0).cast("bigint")).alias(n) for n in sides]))
    # past the last unit of a side nothing of it holds; both sides of each key get that border, at 0 if they have no row
    ends = totals[0].unionByName(totals[1]).groupBy(*keys).agg(*[F.max(n).alias(f"_total{n}") for n in sides])
    ended = []
    for k, name in enumerate(sides):
        ended.append(ends.select(*keys, *either(F.col(f"_total{name}"), k + 2, F.struct(F.lit(None).alias("id"), F.lit(_END).alias("high")))))
    events = reduce(lambda x, y: x.unionByName(y), [*begun, *ended])
    filled = running(in_ranges(events, keys, ["_at", "_kind"], ranges), keys, ["_at", "_kind"], fills={"_supply": "_s", "_use": "_u"})
    # a side that has not begun begins at the same place, in a later row
    both = filled.where(F.col("_supply").isNotNull() & F.col("_use").isNotNull())
    return (
        both.where(F.col("_supply.id").isNotNull() | F.col("_use.id").isNotNull())
        .select(*keys, F.col("_supply.id").alias(supply_id), F.col("_use.id").alias(use_id), (F.least("_supply.high", "_use.high") - F.col("_at")).alias("units"))
        .where("units > 0")
    )


def spread(units: DataFrame, links: DataFrame, source: list[str], target: list[str], weight: str, ranges: int | None = None) -> DataFrame:
    """(source, target, units): the units of each source over its targets, in proportion to the weights, in whole units.

    ``units`` has (source, units). With the targets of a source in order and w the weight up to each, a target gets
    floor(units * w / total) less what the ones before it got: the shares of a source add up to its units exactly.
    Links without source, target or positive weight are left out; sources without links have no row.
    """
    kept = links.where((F.col(weight) > 0) & ~any_null([*source, *target]))
    # a task gets about so many links, however many there are; those of other sources are not summed
    kept = kept.repartition(1 + links.count() // TASK_LINKS, *source).join(units.select(*source), source, "left_semi")
    pairs = kept.groupBy(*source, *target).agg(F.sum(weight).cast("bigint").alias("_w"))
    pairs = pairs.join(units.select(*source, F.col("units").alias("_units")), source)
    upto = running(in_ranges(pairs, source, target, ranges), source, target, sums={"_upto": "_w"})
    totals = upto.groupBy(*source).agg(F.sum("_w").alias("_total"))
    part = lambda w: F.call_function("div", F.col("_units").cast("decimal(19,0)") * w.cast("decimal(19,0)"), F.col("_total").cast("decimal(19,0)"))
    share = part(F.col("_upto")) - part(F.col("_upto") - F.col("_w"))
    return upto.join(totals, source).select(*source, *target, share.alias("units"))


def recall_units(start: DataFrame, steps: list[tuple], ranges: int | None = None) -> DataFrame:
    """(level, entity, units, stopped): recalled units along a chain of references.

    ``start`` has the columns of a key and ``units``, its level is ``start``. Each step is (link table, key to the level
    before, key of the next level, weight column, level name). At each level the units of an entity are spread over its
    links (see ``spread``); ``stopped`` are units of entities without links onwards, so the units of a level are those of
    the next and what stopped. The last level stops nothing. An entity is text, its values joined by slashes.
    """
    many = lambda key: [key] if isinstance(key, str) else list(key)
    text = lambda columns: F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).alias("entity")
    names = [c for c in start.columns if c != "units"]
    here = start.groupBy(*names).agg(F.sum("units").alias("units"))
    level, found = "start", None
    for link, towards, onwards, weight, next_level in steps:
        back, on = many(towards), many(onwards)
        source, target = [f"_from{k}" for k in range(len(back))], [f"_to{k}" for k in range(len(on))]
        renamed = link.select(*[F.col(c).alias(n) for c, n in zip(back, source)], *[F.col(c).alias(n) for c, n in zip(on, target)], F.col(weight).alias("_weight"))
        moved = settle(spread(here.toDF(*source, "units"), renamed, source, target, "_weight", ranges), "moved")
        # each source with a link has moved, if only 0 units
        linked = moved.select(*source).distinct().withColumn("_linked", F.lit(True))
        stays = F.when(F.col("_linked").isNull(), F.col("units")).otherwise(F.lit(0))
        rows = here.toDF(*source, "units").join(linked, source, "left").select(F.lit(level).alias("level"), text(source), "units", stays.cast("bigint").alias("stopped"))
        found = rows if found is None else found.unionByName(rows)
        here, level = moved.groupBy(*target).agg(F.sum("units").alias("units")), next_level
    last = here.select(F.lit(level).alias("level"), text([c for c in here.columns if c != "units"]), "units", F.lit(0).cast("bigint").alias("stopped"))
    return last if found is None else found.unionByName(last)
