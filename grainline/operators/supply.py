"""Supply-chain analytics on curated tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainline.functions.compare import days_between, percent
from grainline.operators.keys import any_null
from grainline.operators.scans import in_ranges, running


def trace(start: DataFrame, steps: list[tuple]) -> DataFrame:
    """Follow a chain of references and return (level, entity) for everything reached.

    ``start`` holds distinct keys of one or more columns. Each step is (link table, its key to the
    previous level, its key to the next level, level name); a key is a column or a list of columns,
    and with a composite key among them all entities are text, values joined by a slash. Every level is reduced to distinct keys
    before the next join, so fan-out never multiplies along the chain.
    """
    many = lambda key: [key] if isinstance(key, str) else list(key)
    composite = any(len(many(onwards)) > 1 for _, _, onwards, _ in steps)
    frontier, found = start, []
    for link, towards, onwards, level in steps:
        back, on = many(towards), many(onwards)
        left = [f"_from{k}" for k in range(len(back))]
        right = [f"_to{k}" for k in range(len(on))]
        frontier = (
            link.select(*[F.col(c).alias(n) for c, n in zip(back, left)], *[F.col(c).alias(n) for c, n in zip(on, right)])
            .join(frontier.toDF(*left), left, "left_semi")
            .where(~any_null(right))
            .select(*right)
            .distinct()
        )
        entity = F.concat_ws("/", *[F.col(c).cast("string") for c in right]) if composite else F.col(right[0])
        found.append(frontier.select(F.lit(level).alias("level"), entity.alias("entity")))
    return reduce(lambda a, b: a.unionByName(b), found)


def lifecycle(events: DataFrame, line: str, status: str, day: str, stages: list[str]) -> DataFrame:
    """One row per line: events, first date per stage and the lag between consecutive stages. NULL lines are left out."""
    firsts = [F.min(F.when(F.col(status) == s, F.col(day))).alias(f"first_{s}") for s in stages]
    lines = events.where(F.col(line).isNotNull()).groupBy(line).agg(F.count(F.lit(1)).alias("event_count"), F.min(day).alias("first_date"),
                                     F.max(day).alias("last_date"), *firsts)
    lags = [
        days_between(F.col(f"first_{a}"), F.col(f"first_{b}")).alias(f"{a}_to_{b}_days")
        for a, b in zip(stages, stages[1:])
    ]
    return lines.select("*", *lags)


def ledger_entries(moves: DataFrame, keep: list[str]) -> DataFrame:
    """Signed entries: +units at the receiving plant, -units at the sending plant."""
    sides = F.array(
        F.struct(F.col("to_plant_id").alias("plant_id"), F.col("units").alias("signed_units")),
        F.struct(F.col("from_plant_id").alias("plant_id"), (-F.col("units")).alias("signed_units")),
    )
    return (
        moves.select(*keep, F.explode(sides).alias("e"))
        .select(*keep, "e.*")
        .where(F.col("plant_id").isNotNull())
    )


def daily_balance(entries: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Closing balance per key and day. The window holds one row per calendar day."""
    per_day = entries.groupBy(*keys, day).agg(F.sum("signed_units").alias("net_units"))
    upto = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.withColumn("balance", F.sum("net_units").over(upto))


def running_balance(entries: DataFrame, keys: list[str], day: str, entry: str, chunk: int | None = None) -> DataFrame:
    """Balance after every single entry, ordered by (day, entry number).

    A running sum over ranges of entries: a range holds about the same number of rows whatever the entry numbers are, and
    a hot key, or a hot day of one, is cut into many. ``chunk`` aims at so many rows a range; without it there are as many
    ranges as shuffle partitions. ``entry`` is unique within (key, day). Entries without key, day or number have no place
    in the order; ``unplaced_entries`` returns them.
    """
    ranges = max(1, entries.count() // chunk) if chunk else None
    return running(in_ranges(entries, keys, [day, entry], ranges), keys, [day, entry], sums={"balance": "signed_units"})


def unplaced_entries(entries: DataFrame, keys: list[str], day: str, entry: str) -> DataFrame:
    """The entries that ``running_balance`` cannot place: without key, day or number."""
    return entries.where(any_null([*keys, day, entry]))


def plan_against_actual(
    plan: DataFrame, plan_units: str, actual: DataFrame, actual_units: str, keys: list[str]
) -> DataFrame:
    """Planned and executed units per key; both sides are summed before the full outer join."""
    p = plan.groupBy(*keys).agg(F.sum(plan_units).alias("planned_units"))
    a = actual.groupBy(*keys).agg(F.sum(actual_units).alias("actual_units"))
    joined = p.join(a, keys, "full_outer").na.fill(0, ["planned_units", "actual_units"])
    return joined.withColumn("difference", F.col("actual_units") - F.col("planned_units"))


def routing_share(orders: DataFrame, bridge: DataFrame, keys: list[str], flag: str, unmapped: str = "UNMAPPED") -> DataFrame:
    """Orders by the priority of the plant that served them. Orders are counted per key first."""
    served = orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return routing_totals(served.join(bridge.select(*keys, flag), keys, "left"), flag, "n", unmapped)


def routing_totals(served: DataFrame, flag: str, count: str, unmapped: str = "UNMAPPED") -> DataFrame:
    """``routing_share`` of orders that are counted already, next to the flag of their plant."""
    by_flag = served.groupBy(F.coalesce(F.col(flag), F.lit(unmapped)).alias(flag)).agg(F.sum(count).alias("order_count"))
    # one row per flag value reaches this window
    return by_flag.withColumn("share_pct", percent(F.col("order_count"), F.sum("order_count").over(Window.partitionBy())))


def demand_against_actual(demand: DataFrame, actual: DataFrame, key: str, target: str, units: str) -> DataFrame:
    """Target and distributed units per product, with the ratio; products without movement count 0."""
    moved = actual.groupBy(key).agg(F.sum(units).alias("actual_units"))
    joined = demand.select(key, F.col(target).alias("target_units")).join(moved, key, "left")
    done = F.coalesce(F.col("actual_units"), F.lit(0))
    return joined.select(
        key, "target_units", done.alias("actual_units"), F.round(F.try_divide(done, F.col("target_units")), 4).alias("ratio")
    )


def single_source(links: DataFrame, key: str, source: str) -> DataFrame:
    """Keys with exactly one distinct source. Smallest = largest decides it without a distinct count."""
    per_key = links.where(F.col(key).isNotNull() & F.col(source).isNotNull()).groupBy(key).agg(
        F.min(source).alias("only_source"), F.max(source).alias("_top"), F.count(F.lit(1)).alias("link_count")
    )
    return per_key.where(F.col("only_source") == F.col("_top")).drop("_top")


def date_dimension(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every calendar day between the smallest and largest date of the given columns."""
    low = F.least(*[F.min(c) for c in columns])
    high = F.greatest(*[F.max(c) for c in columns])
    days = df.agg(F.explode(F.sequence(low.cast("date"), high.cast("date"))).alias("date"))
    d = F.col("date")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("iso_weekday"),
    )


def status_totals(lines: DataFrame, status: str, measures: dict[str, tuple[str, str]], by: list[str]) -> DataFrame:
    """Quantities summed only over the lifecycle stage they belong to.

    ``measures`` maps an output name to (status value, quantity column).
    """
    sums = [
        F.coalesce(F.sum(F.when(F.col(status) == s, F.col(q))), F.lit(0)).alias(n) for n, (s, q) in measures.items()
    ]
    return lines.groupBy(*by).agg(*sums)


def return_patterns(lines: DataFrame, reason: Column, returned: Column, early_credit: Column) -> DataFrame:
    """Returns per reason, their share of the reason's lines and credits issued before the return."""
    return lines.groupBy(reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(returned).alias("return_count"),
        percent(F.count_if(returned), F.count(F.lit(1))).alias("return_pct"),
        F.count_if(returned & early_credit).alias("early_credits"),
    )


def hierarchy(children: DataFrame, child: str, parent_ref: str, parents: DataFrame, parent: str, keep: list[str]) -> DataFrame:
    """Each child with the kept columns of its parent; roots keep NULLs."""
    up = parents.select(F.col(parent).alias(parent_ref), *keep)
    # only the two keys of the child, so a table may be its own parent
    return children.select(child, parent_ref).join(up, parent_ref, "left").select(child, parent_ref, *keep)


def bridge_join(left: DataFrame, left_key: str, bridge: DataFrame, right: DataFrame, right_key: str) -> DataFrame:
    """Resolve a many-to-many link through its bridge."""
    return bridge.join(left, left_key).join(right, right_key)


def role_join(fact: DataFrame, dimension: DataFrame, key: str, roles: dict[str, str], keep: list[str]) -> DataFrame:
    """Join one dimension once per role; ``roles`` maps a fact column to a name prefix."""
    out = fact
    for column, prefix in roles.items():
        renamed = dimension.select(
            F.col(key).alias(column), *[F.col(k).alias(f"{prefix}_{k}") for k in keep]
        )
        out = out.join(renamed, column, "left")
    return out


def header_rollup(lines: DataFrame, header: str, distinct: dict[str, str], sums: dict[str, str]) -> DataFrame:
    """Per header: line count, distinct values of some columns, sums of others. Lines without a header are left out.

    Distinct values are counted one column at a time, by header and value first, and joined by header: no line is
    expanded once per column, and the lines of one header are shared by many tasks.
    """
    found = lines.where(F.col(header).isNotNull())
    out = found.groupBy(header).agg(F.count(F.lit(1)).alias("line_count"), *[F.sum(c).alias(n) for n, c in sums.items()])
    for n, c in distinct.items():
        out = out.join(found.groupBy(header).agg(F.countDistinct(c).alias(n)), header)
    return out.select(header, "line_count", *distinct, *sums)


def inconsistent_headers(lines: DataFrame, header: str, columns: list[str]) -> DataFrame:
    """Headers whose lines disagree on any of the columns.

    More than one distinct value is the same as smallest <> largest, so no row is expanded
    once per column and no distinct value is shuffled.
    """
    spread = lines.where(F.col(header).isNotNull()).groupBy(header).agg(
        *[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    )
    differs = [F.col(f"{c}_min") != F.col(f"{c}_max") for c in columns]
    return spread.where(reduce(lambda a, b: a | b, differs)).select(
        header, *[F.coalesce(d, F.lit(False)).alias(f"{c}_differs") for c, d in zip(columns, differs)]
    )
