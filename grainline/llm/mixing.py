"""Mixing sources to target weights by Sainte-Lague apportionment.

Each source has a target number of words. Blocks of equally many words are allocated to the sources by highest
quotients target / (2 s + 1), then each source's quota to its shards in the same way, by shard size. A shard is a slice
of the source by a seeded hash of the ids, of about ``shard_rows`` documents; its documents in seeded order form one
stream of words, cut into blocks. The blocks taken are a run of consecutive blocks (around the end) from a seeded
start; a quota above the number of blocks takes all blocks once first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainline.llm.common import count_words, settle

BLOCK = 16
SHARD_ROWS = 1000
SEED = "mix-1"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2


def _seeded(seed, *parts):
    """32 bits of a seeded md5 of the parts, as bigint."""
    text = F.concat_ws(":", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, n_rows, target per source.

    The weights go round over the sources by code point, NULL last. What a source would get above ``repeats`` times its
    size goes to the others by weight, until none is above. The driver sees three sums per round.
    """
    by_source = Window.orderBy(F.col("source").isNull(), "source")
    choice = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(by_source) - 1) % len(weights) + 1)
    groups = settle(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")).withColumn("weight", choice),
        "mix-sources",
    )
    level, held = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > repeats * F.col("source_size")
        row = groups.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(above, repeats * F.col("source_size"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if row["held"] == held or row["weight"] == 0:
            break
        held = row["held"]
        level = (share * row["total"] - held) / row["weight"]
    target = F.least(F.col("weight") * F.lit(level), (repeats * F.col("source_size")).cast("double"))
    return groups.select("source", "source_size", "n_rows", target.alias("target"))


def apportion(parties: DataFrame, group: list[str], order: list, votes: str, house: str) -> DataFrame:
    """Add ``seats``: Sainte-Lague shares of ``house`` seats within each group, by highest quotients votes / (2 s + 1).

    With n parties, the divisors total / (house + n / 2) and total / (house - n / 2) bound the last quotient that wins a
    seat, so a party is given what it holds at the larger divisor, and only the at most 2 n quotients between the two are ranked.
    Ties go by ``order``. Parties without votes get nothing.
    """
    whole = Window.partitionBy(*group)
    n, total = F.count(F.when(F.col(votes) > 0, 1)).over(whole), F.sum(votes).over(whole)
    at = lambda house: F.when(
        (F.col(votes) > 0) & (house > 0), F.floor(F.col(votes) / (F.col("__total") / house) + 0.5)
    ).otherwise(F.lit(0)).cast("bigint")
    bounded = parties.withColumns({"__n": n, "__total": total.cast("double")}).withColumns(
        {
            "__low": F.greatest(at(F.col(house) - F.col("__n") / 2) - 1, F.lit(0)),
            "__high": F.when(F.col(house) > 0, at(F.col(house) + F.col("__n") / 2) + 1).otherwise(F.lit(0)).cast("bigint"),
        }
    )
    left = F.col(house) - F.sum("__low").over(whole)
    open_seats = bounded.withColumn("__left", left).select(
        "*", F.explode_outer(F.when(F.col(votes) > 0, F.filter(F.sequence("__low", "__high"), lambda s: s < F.col("__high")))).alias("__seat")
    )
    quotient = F.col(votes) / (2 * F.col("__seat") + 1)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc_nulls_last(quotient), *order))
    won = F.sum(F.when(F.col("__seat").isNotNull() & (F.col("__rank") <= F.col("__left")), 1).otherwise(0))
    return (
        open_seats.withColumn("__rank", rank)
        .groupBy(*parties.columns)
        .agg((F.max("__low") + won).cast("bigint").alias("seats"))
    )


def mix(
    documents: DataFrame,
    block: int = BLOCK,
    shard_rows: int = SHARD_ROWS,
    seed: str = SEED,
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, passes, spans per row of ``documents``.

    The whole document is taken ``passes`` times and, once more, each of ``spans``: (start, end) by words, end exclusive.
    ``taken`` is the number of words of all these. NULL texts have size 0 and are taken 0 times. NULL is a source of its own, the last. Rows that repeat an id are
    documents of their own with neighbouring places in the stream. An empty table gives no rows. Only doc_id, text and
    source are read.
    """
    sizes = settle(documents.select("doc_id", "source", count_words(F.col("text")).alias("size")), "mix-sizes")
    sources = targets(sizes, weights, share, repeats)
    wanted = sources.withColumn("house", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("bigint"))
    quotas = settle(
        apportion(wanted, [], [F.col("source").isNull(), "source"], "target", "house").select(
            "source", "source_size", "target", F.ceil(F.col("n_rows") / shard_rows).alias("shards"), F.col("seats").alias("quota")
        ),
        "mix-quotas",
    )
    # one row per source: a label set, far below what a broadcast of checked size takes; Spark decides by its size
    shard = F.floor(_seeded(seed, F.col("doc_id")) * F.col("shards") / F.lit(1 << 32)).cast("bigint")
    placed = (
        sizes.alias("d")
        .join(quotas.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source")))
        .select("d.doc_id", "d.source", "d.size", "source_size", "target", "quota", shard.alias("shard"))
    )
    shards = placed.groupBy("source", "shard", "quota").agg(F.sum("size").alias("shard_size"))
    shards = settle(apportion(shards, ["source"], ["shard"], "shard_size", "quota"), "mix-shards")
    blocks = F.ceil(F.col("shard_size") / block)
    runs = shards.withColumns({"blocks": blocks, "seats": F.least(F.col("seats"), repeats * blocks)}).select(
        F.col("source").alias("__source"),
        F.col("shard").alias("__shard"),
        "shard_size",
        F.when(F.col("blocks") > 0, F.floor(F.col("seats") / F.col("blocks"))).otherwise(0).alias("passes"),
        F.when(F.col("blocks") > 0, F.col("seats") % F.col("blocks")).otherwise(0).alias("run"),
        F.when(F.col("blocks") > 0, _seeded(seed, F.col("source"), F.col("shard")) % F.col("blocks")).otherwise(0).alias("start"),
        "blocks",
    )
    order = Window.partitionBy("source", "shard").orderBy(_seeded(seed + ":o", F.col("doc_id")), "doc_id", "size")
    streamed = placed.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    here = streamed.join(
        runs, streamed["source"].eqNullSafe(F.col("__source")) & (streamed["shard"] == F.col("__shard"))
    ).withColumn("since", F.col("upto") - F.col("size"))

    def overlap(first, last):
        start, stop = F.greatest("since", first) - F.col("since"), F.least("upto", last) - F.col("since")
        return F.struct(start.cast("bigint").alias("start"), stop.cast("bigint").alias("end"))

    end = F.col("start") + F.col("run")
    straight = overlap(F.col("start") * block, F.least(F.col("shard_size"), F.least(end, F.col("blocks")) * block))
    around = overlap(F.lit(0), F.greatest(F.lit(0), end - F.col("blocks")) * block)
    spans = F.filter(F.array(straight, around), lambda x: x["end"] > x["start"])
    words = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return here.withColumn("spans", spans).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + words).cast("bigint").alias("taken"),
        F.col("passes").cast("bigint").alias("passes"),
        "spans",
    )
