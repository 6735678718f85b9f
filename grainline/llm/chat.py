"""Chat formatting with collapse of cumulative snapshots.

Applications often log a conversation again after each turn. Every conversation gets a rolling hash of its first k
turns, for each k; one that equals a prefix of a longer one is a snapshot and goes. Of equal conversations the one with
the smallest id stays. What remains is rendered. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainline.llm.common import settle

# The markers of the ChatML layout.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the turns in order, each once.

    Order is by turn, NULL first, then role and text; repeated rows count once. A NULL role is 'unknown', a NULL text is
    empty. A row without conv_id is a conversation of its own, so its place is 1.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).dropDuplicates()
    by_conv = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    named = rows.where("conv_id is not null").withColumn("place", F.row_number().over(by_conv))
    return named.unionByName(rows.where("conv_id is null").withColumn("place", F.lit(1)))


def _lane(seed: int):
    return F.xxhash64(F.lit(seed), "place", "role", "text")


def prefix_hashes(ordered: DataFrame) -> DataFrame:
    """conv_id, place, n_turns, a, b: two rolling hashes of the turns up to each place.

    Each combines 64-bit hashes of (place, role, text) by exclusive or, which no length overflows; equal hashes at equal
    places mean equal prefixes.
    """
    by_conv = Window.partitionBy("conv_id")
    upto = by_conv.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    named = ordered.where("conv_id is not null").select(
        "conv_id", "place", F.count("*").over(by_conv).alias("n_turns"),
        F.bit_xor(_lane(1)).over(upto).alias("a"), F.bit_xor(_lane(2)).over(upto).alias("b"),
    )
    # rows without id do not meet: each is a whole conversation
    alone = ordered.where("conv_id is null").select("conv_id", "place", F.lit(1).cast("bigint").alias("n_turns"), _lane(1).alias("a"), _lane(2).alias("b"))
    return named.unionByName(alone)


def maximal(hashes: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, a, b of the conversations that no longer one starts with."""
    key = ["place", "a", "b"]
    full = hashes.where(F.col("place") == F.col("n_turns"))
    # counted by content first: a conversation logged many times is one row per task before the shuffle; min leaves out NULL
    distinct = full.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = hashes.where(F.col("place") < F.col("n_turns")).select(*key).distinct()
    return distinct.join(proper, key, "left_anti").select("conv_id", F.col("place").cast("bigint").alias("n_turns"), "n_copies", "a", "b")


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, rendered: one row per maximal conversation.

    A rendered conversation is one value and thus bounded by what a row can hold; turns of one conversation meet in one
    task, nothing else does. Rows without conv_id are conversations of one turn; those of equal role and text are copies.
    An empty table gives no rows; further columns are ignored.
    """
    ordered = turns(conversations)
    hashes = settle(prefix_hashes(ordered), "chat-hashes")
    stay = settle(maximal(hashes), "chat-maximal")
    line = F.concat(F.lit(TURN_START), "role", F.lit("\n"), "text", F.lit(TURN_END + "\n"))
    kept = ordered.join(stay.where("conv_id is not null").select("conv_id", "n_turns", "n_copies"), "conv_id")
    texts = kept.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"))
    named = texts.select("conv_id", "n_turns", "n_copies", F.array_join("lines.line", "").alias("rendered"))
    alone = ordered.where("conv_id is null").select(_lane(1).alias("a"), _lane(2).alias("b"), line.alias("rendered")).distinct()
    alone = stay.where("conv_id is null").join(alone, ["a", "b"]).select("conv_id", "n_turns", "n_copies", "rendered")
    return named.unionByName(alone)
