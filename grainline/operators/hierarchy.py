"""Hierarchies of any depth: root, depth and path of every node, subtree totals and cycles.

Pointer jumping: each round replaces the pointer of a node by the pointer of what it points to, so a round doubles the
distance covered and a tree of depth d takes log2(d) rounds. In a finite tree every round reaches nodes that the one
before did not; when a round reaches none, what is left runs into a cycle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.session import settle


def links(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, parent, state): each node once; a node given with several parents keeps the smallest.

    ``state`` is root, orphan (the parent is no node) or below. NULL nodes are left out.
    """
    each = nodes.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(parent).alias("parent"))
    known = each.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    state = F.when(F.col("parent").isNull(), "root").when(F.col("known").isNull(), "orphan").otherwise("below")
    return each.join(known, "parent", "left").select("node", "parent", state.alias("state"))


def climb(nodes: DataFrame, node: str, parent: str) -> tuple[DataFrame, DataFrame]:
    """Two frames: (node, parent, root, depth, path, state) of the nodes below a root or an orphan, and (node, parent) of
    those that run into a cycle. ``path`` is an array from the root to the node; roots and orphans have depth 0."""
    start = settle(links(nodes, node, parent), "hierarchy-links")
    base = F.when(F.col("state") != "below", F.col("node"))
    rows = start.select(
        "node", base.alias("root"), F.when(F.col("state") == "below", F.col("parent")).alias("up"),
        F.when(F.col("state") == "below", 1).otherwise(0).alias("depth"), F.array("node").alias("path"),
    )
    open_nodes = rows.where("root is null").count()
    while open_nodes:
        ahead = rows.select(F.col("node").alias("up"), F.col("root").alias("_root"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("path").alias("_path"))
        jumped = rows.where("root is null").join(ahead, "up").select(
            "node", F.col("_root").alias("root"), F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"),
            F.concat("_path", "path").alias("path"),
        )
        rows = settle(rows.where("root is not null").unionByName(jumped), "hierarchy-jump")
        still = rows.where("root is null").count()
        if still == open_nodes:
            break
        open_nodes = still
    placed = rows.where("root is not null").select("node", "root", "depth", "path").join(start, "node")
    circling = rows.where("root is null").select("node").join(start, "node").select("node", "parent")
    return placed.select("node", "parent", "root", "depth", "path", "state"), circling


def cycles(circling: DataFrame) -> DataFrame:
    """(node, cycle, on_cycle) of nodes that run into a cycle; ``cycle`` is the smallest node on it."""
    steps = settle(circling.select("node", F.col("parent").alias("up")), "hierarchy-circling")
    # far enough along, the pointers of all nodes name the nodes on cycles and no others
    far, on = steps, steps.select("up").distinct().count()
    while True:
        ahead = far.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        far = settle(far.join(ahead, "up").select("node", F.col("_up").alias("up")), "hierarchy-far")
        now = far.select("up").distinct().count()
        if now == on:
            break
        on = now
    members = far.select(F.col("up").alias("node")).distinct()
    # the smallest node of a cycle: pointers and smallest nodes seen double together
    low = settle(steps.join(members, "node", "left_semi").select("node", "up", F.col("node").alias("low")), "hierarchy-low")
    while True:
        ahead = low.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("low").alias("_low"))
        after = low.join(ahead, "up").select("node", F.col("_up").alias("up"), F.least("low", "_low").alias("low"), (F.col("_low") < F.col("low")).alias("moved"))
        after = settle(after, "hierarchy-low")
        low = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    found = low.select(F.col("node").alias("up"), F.col("low").alias("cycle"))
    on_cycle = low.select("node", F.lit(True).alias("on_cycle"))
    return far.join(found, "up").join(on_cycle, "node", "left").select("node", "cycle", F.coalesce("on_cycle", F.lit(False)).alias("on_cycle"))


def paths(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root, depth, path, state) of every node; path is text, keys from the root joined by slashes.

    States: root, orphan, below, cycle (on one), circling (below one). The last two have the smallest node of the cycle as
    root and neither depth nor path. An empty table gives no rows.
    """
    placed, circling = climb(nodes, node, parent)
    rings = cycles(circling).select(
        "node", F.col("cycle").alias("root"), F.lit(None).cast("int").alias("depth"), F.lit(None).cast("string").alias("path"),
        F.when(F.col("on_cycle"), "cycle").otherwise("circling").alias("state"),
    )
    text = F.array_join(F.transform("path", lambda k: k.cast("string")), "/")
    return placed.select("node", "root", "depth", text.alias("path"), "state").unionByName(rings)


def closure(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(ancestor, node, distance): every node with all nodes above it and itself, cycles left out."""
    placed, _ = climb(nodes, node, parent)
    above = placed.select("node", "depth", F.posexplode("path").alias("place", "ancestor"))
    return above.select("ancestor", "node", (F.col("depth") - F.col("place")).alias("distance"))


def subtree_totals(nodes: DataFrame, node: str, parent: str, measures: dict[str, str]) -> DataFrame:
    """Per node: nodes in its subtree, itself included, greatest distance below it and sums of columns of ``nodes``.

    Sums are added up per task first, so the node above all others is no hot key.
    """
    values = nodes.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(*[F.sum(c).alias(f"_{n}") for n, c in measures.items()])
    return closure(nodes, node, parent).join(values, "node").groupBy(F.col("ancestor").alias("node")).agg(
        F.count(F.lit(1)).alias("subtree_nodes"), F.max("distance").alias("height"), *[F.sum(f"_{n}").alias(n) for n in measures]
    )
