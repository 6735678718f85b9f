"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a run of ``SEED`` words are joined. For each such pair the longest common runs
of words are marked first, none overlapping another, until no run of ``SEED`` words is left (running Karp-Rabin greedy
string tiling). The share of the item's words under tiles is its coverage: reordered passages count like those in order.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm import tokens
from grainline.llm.common import count_words, named, same_text, settle, text_key, whole

SEED = 4
THRESHOLD = 0.5
# Items up to this many words in all are sent to every task; a larger benchmark is joined by shuffle.
BROADCAST_WORDS = 2_000_000


def tile(item, text, shortest, least=0):
    """Tiles (length, item start, text start), longest first; ties go to the smaller starts.

    None at all where the words of the item under runs that the text has as well, which bound the tiles, are below ``least``.
    """
    shortest = min(shortest, len(item))
    if not shortest:
        return []
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    same = {}
    start, total = tokens.windows(item, np.zeros(len(item), np.int8), shortest)
    for p, h in zip(start.tolist(), total.tolist()):
        same.setdefault(h, []).append(p)
    where, hashed = tokens.windows(text, np.zeros(len(text), np.int8), shortest)
    seeds = np.flatnonzero(np.isin(hashed, total))
    if least:
        under = np.zeros(len(item) + 1, np.int64)
        places = start[np.isin(total, hashed[seeds])]
        np.add.at(under, places, 1)
        np.add.at(under, places + shortest, -1)
        if np.count_nonzero(np.cumsum(under[:-1])) < least:
            return []
    pairs = [(p, int(where[k])) for k in seeds for p in same[int(hashed[k])]]
    found = []
    while True:
        runs, reached = [], {}
        for p, t in pairs:
            if reached.get(t - p, -1) > t or not (free_item[p] and free_text[t]):
                continue
            most = min(len(item) - p, len(text) - t)
            good = (item[p : p + most] == text[t : t + most]) & free_item[p : p + most] & free_text[t : t + most]
            n = most if good.all() else int(good.argmin())
            reached[t - p] = t + n
            if n >= shortest:
                runs.append((-n, p, t))
        if not runs:
            return found
        heapq.heapify(runs)
        while runs:
            n, p, t = heapq.heappop(runs)
            n = -n
            free = free_item[p : p + n] & free_text[t : t + n]
            if free.all():
                free_item[p : p + n] = free_text[t : t + n] = False
                found.append((n, p, t))
                continue
            # what a longer tile has left of the run waits for its turn by length
            edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8))).tolist()
            for a, b in zip(edges[::2], edges[1::2]):
                if b - a >= shortest:
                    heapq.heappush(runs, (a - b, p + a, t + a))


def _words(texts):
    """Word hashes per text, as a list of arrays."""
    found = tokens.Words(texts, lower=True)
    hashed = found.hashes()
    return [hashed[a:b] for a, b in zip(found.starts[:-1], found.starts[1:])], found, hashed


def _known(items, shortest):
    """(item ids, their word hashes, sorted seed hashes, item position of each)."""
    split, _, _ = _words(pa.array([t for _, t in items], "string"))
    seeds, owner = [], []
    for k, item in enumerate(split):
        _, hashed = tokens.windows(item, np.zeros(len(item), np.int8), min(shortest, max(1, len(item))))
        seeds.append(np.unique(hashed))
        owner.append(np.full(len(seeds[-1]), k))
    seeds, owner = np.concatenate(seeds or [np.zeros(0, np.uint64)]), np.concatenate(owner or [np.zeros(0, int)])
    order = np.argsort(seeds, kind="stable")
    lengths = sorted({min(shortest, len(i)) for i in split if len(i)})
    return [i for i, _ in items], split, seeds[order], owner[order], lengths


def _coverage_of_all(known, shortest, threshold, item_type):
    ids, items, seeds, owner, lengths = known

    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch):
                split, found, hashed = _words(part.column("text"))
                hits = set()
                for size in lengths:
                    start, total = found.windows(size, hashed)
                    low, high = np.searchsorted(seeds, total), np.searchsorted(seeds, total, "right")
                    for k in np.flatnonzero(high > low):
                        hits.update((int(found.doc[start[k]]), int(o)) for o in owner[low[k] : high[k]])
                out = [[], [], [], []]
                for d, o in sorted(hits):
                    covered = sum(n for n, _, _ in tile(items[o], split[d], shortest, threshold * len(items[o])))
                    if covered:
                        for column, value in zip(out, (part.column("doc_id")[d].as_py(), part.column("text_key")[d].as_py(), ids[o], covered / len(items[o]))):
                            column.append(value)
                kinds = (batch.schema.field("doc_id").type, pa.int64(), item_type, pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "text_key", "item_id", "coverage"])

    return run


def _seed_rows(names, lengths):
    """Rows (ids..., seed) of every distinct run of the given numbers of words; of an item, only its longest such run."""

    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch):
                split, _, _ = _words(part.column("text"))
                rows, seeds = [], []
                for k, own in enumerate(split):
                    for size in lengths if names != ["item_id"] else [min(lengths[-1], len(own))]:
                        _, hashed = tokens.windows(own, np.zeros(len(own), np.int8), size)
                        seeds.append(np.unique(hashed))
                        rows.append(np.full(len(seeds[-1]), k))
                at = pa.array(np.concatenate(rows) if rows else np.zeros(0, int))
                values = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([*(part.column(n).take(at) for n in names), pa.array(values.view(np.int64))], [*names, "seed"])

    return run


def _coverage_of_pairs(shortest, threshold):
    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch):
                items, texts = _words(part.column("item_text"))[0], _words(part.column("text"))[0]
                covered = [sum(n for n, _, _ in tile(i, t, shortest, threshold * len(i))) / len(i) for i, t in zip(items, texts)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in ("doc_id", "text_key", "item_id")), pa.array(covered, "float64")], ["doc_id", "text_key", "item_id", "coverage"]
                )

    return run


def coverage(
    documents: DataFrame, benchmark: DataFrame, shortest: int = SEED, broadcast_words: int = BROADCAST_WORDS, threshold: float = 0.0
) -> DataFrame:
    """doc_id, text_key, item_id, coverage per pair that shares a run of ``shortest`` words (or a whole shorter item).

    With a ``threshold``, pairs that cannot reach it are not tiled: their shared runs alone cover too few words of the item;
    they have no row or a coverage of 0. An item_id is an integer; of any other type it is taken as text.

    Words are runs of characters other than white space, in ASCII lower case. NULL and empty texts share nothing. Items
    that share an id are items of their own. The benchmark goes to every task only up to ``broadcast_words`` words;
    beyond that, pairs come from a shuffled join of seeds and both texts join them.
    """
    kind = dict(documents.dtypes)["doc_id"]
    docs = documents.select("doc_id", whole(F.col("text")).alias("text"), text_key(F.col("text")).alias("text_key"))
    numbered = dict(benchmark.dtypes)["item_id"] in ("tinyint", "smallint", "int", "bigint")
    item_kind = "bigint" if numbered else "string"
    items = benchmark.select(F.col("item_id").cast(item_kind).alias("item_id"), "text").where(count_words(F.col("text")) > 0).distinct()
    chars = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    result = f"doc_id {kind}, text_key bigint, item_id {item_kind}, coverage double"
    if chars <= 8 * broadcast_words:
        known = _known([(r["item_id"], r["text"]) for r in items.collect()], shortest)
        return docs.mapInArrow(_coverage_of_all(known, shortest, threshold, pa.int64() if numbered else pa.string()), result)
    lengths = [r[0] for r in items.select(F.least(count_words(F.col("text")), F.lit(shortest)).cast("int")).distinct().collect()]
    seeds = items.mapInArrow(_seed_rows(["item_id"], [shortest]), f"item_id {item_kind}, seed bigint").distinct()
    shared = docs.mapInArrow(_seed_rows(["doc_id", "text_key"], lengths), f"doc_id {kind}, text_key bigint, seed bigint")
    # a document and an item with too few runs in common go no further; the runs of an item are at most its words
    common = shared.join(seeds, "seed").groupBy("doc_id", "text_key", "item_id").agg(F.count("*").alias("runs"))
    sizes = items.groupBy("item_id").agg(F.min(count_words(F.col("text"))).alias("words")).withColumnRenamed("item_id", "__item")
    enough = common.join(sizes, F.col("item_id").eqNullSafe(F.col("__item"))).where(F.col("runs") * shortest >= F.lit(threshold) * F.col("words"))
    pairs = settle(enough.select("doc_id", "text_key", "item_id"), "tiling-pairs")
    once = docs.dropDuplicates(["doc_id", "text_key"])
    same = pairs["doc_id"].eqNullSafe(once["doc_id"]) & (pairs["text_key"] == once["text_key"])
    texts = pairs.join(once, same).select(pairs["doc_id"], pairs["text_key"], "item_id", "text")
    known = items.select(F.col("item_id").alias("__item"), F.col("text").alias("item_text"))
    both = texts.join(known, F.col("item_id").eqNullSafe(F.col("__item"))).drop("__item")
    return both.mapInArrow(_coverage_of_pairs(shortest, threshold), result)


def findings(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, coverage, n_items, contaminated per row: the best covered item and the number at the threshold.

    Ties go to the smaller item_id. Rows without a shared run have NULL, 0.0, 0 and false; so has every row when the
    benchmark is empty. Rows that repeat an id and a text agree. An empty table gives no rows.
    """
    pairs = coverage(documents, benchmark)
    best = pairs.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(
        F.min(F.struct((-F.col("coverage")).alias("minus"), "item_id")).alias("best"),
        F.count_distinct(F.when(F.col("coverage") >= threshold, F.col("item_id"))).alias("n_items"),
    )
    rows = documents.select("doc_id", text_key(F.col("text")).alias("text_key"))
    joined = rows.join(best, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")), "left")
    covered = F.coalesce(-F.col("best.minus"), F.lit(0.0))
    return joined.select(
        "doc_id",
        F.col("best.item_id").alias("item_id"),
        covered.alias("coverage"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        (covered >= threshold).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, with all their columns, that cover no item up to the threshold."""
    dirty = named(coverage(documents, benchmark, threshold=threshold).where(F.col("coverage") >= threshold))
    return documents.join(dirty, same_text(documents, dirty), "left_anti")
