"""Source divergence audit: how far the terms of a source differ from the other sources of its language.

Terms are counted by sorting pointers. In each shard, a slice of an Arrow batch, the starts of all terms point into the
text buffer; the pointers are sorted by a slice of seven bytes of their terms, and runs of equal slices go on to the next,
until the terms end. A run of equal terms then gives its documents and its occurrences per source. What leaves a shard is
one row per (language, source, term). Documents per term decide which terms a language keeps; smoothed shares of whole
numbers are compared between sources, over blocks of terms, and with the whole language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainline.llm import tokens
from grainline.llm.common import settle
from grainline.llm.infill import buffer_of

LEAST_DOCUMENTS = 3
TOP = 200
SCALE = 1_000_000_000
SHARD_BYTES = 8 << 20
# Cells (terms times sources) that one block of the comparison holds.
BLOCK_CELLS = 200_000

_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= 0x61) & ((_BYTES | 32) <= 0x7A) & (_BYTES < 0x80) | (_BYTES >= 0x80)
_FOLDED = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
# Keeps the first k bytes of a word whose first byte is the highest.
_HEAD = np.array([0, *(((1 << 8 * k) - 1) << (64 - 8 * k) for k in range(1, 9))], np.uint64)


def term_pointers(raw: np.ndarray, offsets: np.ndarray):
    """(start, length, text position) of every term: a run of letters and bytes above 0x7F within one text."""
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = _LETTER[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    # texts may follow each other without a gap
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    start = np.flatnonzero(first)
    # a run ends before the next byte that is none of it, or where its text ends
    stop = np.append(np.flatnonzero(~inside), len(raw))
    end = stop[np.searchsorted(stop, start)]
    doc = np.searchsorted(offsets, start, side="right") - 1
    return start, np.minimum(end, offsets[doc + 1]) - start, doc


def sort_pointers(raw: np.ndarray, start: np.ndarray, length: np.ndarray):
    """(order, run): the pointers in the order of their terms, and for each place the first place of its equal terms.

    A multikey quicksort on slices of seven bytes: what is sorted by one slice falls into runs of equal slices; a run
    whose terms go on is open, and only open runs are sorted by the next slice, each in its own places.
    """
    folded = np.concatenate((_FOLDED[raw], np.zeros(24, np.uint8)))
    # eight bytes from each multiple of eight on, as numbers that compare like the bytes
    words = folded[: len(folded) // 8 * 8].view(">u8").astype(np.uint64)
    order, run = np.arange(len(start)), np.zeros(len(start), np.int64)
    active, depth = np.arange(len(start)), 0
    while len(active):
        at, left = start[order[active]] + depth, length[order[active]] - depth
        word, shift = at >> 3, ((at & 7) * 8).astype(np.uint64)
        key = (words[word] << shift) | ((words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - shift))
        # seven bytes, cut where the term ends; the last byte tells its length, or 8 for a term that goes on
        left = np.minimum(left, 8)
        key = (key & _HEAD[np.minimum(left, 7)]) | left.astype(np.uint64)
        by_key = np.argsort(key) if depth == 0 else np.lexsort((key, run[active]))
        order[active] = order[active][by_key]
        key, left, group = key[by_key], left[by_key], run[active]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        run[active] = active[np.flatnonzero(new)[np.cumsum(new) - 1]]
        active = active[left == 8]
        depth += 7
    return order, run


def count_terms(texts: pa.Array, group: np.ndarray):
    """(text of the terms, group, occurrences, documents) per distinct (term, group) of a shard."""
    raw, _, offsets = buffer_of(texts)
    start, length, doc = term_pointers(raw, offsets)
    if not len(start):
        return pa.array([], pa.string()), *(np.zeros(0, np.int64) for _ in range(3))
    order, run = sort_pointers(raw, start, length)
    doc = doc[order]
    # within a run, by document: its documents and, through their groups, its sources
    _, run = np.unique(run, return_inverse=True)
    by_doc = np.argsort(run * np.int64(len(group)) + doc, kind="stable")
    run, doc, order = run[by_doc], doc[by_doc], order[by_doc]
    new_doc = np.ones(len(run), bool)
    new_doc[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
    groups = int(group.max()) + 1
    key, place, which = np.unique(run * groups + group[doc], return_index=True, return_inverse=True)
    head = order[place]
    texts_ = _slices(_FOLDED[raw], start[head], length[head])
    return texts_, key % groups, np.bincount(which, minlength=len(key)), np.bincount(which, new_doc, len(key)).astype(np.int64)


def _slices(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The strings at the given places of a buffer."""
    ends = np.concatenate(([0], np.cumsum(length)))
    at = np.repeat(start - ends[:-1], length) + np.arange(ends[-1])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[at])).cast(pa.string())


COUNTED = "lang string, source string, term string, n bigint, docs bigint"


def _counting():
    names = [c.split()[0] for c in COUNTED.split(", ")]

    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch, limit=SHARD_BYTES):
                lang, source = part.column("lang").dictionary_encode(), part.column("source").dictionary_encode()
                pair = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                _, first, group = np.unique(pair, return_index=True, return_inverse=True)
                terms, which, n, docs = count_terms(part.column("text"), group)
                of = pa.array(first[which])
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(of), part.column("source").take(of), terms, pa.array(n.astype(np.int64)), pa.array(docs)], names
                )

    return run


def _named(documents: DataFrame) -> DataFrame:
    return documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, n, docs per (lang, source, term): occurrences and documents. Added up per task before the shuffle."""
    found = _named(documents).mapInArrow(_counting(), COUNTED)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, term, n, lang_n, first of the terms in at least ``least`` documents of their language.

    ``first`` holds for one source of each term. A window has one row per source of a term.
    """
    by_term = Window.partitionBy("lang", "term")
    rows = counts.select(
        "lang", "source", "term", "n", F.sum("n").over(by_term).alias("lang_n"), F.sum("docs").over(by_term).alias("lang_docs"),
        (F.col("source") == F.min("source").over(by_term)).alias("first"),
    )
    return rows.where(F.col("lang_docs") >= least).drop("lang_docs")


def group_sizes(documents: DataFrame, entries: DataFrame) -> DataFrame:
    """lang, source, total, kept, lang_total, sources of every group that occurs, also of those without terms."""
    groups = _named(documents.withColumn("text", F.lit(""))).select("lang", "source").distinct()
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("kept"))
    both = groups.join(sizes, ["lang", "source"], "left").fillna(0, ["total", "kept"])
    langs = both.groupBy("lang").agg(F.sum("kept").alias("kept"), F.sum("total").alias("lang_total"), F.count("*").alias("sources"))
    return both.drop("kept").join(langs, "lang")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exact for any count; 1 where there is no term."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", top, F.greatest(total + kept, F.lit(1)).cast("decimal(20,0)")) + 1


def _compared(table: pa.Table) -> pa.Table:
    """source, item, value of all pairs of sources of a language over one block of terms."""
    source, p = table.column("source").combine_chunks().dictionary_encode(), table.column("p").to_numpy()
    source = source.combine_chunks() if isinstance(source, pa.ChunkedArray) else source
    term = table.column("term").combine_chunks().dictionary_encode()
    term = term.combine_chunks() if isinstance(term, pa.ChunkedArray) else term
    names, column = source.dictionary, source.indices.to_numpy()
    absent = term.indices.is_null().to_numpy(zero_copy_only=False)
    # a row without a term has the share of terms that its source lacks
    base = np.ones(len(names), np.int64)
    base[column[absent]] = p[absent]
    shares = np.tile(base, (len(term.dictionary), 1))
    shares[term.indices.filter(pa.array(~absent)).to_numpy().astype(np.int64), column[~absent]] = p[~absent]
    values = np.array([((shares[:, [k]] - shares) ** 2 // shares).sum(axis=0) for k in range(len(names))], np.int64)
    one, two = (x.ravel() for x in np.indices(values.shape))
    other = one != two
    lang = table.column("lang").combine_chunks()
    return pa.table(
        {
            "lang": lang.take(pa.array(np.zeros(int(other.sum()), np.int64))),
            "source": names.take(pa.array(one[other])),
            "item": names.take(pa.array(two[other])),
            "value": pa.array(values.ravel()[other]),
        }
    )


def pair_divergence(entries: DataFrame, sizes: DataFrame, cells: int = BLOCK_CELLS) -> DataFrame:
    """lang, source, item, value: sum over all kept terms of (p - q)^2 / q between each two sources of a language.

    A block holds the terms of a hash range and all sources, about ``cells`` shares, whatever the size of the language;
    what blocks pass on is one sum per pair. The pairs are the result: its size is given by the sources of a language.
    """
    blocks = F.greatest(F.ceil(F.col("kept") * F.col("sources") / cells), F.lit(1)).cast("int")
    p = share(F.col("n"), F.col("total"), F.col("kept")).alias("p")
    held = entries.join(sizes, ["lang", "source"]).select("lang", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), "source", "term", p)
    absent = sizes.withColumn("n", F.lit(0).cast("bigint")).select(
        "lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), p
    )
    sums = held.unionByName(absent).groupBy("lang", "block").applyInArrow(_compared, "lang string, source string, item string, value bigint")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergence(entries: DataFrame, sizes: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value: the ``top`` kept terms a source has more of than its language, by (p - q)^2 / q.

    The rank limit is taken in each task before rows meet, so a large source does not gather in one.
    """
    rows = entries.join(sizes, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    more = rows.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    return _ranked(more).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: what sets the sources of each language apart.

    Terms are runs of letters and characters above U+007F, A-Z in lower case; a language keeps those in at least ``least``
    of its documents. The share of a term in a group is 1 + floor(10^9 (n + 1) / (N + V)), all in whole numbers. Part
    ``pair`` has the divergence from every other source of the language, part ``term`` the ``top`` terms a source has more
    of than its language. NULL text, lang and source count as empty; each row is a document, also one that repeats
    another; a group without terms has its pairs, with a language that keeps no term at 0; an empty table gives no rows.
    Other columns are ignored, texts of any length are read whole.
    """
    entries = settle(kept_terms(term_counts(documents), least), "divergence-terms")
    sizes = settle(group_sizes(documents, entries), "divergence-groups")
    pairs = _ranked(pair_divergence(entries, sizes)).withColumn("part", F.lit("pair"))
    found = pairs.unionByName(term_divergence(entries, sizes, top).withColumn("part", F.lit("term")))
    return found.select("lang", "source", "part", "item", "value", "rank")
