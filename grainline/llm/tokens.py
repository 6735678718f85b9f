"""Vectorised words and window hashes of one Arrow batch. Runs inside tasks; plain numpy and pyarrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 4 << 20


def slices(batch, column="text", limit=SLICE_BYTES):
    """Parts of a batch with about ``limit`` bytes of text each; a longer single text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield batch.slice(start)


class Words:
    """The words of several texts: ids into ``vocab`` in one flat array, bounded by ``starts``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts, "")
        if lower:
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
        flat = lists.flatten()
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        blank = np.flatnonzero((counts == 1) & ~empty)
        first = np.concatenate(([0], np.cumsum(counts)))
        if len(blank):
            blank = blank[pc.equal(flat.take(pa.array(first[blank])), "").to_numpy(zero_copy_only=False)]
        gone = np.union1d(np.flatnonzero(empty & (counts == 1)), blank).astype(np.int64)
        if len(gone):
            keep = np.ones(len(flat), bool)
            keep[first[gone]] = False
            flat = flat.filter(pa.array(keep))
            counts[gone] = 0
        coded = flat.dictionary_encode()
        self.vocab = coded.dictionary
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.counts = counts
        self.starts = np.concatenate(([0], np.cumsum(counts)))
        self.doc = np.repeat(np.arange(len(counts)), counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash per word position."""
        table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.vocab.cast("binary").to_pylist()), np.uint64, len(self.vocab))
        return table[self.ids] if len(table) else np.zeros(0, np.uint64)

    def windows(self, size: int, hashes: np.ndarray | None = None):
        """(start position, raw hash) of each run of ``size`` words within one text."""
        return windows(self.hashes() if hashes is None else hashes, self.doc, size)


def windows(hashes: np.ndarray, doc: np.ndarray, size: int):
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, size):
        total *= BASE
        total += hashes[k : k + n]
    start = np.flatnonzero(doc[:n] == doc[size - 1 :])
    return start, total[start]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
