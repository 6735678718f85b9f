"""Substring deduplication by level-wise doubling.

Windows of a short length that only one document has cannot be part of a longer repeated one. So windows are looked up
at about half the wanted length first; where both ends of a window of twice that length are repeated, it is a candidate
at the next level, and so on up to the wanted length or until no candidate is left. At the first level only the
smallest-hashed short window of each next longer window is looked up: equal windows choose the same one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm import batches, tokens

WINDOW = 13
SHORTEST = 8


def levels(window: int) -> list[int]:
    """Lengths from the first level to ``window``; each at most twice the one before."""
    found = [window]
    while found[0] > SHORTEST:
        found.insert(0, -(-found[0] // 2))
    return found


class Scan:
    """The words of one batch and its candidate windows, level by level."""

    def __init__(self, table: pa.Table, sizes: list[int]):
        self.sizes = sizes
        self.found = tokens.Words(batches.text_of(table))
        self.hashed = self.found.hashes()
        self.ids = batches.ids_of(table)
        self.owner = self.ids[self.found.doc]

    def first(self):
        """(starts of the looked-up windows, starts of the next longer windows, place of each one's choice among the former)."""
        size = self.sizes[0]
        start, _ = self.found.windows(size, self.hashed)
        if len(self.sizes) == 1 or not len(start):
            return start, start, np.arange(len(start))
        n = len(self.hashed) - size + 1
        hashes = self._keys(np.arange(n), 0)
        longer, _ = self.found.windows(self.sizes[1], self.hashed)
        if not len(longer):
            return longer, longer, longer
        inner = np.lib.stride_tricks.sliding_window_view(hashes, self.sizes[1] - size + 1)
        choice = longer + inner[longer].argmin(axis=1)
        anchors, place = np.unique(choice, return_inverse=True)
        return anchors, longer, place

    def _keys(self, starts, level):
        """Key of the window of a level at each start."""
        size = self.sizes[level]
        total = np.zeros(len(starts), np.uint64)
        for k in range(size):
            total *= tokens.BASE
            total += self.hashed[starts + k]
        return tokens.mix(total + np.uint64(level))

    def candidates(self, known: list[np.ndarray]):
        """(level, starts, key, answer place) after as many levels as there are answers; the answers cut the candidates."""
        starts, longer, place = self.first()
        for level in range(len(known) + 1):
            keys = self._keys(starts, level)
            distinct, at = np.unique(keys, return_inverse=True)
            if level == len(known):
                return level, starts, distinct, at
            answer = known[level]
            if level == len(self.sizes) - 1:
                return level, starts, distinct, at
            repeated = answer[at] > 1 if len(at) else np.zeros(0, bool)
            if level == 0:
                starts = longer[repeated[place]] if len(place) else longer
            else:
                step = self.sizes[level + 1] - self.sizes[level]
                alive = np.zeros(len(self.hashed) + step + 1, bool)
                alive[starts[repeated]] = True
                both, _ = self.found.windows(self.sizes[level + 1], self.hashed)
                starts = both[alive[both] & alive[both + step]]


def _question(sizes):
    def ask(table, known):
        scan = Scan(table, sizes)
        level, starts, distinct, at = scan.candidates(known)
        owner = scan.owner[starts]
        low = np.full(len(distinct), batches.NO_ID, np.int64)
        np.minimum.at(low, at, owner)
        if level == len(sizes) - 1:
            return distinct, low
        several = np.zeros(len(distinct), np.int64)
        several[at[owner != low[at]]] = 1
        return distinct, 1 + several

    return ask


def _kept(sizes):
    def run(table: pa.Table, known: list) -> pa.Table:
        scan = Scan(table, sizes)
        n = len(scan.hashed)
        covered = np.zeros(n, bool)
        if len(known) == len(sizes) and n:
            _, starts, _, at = scan.candidates(known)
            gone = starts[known[-1][at] < scan.owner[starts]] if len(at) else starts
            edges = np.zeros(n + 1, np.int64)
            np.add.at(edges, gone, 1)
            np.add.at(edges, gone + sizes[-1], -1)
            covered = np.cumsum(edges)[:-1] > 0
        words = np.array(scan.found.vocab.cast("binary").to_pylist(), object)
        texts, removed = [], []
        for i, j in zip(scan.found.starts[:-1], scan.found.starts[1:]):
            texts.append(b" ".join(words[scan.found.ids[i:j][~covered[i:j]]]) if j > i else b"")
            removed.append(int(covered[i:j].sum()))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(scan.found.counts),
                "n_removed": pa.array(removed, "int64"),
                "kept_text": pa.array(texts, "binary").cast("string"),
            }
        )

    return run


def remove_repeats(documents: DataFrame, window: int = WINDOW, batch_bytes: int = batches.BATCH_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text per row: words under a window that also starts in a document of smaller id go.

    Words are runs of characters other than white space, unchanged; kept words are joined by one space. Windows are
    judged on the input. NULL, empty and shorter texts lose nothing. Rows that repeat an id are one document: nothing is
    removed between them. Rows without an id come after all ids, and nothing is removed between them. An empty table
    gives no rows; only doc_id and text (an integer and a string) are read.
    """
    sizes = levels(window)
    table = batches.Batches(documents, 0.05, batch_bytes)
    answers = None
    for level in range(len(sizes)):
        combine = "min" if level == len(sizes) - 1 else "sum"
        got = table.ask(_question(sizes), combine, answers, "repeats").withColumn("level", F.lit(level))
        if got.isEmpty():
            break
        answers = got if answers is None else answers.unionByName(got)
    return table.over(_kept(sizes), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string", answers)
