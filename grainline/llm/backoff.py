"""Language-model scoring by stupid backoff over n-gram counts of all documents.

Each batch of documents counts its n-grams; count tables partitioned by hash add these up over all documents and answer
the batches, which sum the scores of their n-grams per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm import batches, tokens

ORDER = 2
ALPHA = 0.4
LEAST_COUNT = 2


def _grams(found, order):
    """Per n: (start positions, keys) of the n-grams of a batch."""
    hashed = found.hashes()
    out = []
    for n in range(1, order + 1):
        start, total = found.windows(n, hashed)
        out.append((start, tokens.mix(total + np.uint64(n))))
    return out


def _all_keys(found, order):
    """Sorted distinct keys of all orders and of the corpus size, their counts, and the place of each n-gram among them."""
    grams = _grams(found, order)
    size = tokens.mix(np.zeros(1, np.uint64))
    keys, at, n = np.unique(np.concatenate([size, *(k for _, k in grams)]), return_inverse=True, return_counts=True)
    n = n.astype(np.int64)
    n[at[0]] = len(found.ids)
    places, used = [], 1
    for start, k in grams:
        places.append((start, at[used : used + len(k)]))
        used += len(k)
    return keys, n, at[0], places


def _question(order):
    def ask(table, known):
        keys, n, _, _ = _all_keys(tokens.Words(batches.text_of(table)), order)
        return keys, n

    return ask


def _scores(order, alpha, least):
    def run(table: pa.Table, known: list) -> pa.Table:
        found = tokens.Words(batches.text_of(table))
        _, _, size, places = _all_keys(found, order)
        total, n = known[0], len(found.ids)
        # counts[k][i]: of the (k + 1)-gram that starts at word i; 0 where the text ends before
        counts = np.zeros((order, n), np.int64)
        for k, (start, at) in enumerate(places):
            counts[k, start] = total[at]
        inside = np.arange(n) - found.starts[:-1][found.doc] if n else np.zeros(0, np.int64)
        score = np.log(counts[0] / max(int(total[size]), 1)) if n else np.zeros(0)
        score = score + (np.minimum(inside, order - 1)) * np.log(alpha)
        for k in range(1, order):
            i = np.flatnonzero(inside >= k)
            gram, context = counts[k, i - k], counts[k - 1, i - k]
            hit = gram >= least
            i, gram, context = i[hit], gram[hit], context[hit]
            score[i] = np.log(gram / context) + (np.minimum(inside[i], order - 1) - k) * np.log(alpha)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(found.counts),
                "log_score": pa.array(np.bincount(found.doc, score, table.num_rows).astype(float)),
            }
        )

    return run


def score(documents: DataFrame, order: int = ORDER, alpha: float = ALPHA, least: int = LEAST_COUNT, batch_bytes: int = batches.BATCH_BYTES) -> DataFrame:
    """doc_id, n_words, log_score, mean_log_score per row.

    S(w | h) = c(hw) / c(h) where the n-gram hw occurs ``least`` times in the corpus or more, else ``alpha`` times the
    score after a shorter history; a single word has its share of all words. Histories stay within a text. Words are
    runs of characters other than white space, unchanged. log_score is the sum of the natural logarithms. NULL texts and
    texts without words have 0 words, 0.0 and NULL. Rows that repeat an id are texts of their own and count as often as
    they occur. An empty table gives no rows.
    """
    table = batches.Batches(documents, 0.3, batch_bytes)
    answers = table.ask(_question(order), "sum", None, "ngram-counts").withColumn("level", F.lit(0))
    found = table.over(_scores(order, alpha, least), "doc_id bigint, n_words bigint, log_score double", answers)
    return found.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
