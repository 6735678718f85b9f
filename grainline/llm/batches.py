"""Documents in batches that ask counting questions about keys.

The documents are written once, bucketed by a hash of their ids, so that every later pass over a batch needs no shuffle
of texts. A batch sends each of its distinct keys once, with a value; keys are 64-bit hashes cut into buckets of the
hash space. A bucket combines the values per key over all batches and answers each batch in the order it asked. A key
that occurs in a third of all documents is thus one entry per batch.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm.common import settle, text_key, whole
from grainline.session import scratch

BATCH_BYTES = 8 << 20
BUCKET_KEYS = 1_000_000
# Stands for a missing id: larger than any.
NO_ID = (1 << 63) - 1


def planes(values: np.ndarray) -> bytes:
    """64-bit values with their bytes transposed, which leaves runs that a codec removes."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).reshape(-1).view(kind)


class Batches:
    """The documents (doc_id, text) with their batch, and the number of key buckets for about ``keys_per_byte`` keys."""

    def __init__(self, documents: DataFrame, keys_per_byte: float, batch_bytes: int = BATCH_BYTES):
        spark = documents.sparkSession
        rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("text"))
        total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        # a table has at most this many buckets; on very large inputs raise the setting, else batches grow
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
        n = min(most, total // batch_bytes + 1)
        self.buckets = max(16, int(total * keys_per_byte / BUCKET_KEYS))
        name = f"batches_{uuid.uuid4().hex}"
        batch = F.pmod(F.xxhash64("doc_id", text_key(F.col("text"))), F.lit(n)).cast("int")
        (
            rows.withColumn("batch", batch)
            .repartition(n, "batch")
            .write.bucketBy(n, "batch")
            .option("path", scratch(spark, "batches"))
            .option("compression", "zstd")
            .format("parquet")
            .saveAsTable(name)
        )
        # the frame holds the files and their buckets; the name of the external table is not needed any more
        self.rows = spark.table(name)
        spark.sql(f"DROP TABLE {name}")

    def ask(self, question, combine: str, answers: DataFrame | None, label: str) -> DataFrame:
        """Answers (level, batch, bucket, answer) to the keys and values that ``question`` makes of each batch."""
        schema = "bucket int, batch int, keys binary, values binary"
        asked = self.over(_packed(question, self.buckets), schema, answers)
        got = asked.groupBy("bucket").applyInArrow(_combined(combine), "bucket int, batch int, answer binary")
        return settle(got, label)

    def over(self, run, schema: str, answers: DataFrame | None) -> DataFrame:
        """``run(batch table, answers per level)`` on every batch."""
        if answers is None:
            return self.rows.groupBy("batch").applyInArrow(_alone(run), schema)
        return self.rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_with_answers(run), schema)


def _alone(run):
    return lambda table: run(table, [])


def _with_answers(run):
    def both(table: pa.Table, answers: pa.Table) -> pa.Table:
        levels: dict[int, list] = {}
        for level, bucket, data in zip(*(answers.column(c).to_pylist() for c in ("level", "bucket", "answer"))):
            levels.setdefault(level, []).append((bucket, data))
        empty = np.zeros(0, np.int64)
        known = [
            np.concatenate([unplanes(d, np.int64) for _, d in sorted(levels.get(k, []), key=lambda x: x[0])] or [empty])
            for k in range(max(levels, default=-1) + 1)
        ]
        return run(table, known)

    return both


def _packed(question, buckets):
    def run(table: pa.Table, known: list) -> pa.Table:
        batch = table.column("batch")[0].as_py() if table.num_rows else 0
        keys, values = question(table, known) if table.num_rows else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else np.zeros(0, int)
        ends = [*cut[1:], len(keys)]
        return pa.table(
            {
                "bucket": pa.array(bucket[cut].astype(np.int32)),
                "batch": pa.array([batch] * len(cut), "int32"),
                "keys": pa.array([planes(keys[i:j]) for i, j in zip(cut, ends)], "binary"),
                "values": pa.array([planes(values[i:j]) for i, j in zip(cut, ends)], "binary"),
            }
        )

    return run


def _combined(combine):
    def run(table: pa.Table) -> pa.Table:
        keys = [unplanes(x, np.uint64) for x in table.column("keys").to_pylist()]
        values = np.concatenate([unplanes(x, np.int64) for x in table.column("values").to_pylist()])
        sizes = [len(k) for k in keys]
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        sorted_ = keys[order]
        first = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
        total = (np.add if combine == "sum" else np.minimum).reduceat(values[order], first)
        answer = np.empty(len(keys), np.int64)
        answer[order] = np.repeat(total, np.diff(np.append(first, len(keys))))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return pa.table(
            {
                "bucket": table.column("bucket"),
                "batch": table.column("batch"),
                "answer": pa.array([planes(answer[i:j]) for i, j in zip(ends[:-1], ends[1:])], "binary"),
            }
        )

    return run


def ids_of(table: pa.Table) -> np.ndarray:
    """The ids of a batch, NO_ID for a missing one."""
    return table.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def text_of(table: pa.Table) -> pa.Array:
    found = table.column("text").combine_chunks()
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
