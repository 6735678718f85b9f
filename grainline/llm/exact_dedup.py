"""Exact deduplication by composable polynomial fingerprints, confirmed by chunkwise comparison.

A fingerprint is the value of the normalised UTF-8 bytes as a polynomial modulo two primes, with the length. The
fingerprint of a concatenation follows from those of its parts: (h, s) + (g, t) = (h * t + g, s * t), where s is the
base to the power of the length. Long texts are cut into pieces that different tasks hash; each text or piece is hashed
as a matrix of chunks and folded by the same rule. Texts with equal fingerprints are then compared chunk by chunk with
the row that stays; rows that differ form further rounds until none does.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm.common import SPACE_CLASS, fresh, named, same_text, settle, text_key, whole

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 29_996_224)
CHUNK = 4096
PIECE = 65_536
PRINT = ["h1", "h2", "n_bytes"]
ROW = ["doc_id", "text_key"]


def _hasher(primes):
    """A function of bytes to ((hash, shift) per prime), made here so that it travels by value."""
    lanes = []
    for base, prime in zip(BASES, primes):
        powers = [1]
        for _ in range(CHUNK):
            powers.append(powers[-1] * base % prime)
        lanes.append((prime, np.array(powers[CHUNK - 1 :: -1], np.int64), powers))

    def run(data):
        values = np.frombuffer(data, np.uint8).astype(np.int64)
        full = len(values) // CHUNK
        out = []
        for prime, weights, powers in lanes:
            h, shift = 0, 1
            for chunk in (values[: full * CHUNK].reshape(full, CHUNK) @ weights % prime).tolist():
                h, shift = (h * powers[CHUNK] + chunk) % prime, shift * powers[CHUNK] % prime
            rest = values[full * CHUNK :]
            if len(rest):
                part = int(rest @ weights[CHUNK - len(rest) :]) % prime
                h, shift = (h * powers[len(rest)] + part) % prime, shift * powers[len(rest)] % prime
            out += [h, shift]
        return out

    return run


def _digests(primes):
    spaces = b" \t\n\x0b\x0c\r"
    fingerprint = _hasher(primes)
    names = ["doc_id", "text_key", "n_chars", "h1", "h2", "n_bytes", "text_sha256"]

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column("text").cast("binary").to_pylist():
                data = data.translate(None, spaces)
                h1, _, h2, _ = fingerprint(data)
                rows.append((h1, h2, len(data), hashlib.sha256(data).hexdigest()))
            h1, h2, size, sha = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pc.cast(pc.utf8_length(batch.column("text")), "int64"),
                    pa.array(h1, "int64"),
                    pa.array(h2, "int64"),
                    pa.array(size, "int64"),
                    pa.array(sha, "string"),
                ],
                names,
            )

    return run


def _piece_hashes(primes):
    fingerprint = _hasher(primes)

    def run(batches):
        for batch in batches:
            values = [fingerprint(d) for d in batch.column("part").cast("binary").to_pylist()]
            columns = list(zip(*values)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("doc_id", "text_key", "piece")), *(pa.array(c, "int64") for c in columns)],
                ["doc_id", "text_key", "piece", "h1", "s1", "h2", "s2"],
            )

    return run


def _pieces(text, size):
    """Array of consecutive parts of ``size`` code points; one empty part for an empty text."""
    last = F.greatest(F.lit(0), F.floor((F.length(text) - 1) / size)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i * size + 1, F.lit(size)))


def digests(documents: DataFrame, primes=PRIMES, piece: int = PIECE) -> DataFrame:
    """doc_id, text_key, n_chars, h1, h2, n_bytes, text_sha256 per row. NULL texts count as empty."""
    rows = documents.select("doc_id", whole(F.col("text")).alias("text"), text_key(F.col("text")).alias("text_key"))
    kind = f"doc_id {dict(documents.dtypes)['doc_id']}, text_key bigint"
    short = rows.where(F.length("text") <= piece).mapInArrow(
        _digests(primes), f"{kind}, n_chars bigint, h1 bigint, h2 bigint, n_bytes bigint, text_sha256 string"
    )
    clean = F.regexp_replace("text", f"{SPACE_CLASS}+", "")
    long = rows.where(F.length("text") > piece).select(*ROW, F.length("text").cast("bigint").alias("n_chars"), clean.alias("clean"))
    facts = long.select(
        *ROW, "n_chars", F.octet_length("clean").cast("bigint").alias("n_bytes"), F.sha2("clean", 256).alias("text_sha256")
    )
    parts = (
        long.dropDuplicates(ROW)
        .select(*ROW, F.posexplode(_pieces(F.col("clean"), piece)).alias("piece", "part"))
        .repartition(*ROW, "piece")
        .mapInArrow(_piece_hashes(primes), f"{kind}, piece int, h1 bigint, s1 bigint, h2 bigint, s2 bigint")
    )

    def fold(lane, prime):
        step = lambda h, p: (h * p[f"s{lane}"] + p[f"h{lane}"]) % F.lit(prime)
        return F.aggregate("parts", F.lit(0).cast("bigint"), step).alias(f"h{lane}")

    joined = (
        parts.groupBy(*ROW)
        .agg(F.array_sort(F.collect_list(F.struct("piece", "h1", "s1", "h2", "s2"))).alias("parts"))
        .select(*ROW, fold(1, primes[0]), fold(2, primes[1]))
    )
    same = facts["doc_id"].eqNullSafe(joined["doc_id"]) & (facts["text_key"] == joined["text_key"])
    long = facts.join(joined, same).select(
        facts["doc_id"], facts["text_key"], "n_chars", "h1", "h2", "n_bytes", "text_sha256"
    )
    return short.unionByName(long)


def _leaders(rows: DataFrame) -> DataFrame:
    """Per class with more than one row: its size and the row that stays."""
    order = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    groups = rows.groupBy(*PRINT, "round").agg(F.count("*").alias("group_size"), F.min(order).alias("first"))
    return groups.where("group_size > 1").select(
        *PRINT, "round", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.text_key").alias("keep_key")
    )


def _same_row(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def _differing(documents: DataFrame, rows: DataFrame, leaders: DataFrame, piece: int) -> DataFrame:
    """Rows whose text is not, chunk by chunk, that of the leader of their class."""
    mine = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_key") == F.col("keep_key"))
    members = rows.join(leaders, [*PRINT, "round"]).select(*ROW, *PRINT, "round", mine.alias("leads")).distinct()
    texts = documents.select("doc_id", whole(F.col("text")).alias("text"), text_key(F.col("text")).alias("text_key"))
    clean = F.regexp_replace("text", f"{SPACE_CLASS}+", "")
    pieces = settle(
        members.join(texts, _same_row(members, texts))
        .select(members["doc_id"], members["text_key"], *PRINT, "round", "leads", F.posexplode(_pieces(clean, piece)).alias("piece", "part")),
        "exact-pieces",
    )
    first = pieces.where("leads").select(*PRINT, "round", "piece", F.col("part").alias("lead_part")).dropDuplicates([*PRINT, "round", "piece"])
    compared = pieces.where("not leads").join(first, [*PRINT, "round", "piece"], "left")
    return compared.where("lead_part is null or part <> lead_part").select(*ROW).distinct()


def classes(documents: DataFrame, primes=PRIMES, piece: int = PIECE) -> DataFrame:
    """One row per input row: doc_id, text_key, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when identical without the characters space and 9 to 13; NULL counts as empty. Of equal texts the
    row with the most code points stays, then the smallest doc_id (NULL last), then the smallest hash of the text.
    Rows that repeat a doc_id with the same text are one document: they count in group_size and are kept or dropped
    together. An empty table gives no rows; other columns are not looked at.
    """
    assigned = settle(digests(documents, primes, piece).withColumn("round", F.lit(0)), "exact-digests")
    pending = assigned
    while True:
        leaders = settle(_leaders(pending), "exact-leaders")
        differing = settle(_differing(documents, pending, leaders, piece), "exact-differing")
        if differing.isEmpty():
            break
        marked = differing.withColumn("again", F.lit(1))
        moved = assigned.join(marked, _same_row(assigned, marked), "left").select(
            *(assigned[c] for c in assigned.columns if c != "round"), (assigned["round"] + F.coalesce("again", F.lit(0))).alias("round")
        )
        assigned = settle(moved, "exact-digests")
        pending = assigned.join(differing, _same_row(assigned, differing), "left_semi")
    leaders = settle(_leaders(assigned), "exact-leaders")
    joined = assigned.join(leaders, [*PRINT, "round"], "left")
    alone = F.col("group_size").isNull()
    mine = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_key") == F.col("keep_key"))
    return joined.select(
        *ROW,
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(alone | mine, F.lit(False)).alias("kept"),
        "text_sha256",
        "n_chars",
    )


def deduplicate(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, each once."""
    found = settle(classes(documents), "exact-classes")
    kept = found.where("kept").groupBy(*ROW).agg(F.count("*").alias("copies"))
    stay = named(kept)
    rows = documents.join(stay, same_text(documents, stay), "left_semi")
    repeated = named(kept.where("copies > 1"))
    if repeated.isEmpty():
        return rows
    key = fresh(documents, "__text_key")
    again = rows.join(repeated, same_text(rows, repeated), "left_semi").withColumn(key, text_key(F.col("text")))
    once = rows.join(repeated, same_text(rows, repeated), "left_anti")
    return once.unionByName(again.dropDuplicates(["doc_id", key]).drop(key))
