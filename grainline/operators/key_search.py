"""Search for composite keys: all minimal sets of columns that no two rows share."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.operators.keys import any_null, duplicate_keys
from grainline.session import settle

# Sketches of one scan.
SETS_PER_SCAN = 64
LG_K = 14
# Four standard errors of a sketch: a set that is a key falls short of this by chance once in 30,000.
SLACK = 4 * 1.04 / 2 ** (LG_K / 2)
# A set is looked through in one of so many slices first: a repeated value there tells that it is no key.
SLICES = 64


def _distinct(df: DataFrame, sets: list[tuple[str, ...]]) -> list[float]:
    """Estimated distinct rows of each set of columns. One scan serves many sets and leaves one row."""
    found = []
    for k in range(0, len(sets), SETS_PER_SCAN):
        some = sets[k : k + SETS_PER_SCAN]
        row = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*s), F.lit(LG_K))).alias(f"s{n}") for n, s in enumerate(some)]).first()
        found += [float(v or 0) for v in row]
    return found


def _unique(rows: DataFrame, columns: list[str]) -> bool:
    """Whether no two rows share the columns, which have no NULL. Only rows with equal hashes may, and only these are compared."""
    hashed = rows.withColumn("_hash", F.xxhash64(*columns))
    twice = settle(duplicate_keys(hashed.select("_hash"), ["_hash"]).select("_hash"), "hashes")
    return twice.isEmpty() or duplicate_keys(hashed.join(twice, "_hash", "left_semi"), columns).isEmpty()


def _confirmed(df: DataFrame, columns: list[str]) -> bool:
    """Whether no two rows share the columns: a slice of their hashes first, then all other rows."""
    rows, slice_ = df.select(*columns), F.pmod(F.xxhash64(*columns), F.lit(SLICES))
    return _unique(rows.where(slice_ == 0), columns) and _unique(rows.where(slice_ != 0), columns)


def minimal_keys(df: DataFrame, columns: list[str], most: int = 3) -> DataFrame:
    """(key_columns, size): every set of at most ``most`` columns that is a key while no part of it is.

    A key has no NULL and no value twice. Sets are searched by size: what holds a key already is left out, as is what
    cannot have enough distinct rows by the estimates of its parts. Sketches, many to a scan, leave the sets that may be
    keys, and each of these is confirmed by an exact count, which ends early at a repeated value in a slice of the rows. An
    empty table has no key. Only sets of column names, bounded
    by the arguments, are held by the driver.
    """
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    rows, usable = counts["_rows"], [c for c in columns if not counts[c]]
    keys: list[tuple[str, ...]] = []
    estimate: dict[tuple[str, ...], float] = {}
    for size in range(1, most + 1 if rows else 1):
        open_sets = []
        for s in combinations(usable, size):
            if any(set(k) <= set(s) for k in keys):
                continue
            # a set has at most as many distinct rows as the product of two parts of it
            parts = [(estimate.get(tuple(c for c in s if c != x)), estimate.get((x,))) for x in s] if size > 1 else []
            if all(a is None or b is None or a * b * (1 + SLACK) ** 2 >= rows for a, b in parts):
                open_sets.append(s)
        found = dict(zip(open_sets, _distinct(df, open_sets)))
        estimate |= found
        keys += [s for s, n in found.items() if n >= rows * (1 - SLACK) and _confirmed(df, list(s))]
    return df.sparkSession.createDataFrame([("+".join(k), len(k)) for k in keys], "key_columns string, size int")


def is_key(df: DataFrame, columns: list[str]) -> bool:
    """Whether no row has a NULL in the columns and no two rows share them."""
    return df.where(any_null(columns)).isEmpty() and duplicate_keys(df, columns).isEmpty()
