"""Composite keys, mergeable profiles and drift."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_curate import batch, run

from grainline import catalog
from grainline.operators import sketches
from grainline.operators.drift import drift
from grainline.operators import key_search
from grainline.operators.key_search import is_key, minimal_keys
from grainline.plans.curate import publication_drift


def brute_keys(data, names, most):
    found = []
    for size in range(1, most + 1):
        for s in combinations(range(len(names)), size):
            values = [tuple(r[k] for k in s) for r in data]
            if not any(set(k) <= set(s) for k in found) and all(None not in v for v in values) and len(set(values)) == len(values):
                found.append(s)
    return sorted("+".join(names[k] for k in s) for s in found)


@pytest.mark.parametrize("seed", range(4))
def test_minimal_keys_against_brute_force(spark, seed):
    r = random.Random(seed)
    names = ["a", "b", "c", "d", "e"]
    data = [(r.randint(0, 9), r.randint(0, 9), n % 12, n // 12, n if n or seed % 2 else None) for n in range(60)]
    df = spark.createDataFrame(data, "a int, b int, c int, d int, e int")
    assert sorted(x.key_columns for x in minimal_keys(df, names, 3).collect()) == brute_keys(data, names, 3)


def test_keys_of_odd_tables(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x")], "a int, b string")
    assert minimal_keys(df, ["a", "b"]).count() == 0 and minimal_keys(df.limit(0), ["a", "b"]).count() == 0
    assert rows(minimal_keys(df.limit(1), ["a", "b"])) == [("a", 1), ("b", 1)]
    assert is_key(df.limit(1), ["a"]) and not is_key(df, ["a", "b"]) and not is_key(df.withColumn("n", F.lit(None)), ["n"])


def test_merged_profiles_equal_the_profile_of_all(spark, tmp_path):
    r = np.random.default_rng(3)
    n = 60_000
    values = np.concatenate((r.normal(0, 1000, n // 2), r.integers(0, 50, n // 2)))
    df = spark.createDataFrame([(int(k % 4), float(v), f"t{k % 7000}" if k % 10 else None) for k, v in enumerate(values)], "year int, v double, t string")
    path = str(tmp_path / "profiles")
    for year in range(4):
        sketches.profile(df.where(F.col("year") == year), ["year"], ["v", "t"]).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    probabilities = (0.05, 0.25, 0.5, 0.75, 0.95)
    got = {x.column_name: x for x in sketches.estimates(sketches.merged(stored, []), probabilities).collect()}
    whole = {x.column_name: x for x in sketches.estimates(sketches.profile(df, [], ["v", "t"]), probabilities).collect()}
    for c in ("v", "t"):
        assert got[c][:5] == whole[c][:5] and got[c].row_count == n
    assert got["t"].null_count == n // 10 and got["t"].min is None and got["t"].q50 is None
    assert (got["v"].min, got["v"].max) == (values.min(), values.max())
    ordered = np.sort(values)
    for p in probabilities:
        low, high = np.searchsorted(ordered, got["v"][f"q{round(p * 100)}"], "left"), np.searchsorted(ordered, got["v"][f"q{round(p * 100)}"], "right")
        assert low / n - sketches.RANK_ERROR <= p <= high / n + sketches.RANK_ERROR
    for c, exact in (("v", len(set(values))), ("t", df.select("t").where("t is not null").distinct().count())):
        assert abs(got[c].distinct_values - exact) <= exact * sketches.DISTINCT_ERROR
    two = sketches.merged(stored.withColumn("half", F.col("year") < 2), ["half"])
    assert rows(two.where("column_name = 'v'").select("half", "row_count")) == [(False, n // 2), (True, n // 2)]


def test_drift_against_brute_force(spark):
    r = random.Random(5)
    make = lambda n, weights: [("p%d" % r.choice([1, 2]), r.choices(["x", "y", None], weights)[0]) for _ in range(n)]
    old, new = make(400, [5, 3, 1]) + [("gone", "x")] * 4 + [(None, "x")] * 10, make(390, [1, 3, 5]) + [("fresh", "x")] * 3 + [(None, "x")] * 5
    frame = lambda data: spark.createDataFrame(data, "part string, v string")
    got = {x.part: x for x in drift(frame(old), frame(new), ["part"], ["v"]).collect()}
    for part in {p for p, _ in old + new}:
        a, b = Counter(v for p, v in old if p == part), Counter(v for p, v in new if p == part)
        na, nb = sum(a.values()), sum(b.values())
        assert (got[part].rows_before, got[part].rows_after) == (na, nb)
        if na and nb:
            assert got[part].distance == pytest.approx(sum(abs(a[v] / na - b[v] / nb) for v in a | b) / 2, abs=1e-6)
    assert got["gone"].status == "MISSING" and got["fresh"].status == "NEW" and got[None].status == "COUNT DRIFT"
    assert got["p1"].status == "VALUE DRIFT" and got["gone"].distance is None
    assert drift(frame([]), frame([]), ["part"], ["v"]).count() == 0
    same = drift(frame(old), frame(old), ["part"], ["v"]).select("status", "distance").distinct()
    assert rows(same) == [("STABLE", 0.0)]


def test_a_halved_partition_is_named(spark, tmp_path):
    year = lambda n, y: batch(n, mfg_date=f"{y}-02-01", year=str(y), batch_size_units=str(n % 3 + 1))
    records = [year(n, 2022 + n % 2) for n in range(40)]
    run(spark, tmp_path, records, "one")
    _, target = run(spark, tmp_path, [x for n, x in enumerate(records) if x["year"] == "2022" or n < 20], "two")
    found = publication_drift(spark, target, catalog.PRODUCT_BATCHES, "two", ["manufacturer_id"])
    assert rows(found.select("year", "rows_before", "rows_after", "status")) == [("2022", 20, 20, "STABLE"), ("2023", 20, 10, "COUNT DRIFT")]
    first = publication_drift(spark, target, catalog.PRODUCT_BATCHES, "one", ["manufacturer_id"])
    assert rows(first.select("status").distinct()) == [("NEW",)]
    with pytest.raises(ValueError):
        publication_drift(spark, target, catalog.PRODUCT_BATCHES, "never", ["manufacturer_id"])


def test_near_keys_are_refuted_in_a_slice(spark, monkeypatch):
    """Few rows are looked at where some values come twice; a key is looked through whole."""
    n, seen = 20_000, []
    df = spark.range(n).select("id", F.when(F.col("id") < n - 300, F.col("id")).otherwise(F.col("id") - 300).alias("near"), F.lit(1).alias("one"))
    unique = key_search._unique
    monkeypatch.setattr(key_search, "_unique", lambda rows, columns: seen.append((columns, rows.count())) or unique(rows, columns))
    assert rows(minimal_keys(df, ["id", "near", "one"], 2)) == [("id", 1)]
    looked = lambda c: sum(k for columns, k in seen if columns == c)
    assert looked(["id"]) == n and 0 < looked(["near"]) < n / 10
    one_twice = spark.range(n).union(spark.range(7777, 7778))
    assert not key_search._confirmed(one_twice, ["id"]) and key_search._confirmed(spark.range(n), ["id"])
