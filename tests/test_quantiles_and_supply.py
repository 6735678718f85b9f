import random
from collections import defaultdict
from datetime import date, timedelta

import numpy as np
import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from grainline.operators import supply
from grainline.operators.quantiles import describe, exact_quantiles

CASES = {
    "small span": [random.Random(1).randint(-5, 5) for _ in range(301)],
    "wide span": [random.Random(2).randint(-(10**15), 10**15) for _ in range(200)],
    "two clusters": [random.Random(3).choice([0, 10**12]) + random.Random(i).randint(0, 3) for i in range(150)],
    "one value": [7] * 40,
    "single row": [42],
    "hot value": [1] * 100 + list(range(200)),
}


@pytest.mark.parametrize("name", CASES)
def test_quantiles_match_linear_interpolation(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint").repartition(3)
    got = {r.probability: r.value for r in exact_quantiles(df, ["v"], (0.0, 0.25, 0.5, 0.9, 1.0)).collect()}
    for p, value in got.items():
        assert value == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_of_money_and_weights(spark):
    r = random.Random(5)
    values = [round(r.uniform(-1000, 1e6), 2) for _ in range(500)]
    df = spark.createDataFrame([(v, v) for v in values], "a double, b double").select("a", F.col("b").cast("decimal(18,2)"))
    got = {(x.column_name, x.probability): x.value for x in exact_quantiles(df, ["a", "b"]).collect()}
    for p in (0.25, 0.5, 0.75):
        assert got["a", p] == pytest.approx(np.quantile(values, p)) and got["b", p] == got["a", p]
    weighted = spark.createDataFrame([(1, 3), (4, 2), (9, 5)], "v int, w bigint")
    d = one(describe(weighted, ["v"], weight="w"))
    flat = [1] * 3 + [4] * 2 + [9] * 5
    assert d["count"] == 10 and d["q50"] == np.median(flat) and d["q25"] == np.quantile(flat, 0.25)
    assert d["std"] == pytest.approx(np.std(flat, ddof=1), abs=1e-4)


def test_describe_has_a_row_for_every_column(spark):
    df = spark.createDataFrame([(1, None), (3, None)], "a int, b int")
    assert {r.column_name: r["count"] for r in describe(df, ["a", "b"]).collect()} == {"a": 2, "b": 0}
    got = one(describe(df.where("false"), ["a"]))
    assert got["count"] == 0 and got["mean"] is None and got["q50"] is None


def test_describe_keeps_small_and_large_values(spark):
    df = spark.createDataFrame([(0.0011, 1e18, 5.0), (0.0012, 2e18, float("nan")), (0.0049, -3e18, None)], "a double, b double, c double")
    got = {r.column_name: r for r in describe(df, ["a", "b", "c"], digits=None).collect()}
    assert got["a"].q50 == 0.0012 and got["a"].min == 0.0011 and got["a"].std == pytest.approx(np.std([0.0011, 0.0012, 0.0049], ddof=1))
    assert got["b"].max == 2e18 and got["b"].q25 == pytest.approx(np.quantile([1e18, 2e18, -3e18], 0.25))
    assert (got["c"]["count"], got["c"].mean, got["c"].std) == (1, 5.0, None)


def test_running_balance_against_brute_force(spark):
    r = random.Random(11)
    start, data = date(2022, 1, 1), []
    for n in range(1500):
        key = "hot" if r.random() < 0.5 else f"k{r.randint(1, 5)}"
        data.append((key, start + timedelta(days=r.randint(0, 6)), n, r.randint(-9, 9)))
    df = spark.createDataFrame(data, "k string, d date, n bigint, signed_units int").repartition(5)
    # chunks of 7 numbers: a day of the hot key spans many of them
    got = {(x.k, x.n): x.balance for x in supply.running_balance(df, ["k"], "d", "n", chunk=7).collect()}
    total = defaultdict(int)
    expected = {}
    for k, d, n, units in sorted(data, key=lambda x: (x[0], x[1], x[2])):
        total[k] += units
        expected[k, n] = total[k]
    assert got == expected


def test_ledger_entries_balance_to_zero_for_transfers(spark):
    moves = spark.createDataFrame([(1, None, 10, 5), (2, 10, 20, 3)], "m int, from_plant_id int, to_plant_id int, units int")
    entries = supply.ledger_entries(moves, ["m"])
    assert rows(entries.groupBy("plant_id").agg(F.sum("signed_units"))) == [(10, 2), (20, 3)]


def test_trace_reduces_each_level(spark):
    start = spark.createDataFrame([("m1",)], "m string")
    made = spark.createDataFrame([("m1", "b1"), ("m1", "b2"), ("m2", "b3")], "m string, b string")
    moved = spark.createDataFrame([("b1", "p1")] * 50 + [("b2", "p1"), ("b3", "p9")], "b string, p string")
    got = rows(supply.trace(start, [(made, "m", "b", "batch"), (moved, "b", "p", "plant")]))
    assert got == [("batch", "b1"), ("batch", "b2"), ("plant", "p1")]


def test_plan_against_actual_keeps_both_sides(spark):
    plan = spark.createDataFrame([("a", 5), ("a", 5), ("b", 1)], "k string, u int")
    done = spark.createDataFrame([("a", 7), ("c", 2)], "k string, u int")
    assert rows(supply.plan_against_actual(plan, "u", done, "u", ["k"])) == [("a", 10, 7, -3), ("b", 1, 0, -1), ("c", 0, 2, 2)]


def test_lifecycle_repeats_and_gaps(spark):
    d = date(2022, 1, 1)
    events = spark.createDataFrame(
        [("l1", "Ordered", d), ("l1", "Delivered", d + timedelta(4)), ("l1", "Delivered", d + timedelta(2)), ("l2", "Ordered", d)],
        "line string, s string, day date",
    )
    got = {r.line: r for r in supply.lifecycle(events, "line", "s", "day", ["Ordered", "Delivered", "Invoiced"]).collect()}
    assert got["l1"].Ordered_to_Delivered_days == 2 and got["l1"].event_count == 3
    assert got["l2"].Ordered_to_Delivered_days is None and got["l1"].first_Invoiced is None


def test_status_totals_ignore_other_stages(spark):
    lines = spark.createDataFrame([("p", "Ordered", 5, 0), ("p", "Delivered", 5, 4)], "p string, s string, o int, d int")
    got = one(supply.status_totals(lines, "s", {"ordered": ("Ordered", "o"), "delivered": ("Delivered", "d")}, ["p"]))
    assert got == {"p": "p", "ordered": 5, "delivered": 4}


def test_headers(spark):
    lines = spark.createDataFrame([("a", 1, None), ("a", 1, 2), ("b", 1, 1), ("b", 2, 1)], "h string, x int, y int")
    assert rows(supply.inconsistent_headers(lines, "h", ["x", "y"])) == [("b", True, False)]
    assert rows(supply.single_source(lines, "h", "x")) == [("a", 1, 2)]


def test_hierarchy_keeps_roots(spark):
    plants = spark.createDataFrame([("c", None, "Central"), ("r", "c", "Regional")], "code string, up string, kind string")
    got = rows(supply.hierarchy(plants, "code", "up", plants, "code", ["kind"]))
    assert got == [("c", None, None), ("r", "c", "Central")]


def test_exact_describe_keeps_whole_numbers_and_decimals(spark):
    from decimal import Decimal

    big = 9007199254740993
    df = spark.createDataFrame([(big, Decimal("0.01")), (big + 2, Decimal("0.02")), (big + 4, None)], "a bigint, b decimal(10,2)")
    got = {r.column_name: r for r in describe(df, ["a", "b"], exact=True).collect()}
    assert [int(got["a"][c]) for c in ("min", "q50", "max")] == [big, big + 2, big + 4]
    assert got["a"].q25 == big + 1 and got["b"].q50 == Decimal("0.015") and got["b"]["count"] == 2
    assert int(describe(df, ["a"]).first()["min"]) != big
    with pytest.raises(TypeError):
        describe(df.withColumn("c", F.lit(1.5)), ["a", "c"], exact=True)
    assert describe(df.limit(0), ["a"], exact=True).first()["count"] == 0


def test_header_rollup_expands_no_line(spark):
    lines = spark.createDataFrame([("a", 1, None, 2), ("a", 1, None, 3), ("a", 2, None, None), ("b", None, "x", 1), (None, 1, "x", 1)], "h string, p int, s string, q int")
    got = supply.header_rollup(lines, "h", {"products": "p", "sources": "s"}, {"total": "q"})
    assert got.columns == ["h", "line_count", "products", "sources", "total"]
    assert sorted(tuple(r) for r in got.collect()) == [("a", 3, 2, 0, 5), ("b", 1, 0, 1, 1)]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
