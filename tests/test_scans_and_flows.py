"""Running values over ranges, hierarchies of any depth, FIFO consumption, recalled units and event order."""

import random
from collections import defaultdict

import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from grainline.operators import flows, hierarchy, sequences, supply
from grainline.operators.scans import PART, in_ranges, running


def test_running_values_against_brute_force(spark):
    r = random.Random(7)
    data = [(r.choice(["hot", "hot", "hot", "a", "b", None]), n if r.random() < 0.95 else None, r.randint(-5, 5), r.choice([None, n])) for n in range(1200)]
    df = spark.createDataFrame(data, "k string, n bigint, v int, w int").repartition(3)
    got = running(in_ranges(df, ["k"], ["n"], 9), ["k"], ["n"], sums={"s": "v"}, fills={"f": "w"}, previous={"p": "w"})
    assert got.columns == ["k", "n", "v", "w", "s", "f", "p"]
    want, state = {}, defaultdict(lambda: (0, None))
    for k, n, v, w in sorted(x for x in data if x[0] is not None and x[1] is not None):
        total, last = state[k]
        want[k, n] = (total + v, last if w is None else w, last)
        state[k] = want[k, n][:2]
    assert {(x.k, x.n): (x.s, x.f, x.p) for x in got.collect()} == want


def test_a_hot_key_day_with_sparse_numbers_stays_spread(spark):
    r = random.Random(8)
    numbers = [r.randint(-(2**62), 2**62) for _ in range(4000)]
    df = spark.createDataFrame([("hot", 1, n, 1) for n in numbers] + [("cold", 1, 5, 1)], "k string, d int, n bigint, signed_units int")
    ranged = in_ranges(df, ["k"], ["d", "n"], 16)
    held = [x["count"] for x in ranged.groupBy(PART).count().collect()]
    assert len(held) == 16 and max(held) < 3 * 4001 / 16
    got = {x.n: x.balance for x in supply.running_balance(df, ["k"], "d", "n", chunk=250).where("k = 'hot'").collect()}
    assert got == {n: k + 1 for k, n in enumerate(sorted(numbers))}


def test_running_values_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, n bigint, v int")
    assert running(in_ranges(df, ["k"], ["n"]), ["k"], ["n"], sums={"s": "v"}).count() == 0


def tree(r, n):
    """Parents by node: long chains, branches, cycles of several lengths with tails, missing parents."""
    up = {k: (None if k % 50 == 0 else k - 1 if r.random() < 0.8 else r.randint(k - k % 50, k - 1)) for k in range(n)}
    for start, length in ((n, 1), (n + 10, 2), (n + 20, 7)):
        up.update({start + k: start + (k + 1) % length for k in range(length)})
    up.update({n + 100 + k: n + 20 if k == 0 else n + 99 + k for k in range(40)})
    return {**up, n + 200: -5, n + 201: n + 200}


def climb(up, node):
    seen = [node]
    while up.get(seen[-1]) is not None and up[seen[-1]] in up:
        if up[seen[-1]] in seen:
            ring = seen[seen.index(up[seen[-1]]) :]
            return "cycle" if node in ring else "circling", min(ring), None, None
        seen.append(up[seen[-1]])
    state = "below" if len(seen) > 1 else "root" if up[node] is None else "orphan"
    return state, seen[-1], len(seen) - 1, "/".join(map(str, reversed(seen)))


@pytest.mark.parametrize("seed", [1, 2])
def test_paths_against_brute_force(spark, seed):
    up = tree(random.Random(seed), 300)
    df = spark.createDataFrame([*up.items(), (None, 3), (7, 10**6)], "node bigint, parent bigint").repartition(4)
    got = {x.node: (x.state, x.root, x.depth, x.path) for x in hierarchy.paths(df, "node", "parent").collect()}
    assert got == {k: climb(up, k) for k in up}


def test_paths_without_rows_roots_or_cycles(spark):
    empty = spark.createDataFrame([], "node bigint, parent bigint")
    assert hierarchy.paths(empty, "node", "parent").count() == 0
    ring = spark.createDataFrame([(k, (k + 1) % 33) for k in range(33)], "node bigint, parent bigint")
    assert rows(hierarchy.paths(ring, "node", "parent").groupBy("root", "state").count()) == [(0, "cycle", 33)]
    named = spark.createDataFrame([("b", "a"), ("a", None)], "node string, parent string")
    assert rows(hierarchy.paths(named, "node", "parent")) == [("a", "a", 0, "a", "root"), ("b", "a", 1, "a/b", "below")]


def test_closure_and_subtrees(spark):
    df = spark.createDataFrame([(1, None, 5), (2, 1, 7), (3, 2, None), (4, 2, 1), (9, 9, 100)], "n int, p int, v int")
    got = rows(hierarchy.closure(df, "n", "p"))
    assert got == sorted([(1, 1, 0), (1, 2, 1), (1, 3, 2), (1, 4, 2), (2, 2, 0), (2, 3, 1), (2, 4, 1), (3, 3, 0), (4, 4, 0)])
    assert rows(hierarchy.subtree_totals(df, "n", "p", {"v": "v"})) == [(1, 4, 2, 13), (2, 3, 1, 8), (3, 1, 0, None), (4, 1, 0, 1)]


def consumed(supplies, uses):
    found, s, u = [], [list(x) for x in supplies], [list(x) for x in uses]
    while s or u:
        if not s or not u:
            found += [(i, None, n) for i, n in s] + [(None, i, n) for i, n in u]
            break
        n = min(s[0][1], u[0][1])
        found.append((s[0][0], u[0][0], n))
        for side in (s, u):
            side[0][1] -= n
            if not side[0][1]:
                side.pop(0)
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fifo_against_brute_force(spark, seed):
    r = random.Random(seed)
    key = lambda: r.choice(["hot"] * 6 + ["a", "b", "c"])
    supplies = [(key(), f"s{n}", r.randint(1, 9), r.choice([1, 2, 50, 1000, 0, -3, None])) for n in range(250)] + [("only supply", "x", 1, 4)]
    uses = [(key(), n, r.randint(1, 9), r.choice([1, 3, 40, 900])) for n in range(250)] + [("only use", 999, 1, 4), (None, 1000, 1, 1)]
    a = spark.createDataFrame(supplies, "k string, sid string, day int, units int")
    b = spark.createDataFrame(uses, "k string, uid bigint, day int, units int")
    got = rows(flows.fifo(a, b, ["k"], "sid", ["day"], "units", "uid", ["day"], "units", ranges=7))
    want = []
    for k in {x[0] for x in supplies + uses if x[0]}:
        one_side = lambda x: [(i, n) for _, i, n in sorted((d, i, n) for q, i, d, n in x if q == k and n and n > 0)]
        want += [(k, *x) for x in consumed(one_side(supplies), one_side(uses))]
    assert got == sorted(want, key=lambda x: tuple((v is None, str(v)) for v in x))
    assert sum(x[3] for x in got if x[1]) == sum(x[3] for x in supplies if (x[3] or 0) > 0)


def test_recalled_units_add_up_at_every_level(spark):
    r = random.Random(4)
    start = spark.createDataFrame([(1, 1000), (2, 7), (3, 50), (1, 1)], "m int, units bigint")
    made = spark.createDataFrame([(m, f"b{r.randint(1, 8)}", r.randint(0, 9)) for m in (1, 2) for _ in range(30)], "m int, b string, w int")
    sold = spark.createDataFrame([(f"b{r.randint(1, 5)}", r.randint(1, 20), r.randint(1, 5)) for _ in range(200)] + [(None, 1, 1), ("b1", None, 4)], "b string, c int, w int")
    got = flows.recall_units(start, [(made, "m", "b", "w", "batch"), (sold, "b", "c", "w", "customer")], ranges=5)
    level = {x.level: (x.units, x.stopped) for x in got.groupBy("level").agg(F.sum("units").alias("units"), F.sum("stopped").alias("stopped")).collect()}
    assert level["start"] == (1058, 50) and level["batch"][0] == 1008 and level["customer"] == (1008 - level["batch"][1], 0)
    # shares are proportional: at most one unit from the exact share
    weights = defaultdict(int)
    for m, b, w in made.collect():
        weights[m, b] += w
    shares = flows.spread(start.groupBy("m").agg(F.sum("units").alias("units")), made, ["m"], ["b"], "w").collect()
    total = {m: sum(w for (q, _), w in weights.items() if q == m) for m in (1, 2)}
    units = {1: 1001, 2: 7}
    assert len(shares) == sum(w > 0 for w in weights.values())
    assert all(abs(x.units - units[x.m] * weights[x.m, x.b] / total[x.m]) < 1 for x in shares)


def test_recalled_units_without_steps_and_beyond_64_bits(spark):
    start = spark.createDataFrame([("a", 3)], "m string, units bigint")
    assert rows(flows.recall_units(start, [])) == [("start", "a", 3, 0)]
    many = spark.createDataFrame([("a", 10**18)], "m string, units bigint")
    links = spark.createDataFrame([("a", "x", 10**17), ("a", "y", 2 * 10**17)], "m string, t string, w bigint")
    assert rows(flows.spread(many, links, ["m"], ["t"], "w")) == [("a", "x", 10**18 // 3), ("a", "y", 10**18 - 10**18 // 3)]


def test_steps_and_illegal_steps(spark):
    events = [("u", 1, "a"), ("u", 2, "b"), ("u", 3, "a"), ("v", 1, "b"), (None, 1, "a"), ("v", 2, None), ("v", 3, "b")]
    df = spark.createDataFrame(events, "line string, n int, s string")
    stepped = sequences.steps(df, "line", ["n"], "s", [], ranges=3)
    assert rows(stepped.select("line", "n", "s", "previous_n", "previous_s")) == [
        ("u", 1, "a", None, None), ("u", 2, "b", 1, "a"), ("u", 3, "a", 2, "b"), ("v", 1, "b", None, None), ("v", 3, "b", 1, "b"),
    ]
    allowed = [(None, "a"), ("a", "b"), ("a", "b")]
    assert rows(sequences.illegal_steps(stepped, allowed, "s").select("line", "n", "previous_s")) == [("u", 3, "b"), ("v", 1, None), ("v", 3, "b")]
    counts = {(x.previous_s, x.s): (x.step_count, x.legal) for x in sequences.transition_counts(stepped, allowed, "s").collect()}
    assert counts == {(None, "a"): (1, True), ("a", "b"): (1, True), ("b", "a"): (1, False), (None, "b"): (1, False), ("b", "b"): (1, False)}
    assert one(stepped.agg(F.count("*").alias("n")))["n"] == 5


def test_spread_tasks_get_a_bounded_number_of_links(spark, monkeypatch):
    monkeypatch.setattr(flows, "TASK_LINKS", 10)
    units = spark.createDataFrame([(k, 100 + k) for k in range(8)], "a int, units int")
    links = spark.createDataFrame([(k % 12, k, 1 + k % 3) for k in range(120)] + [(None, 1, 1), (1, None, 1)], "a int, b int, w int")
    parts, in_ranges = [], flows.in_ranges
    monkeypatch.setattr(flows, "in_ranges", lambda df, *a: parts.append(df.rdd.getNumPartitions()) or in_ranges(df, *a))
    got = flows.spread(units, links, ["a"], ["b"], "w").groupBy("a").agg(F.sum("units"), F.count("*"))
    assert sorted(tuple(r) for r in got.collect()) == [(k, 100 + k, 10) for k in range(8)]
    assert parts == [13]
