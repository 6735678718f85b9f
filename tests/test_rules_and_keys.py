import random

from conftest import one, rows
from pyspark.sql import functions as F

from grainline.operators import keys, profiling, references, scorecard
from grainline.operators.rules import Rule, evaluate, evaluate_tagged, reject_sample, rejects, tagged


def pairs(spark):
    return spark.createDataFrame([(1, 5, 3), (2, 2, 4), (3, None, 1), (4, 4, None)], "id int, a int, b int")


def test_null_policy(spark):
    a, b = F.col("a"), F.col("b")
    rules = [Rule("ignore", "x", a < b), Rule("strict", "x", ~(a >= b), "violation", on_breach="WARN")]
    got = {r.rule_id: (r.violations, r.status, r.pct) for r in evaluate(pairs(spark), rules).collect()}
    assert got == {"ignore": (1, "FAIL", 25.0), "strict": (3, "WARN", 75.0)}


def test_limits(spark):
    low = F.col("id") == 1
    rules = [
        Rule("within", "x", low, limit_pct=25.0),
        Rule("above", "x", low, limit_pct=24.9),
        Rule("none", "x", F.col("id") > 9),
        Rule("gate", "x", low, limit_pct=50.0, within_limit="PASS"),
    ]
    got = {r.rule_id: r.status for r in evaluate(pairs(spark), rules).collect()}
    assert got == {"within": "WARN", "above": "FAIL", "none": "PASS", "gate": "PASS"}


def test_empty_input_passes(spark):
    got = evaluate(pairs(spark).where("false"), [Rule("r", "x", F.col("a") < 0)]).collect()[0]
    assert (got.status, got.violations, got.total, got.pct) == ("PASS", 0, 0, 0.0)


def test_rejects_and_tags_agree(spark):
    rules = [Rule("small", "x", F.col("a") < 5), Rule("missing", "x", F.col("b").isNull())]
    df = pairs(spark)
    assert rows(rejects(df, rules, ["id"])) == [("missing", 4), ("small", 2), ("small", 4)]
    assert rows(evaluate(df, rules, "t")) == rows(evaluate_tagged(tagged(df, rules), rules, "t"))
    assert [r.id for r in reject_sample(df, rules[0], ["id"], 1).collect()] == [2]


def hot(spark):
    """One key on a third of the rows, NULLs, and unique keys."""
    data = [("hot", i) for i in range(100)] + [(None, i) for i in range(50)] + [(f"k{i}", i) for i in range(150)]
    return spark.createDataFrame(data, "k string, v int")


def test_key_profile_measures(spark):
    got = one(keys.key_profile(hot(spark), ["k"]))
    assert got["total_rows"] == 300 and got["null_rows"] == 50 and got["distinct_keys"] == 151
    assert (got["surplus_rows"], got["duplicated_keys"], got["rows_in_duplicates"], got["is_key"]) == (99, 1, 100, False)
    clean = one(keys.key_profile(hot(spark).where("k <> 'hot'"), ["k"]))
    assert clean["is_key"] and clean["surplus_rows"] == 0
    empty = one(keys.key_profile(hot(spark).where("false"), ["k"]))
    assert empty["total_rows"] == 0 and empty["is_key"]


def test_duplicates(spark):
    assert rows(keys.duplicate_keys(hot(spark), ["k"])) == [("hot", 100)]
    assert keys.duplicate_rows(hot(spark), ["k"]).count() == 100
    assert rows(keys.duplicate_distribution(hot(spark), ["k"])) == [(100, 1)]


def test_null_handling_of_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1), (None, 1)], "k string, v int")
    assert one(keys.composite_distinct(df, ["k", "v"]))["distinct_rows"] == 3
    assert one(keys.rows_per_key(df, ["k"])) == {"key_count": 1, "min_rows": 2, "max_rows": 2, "avg_rows": 2.0}
    assert rows(profiling.value_counts(df, ["k"])) == [("a", 2)]
    assert rows(profiling.value_counts(df, ["k"], keep_null=True)) == [("a", 2), (None, 2)]
    assert rows(keys.distinct_per_key(df, "k", "v")) == [("a", 1)]
    assert rows(keys.candidate_keys(df, ["k", "v"])) == [("k", 4, 1, 2, 0.25), ("v", 4, 1, 1, 0.25)]
    assert one(keys.composite_nulls(df, ["k", "v"])) == {"total_rows": 4, "k_nulls": 2, "v_nulls": 1, "null_key_rows": 3}


def test_fanout_equals_the_join(spark):
    r = random.Random(3)
    a = spark.createDataFrame([(r.randint(1, 9),) for _ in range(60)], "k int")
    b = spark.createDataFrame([(r.randint(1, 12),) for _ in range(40)], "k int")
    assert one(keys.join_fanout(a, b, "k"))["joined_rows"] == a.join(b, "k").count()


def test_exactly_one_counts_keys_without_links(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id int")
    links = spark.createDataFrame([(1, "P"), (1, "S"), (2, "P"), (2, "P"), (3, "S")], "id int, f string")
    got = one(keys.exactly_one(parents, "id", links, "id", F.col("f") == "P"))
    assert got == {"keys": 4, "without": 2, "exactly_one": 1, "more_than_one": 1}
    assert one(keys.flag_coverage(links, "id", "f", ["P", "S"])) == {"all_keys": 3, "p_keys": 2, "s_keys": 2}


def test_references(spark):
    child = spark.createDataFrame([(1, 1), (2, 1), (3, 9), (4, None)], "id int, fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk int")
    strict = one(references.reference_check(child, "fk", parent, "pk", "r"))
    assert (strict["checked_rows"], strict["orphan_rows"], strict["overlap_pct"]) == (4, 2, 50.0)
    loose = one(references.reference_check(child, "fk", parent, "pk", "r", optional=True))
    assert (loose["checked_rows"], loose["orphan_rows"]) == (3, 1)
    assert rows(references.orphan_rows(child, "fk", parent, "pk")) == [(3, 9), (4, None)]
    assert rows(references.orphan_rows(child, "fk", parent, "pk", optional=True)) == [(3, 9)]
    assert rows(references.unreferenced(parent, "pk", child, "fk")) == [(2,)]
    assert rows(references.unexpected_values(child, "fk", [1])) == [(9, 1)]


def test_scorecard(spark):
    df = spark.createDataFrame(
        [("t", "a", "FK", "PASS", 0, 9, 0.0), ("t", "b", "FK", "WARN", 1, 9, 11.1)],
        "table_name string, rule_id string, category string, status string, violations bigint, total bigint, pct double",
    )
    assert one(scorecard.by_category(df)) == {"category": "FK", "pass": 1, "warn": 1, "fail": 0, "total": 2}
    assert one(scorecard.overall(df))["verdict"] == scorecard.CAUTION
    assert one(scorecard.overall(df.where("status = 'PASS'")))["verdict"] == scorecard.READY
    assert one(scorecard.overall(df.withColumn("status", F.lit("FAIL"))))["verdict"] == scorecard.NOT_READY


def test_crosstab_with_margins_drops_null_rows(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x"), ("b", None)], "r string, c string")
    got = rows(profiling.crosstab_margins(df, "r", "c", ["x", "y"], ["x", "y"]))
    assert got == [("All", 2, 1, 3), ("a", 1, 1, 2), ("b", 1, 0, 1)]


def test_samples_repeat(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    first, again = (rows(profiling.samples(df.repartition(n), ["k"], ["k"], 3)) for n in (2, 5))
    assert first == again and len(first) == 9


def test_keys_of_different_number_types_are_equal(spark):
    from decimal import Decimal

    from grainline.operators.references import reference_checks

    child = spark.createDataFrame([(1, 2.0, "a"), (2, 3.0, "b"), (None, None, None)], "i int, d double, s string")
    tens = spark.createDataFrame([(Decimal("1.00"),), (Decimal("2.50"),)], "k decimal(10,2)")
    longs = spark.createDataFrame([(2,), (4,)], "k bigint")
    names = spark.createDataFrame([("a",)], "k string")
    edges = [("i->k", "i", tens, "k", True), ("d->k", "d", longs, "k", False), ("s->k", "s", names, "k", True)]
    got = {r.reference: (r.checked_rows, r.orphan_rows) for r in reference_checks(child, edges).collect()}
    assert got == {"i->k": (2, 1), "d->k": (3, 2), "s->k": (2, 1)}


def test_repeated_rows_and_rows_per_value_as_pandas_counts_them(spark):
    import pandas as pd

    from grainline.operators import keys

    data = [(1, None), (1, None), (1, "x"), (None, "x"), (None, "x"), (None, None)]
    frame = pd.DataFrame(data, columns=["a", "b"])
    df = spark.createDataFrame(data, "a int, b string")
    found = keys.repeated_rows(df, ["a", "b"]).first()
    assert (found.total_rows, found.surplus_rows) == (6, int(frame.duplicated().sum())) and found.distinct_keys == 4
    per = keys.rows_per_value(df, "a").first()
    assert per.avg_rows == len(frame) / frame["a"].nunique()
    assert keys.rows_per_value(df.limit(0), "a").first().avg_rows is None


def test_order_rules(spark):
    from grainline import catalog
    from grainline.operators.business import order_rules
    from grainline.operators.rules import evaluate

    good = dict(
        order_qty=10, floor_price=8.0, mrp=12.0, order_price=100.0, net_line_amount=100.0, gst_rate=12.0, gst_amount=12.0, total_line_amount_incl_gst=112.0,
        batch_id="B1", delivery_qty=10, invoice_qty=10, line_status="Invoiced", order_date="2022-01-05", actual_delivery_date="2022-01-07",
        invoice_date="2022-01-08", order_year=2022,
    )
    changes = {
        None: {}, "price_bounds": dict(order_price=127.0), "tax_recomputed": dict(gst_amount=13.0, total_line_amount_incl_gst=113.0),
        "total_recomputed": dict(total_line_amount_incl_gst=120.0), "delivery_without_batch": dict(batch_id=None),
        "batch_without_delivery": dict(delivery_qty=None, invoice_qty=None), "ordered_but_delivered": dict(line_status="Ordered"),
        "delivered_without_quantity": dict(line_status="Delivered", delivery_qty=0, invoice_qty=0, batch_id=None),
        "invoiced_beyond_delivery": dict(invoice_qty=11), "delivery_before_order": dict(actual_delivery_date="2022-01-04"),
        "invoice_before_delivery": dict(invoice_date="2022-01-06"), "order_year": dict(order_year=2023),
    }
    for wanted, change in changes.items():
        row = {**good, **change}
        values = [F.lit(row.get(c.name)).cast(c.type).alias(c.name) for c in catalog.ORDERS.columns]
        found = evaluate(spark.range(1).select(*values), order_rules(), "orders").where("violations > 0").collect()
        assert [r.rule_id for r in found] == ([wanted] if wanted else []), wanted
    missing = [F.lit(None).cast(c.type).alias(c.name) for c in catalog.ORDERS.columns]
    assert evaluate(spark.range(1).select(*missing), order_rules(), "orders").where("violations > 0").count() == 0
