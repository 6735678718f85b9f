"""Registered queries: business rules, gates and scorecards."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainline.functions.compare import close_to
from grainline.operators import business, keys, profiling, references, scorecard
from grainline.operators.rules import Rule, evaluate
from grainline.plans import inputs as i
from grainline.plans.queries_cleaning import rule_sql
from grainline.plans.registry import query
from grainline.session import load

LINES = f"WITH {i.ORDER_LINES_SQL}"
DATES = f"WITH {i.LINE_DATES_SQL}"
MOVES = f"WITH {i.MOVES_SQL}"


def waterfall_rules():
    o, d, n = F.col("order_qty"), F.col("delivery_qty"), F.col("invoice_qty")
    return [
        # the validation reads NULL as no violation, the profile reads it as one
        Rule("quantity_waterfall", "Business Logic", (o < d) | (d < n), "ignore", on_breach="WARN"),
        Rule("quantity_waterfall_strict", "Business Logic", ~((o >= d) & (d >= n)), "violation", on_breach="WARN"),
    ]


WATERFALL_SQL = [
    ("quantity_waterfall", "Business Logic", "order_qty < delivery_qty OR delivery_qty < invoice_qty", 0.0, "WARN", "WARN"),
    ("quantity_waterfall_strict", "Business Logic",
     "NOT coalesce(order_qty >= delivery_qty AND delivery_qty >= invoice_qty, false)", 0.0, "WARN", "WARN"),
]


@query("quantity_waterfall", rule_sql("order_lines", "order_lines", WATERFALL_SQL, LINES))
def quantity_waterfall(spark, folder):
    return evaluate(i.order_lines(spark, folder), waterfall_rules(), "order_lines")


def date_rules():
    o, d, n, s = F.col("order_date"), F.col("delivery_date"), F.col("invoice_date"), F.col("line_status")
    late = (d < o) | (n < d)
    return [
        Rule("date_progression", "Business Logic", late, on_breach="WARN"),
        Rule("date_progression_returns", "Business Logic", late & (s == "Returned"), on_breach="WARN"),
        Rule("delivery_before_order", "Business Logic", d < o, on_breach="WARN"),
        Rule("invoice_before_delivery", "Business Logic", n < d, on_breach="WARN"),
    ]


LATE = "delivery_date < order_date OR invoice_date < delivery_date"
DATE_SQL = [
    ("date_progression", "Business Logic", LATE, 0.0, "WARN", "WARN"),
    ("date_progression_returns", "Business Logic", f"({LATE}) AND line_status = 'Returned'", 0.0, "WARN", "WARN"),
    ("delivery_before_order", "Business Logic", "delivery_date < order_date", 0.0, "WARN", "WARN"),
    ("invoice_before_delivery", "Business Logic", "invoice_date < delivery_date", 0.0, "WARN", "WARN"),
]


@query("date_progression", rule_sql("line_dates", "line_dates", DATE_SQL, DATES))
def date_progression(spark, folder):
    return evaluate(i.line_dates(spark, folder), date_rules(), "line_dates")


@query(
    "expiry_after_mfg",
    rule_sql("line_dates", "line_dates",
             [("expiry_after_mfg", "Business Logic", "invoice_date <= delivery_date", 0.0, "WARN", "FAIL")], DATES),
)
def expiry_after_mfg(spark, folder):
    # plays: expiry date (invoice) must follow the manufacturing date (delivery)
    rule = Rule("expiry_after_mfg", "Business Logic", F.col("invoice_date") <= F.col("delivery_date"))
    return evaluate(i.line_dates(spark, folder), [rule], "line_dates")


MOVEMENT_SQL = [
    ("movement_semantics", "Business Logic",
     "(movement_type = 'IN' AND from_plant_id IS NOT NULL) OR (movement_type IN ('TRANSFER', 'Central_Movement') "
     "AND (from_plant_id IS NULL OR to_plant_id IS NULL))", 0.0, "WARN", "FAIL"),
    ("units_positive", "Business Logic", "NOT coalesce(units > 0, false)", 0.0, "WARN", "FAIL"),
]


@query("conditional_null_semantics", rule_sql("moves", "moves", MOVEMENT_SQL, MOVES))
def conditional_null_semantics(spark, folder):
    return evaluate(i.moves(spark, folder), business.movement_rules(), "moves")


def year_rules():
    same = F.col("label_year") == F.year("o_orderdate")
    return [
        Rule("year_alignment", "Cross-Year", ~same, "violation"),
        Rule("partition_year", "Partition", F.col("o_orderdate").isNotNull() & ~same, limit_pct=1.0, within_limit="PASS"),
    ]


def labelled_orders(spark, folder):
    """Orders with a year label that is late for orders of the first days of a year, and missing for some."""
    day = F.col("o_orderdate").cast("date")
    label = F.when(F.dayofyear(day) <= 3, F.year(day) - 1).when(F.col("o_orderpriority") != "5-LOW", F.year(day))
    return load(spark, folder, "orders").select("o_orderkey", day.alias("o_orderdate"), label.alias("label_year"))


LABELLED_SQL = """WITH labelled AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
  CASE WHEN dayofyear(o_orderdate) <= 3 THEN year(o_orderdate) - 1 WHEN o_orderpriority <> '5-LOW' THEN year(o_orderdate) END AS label_year
  FROM orders)"""
YEAR_SQL = [
    ("year_alignment", "Cross-Year", "label_year IS NULL OR label_year <> year(o_orderdate)", 0.0, "WARN", "FAIL"),
    ("partition_year", "Partition", "o_orderdate IS NOT NULL AND label_year <> year(o_orderdate)", 1.0, "PASS", "FAIL"),
]


@query("year_alignment", rule_sql("orders", "labelled", YEAR_SQL[:1], LABELLED_SQL))
def year_alignment(spark, folder):
    return evaluate(labelled_orders(spark, folder), year_rules()[:1], "orders")


@query("partition_year_mismatch", rule_sql("orders", "labelled", YEAR_SQL[1:], LABELLED_SQL))
def partition_year_mismatch(spark, folder):
    return evaluate(labelled_orders(spark, folder), year_rules()[1:], "orders")


@query(
    "price_bounds",
    rule_sql(
        "priced_lines", "priced",
        [("price_bounds", "Price", "NOT coalesce(order_price >= floor_price * order_qty * 0.95 AND order_price <= mrp * order_qty * 1.05, false)",
          0.0, "WARN", "WARN")],
        f"""{LINES}, priced AS (SELECT order_qty, order_price, CAST(p_retailprice * 0.9 AS DECIMAL(18,2)) AS floor_price,
        CAST(p_retailprice AS DECIMAL(18,2)) AS mrp FROM order_lines JOIN part ON p_partkey = product_id)""",
    ),
)
def price_bounds(spark, folder):
    part = load(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        (F.col("p_retailprice") * 0.9).cast("decimal(18,2)").alias("floor_price"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("mrp"),
    )
    lines = i.order_lines(spark, folder).select("product_id", "order_qty", "order_price").join(part, "product_id")
    price, q = F.col("order_price"), F.col("order_qty")
    share = lambda text: F.lit(text).cast("decimal(3,2)")
    inside = (price >= F.col("floor_price") * q * share("0.95")) & (price <= F.col("mrp") * q * share("1.05"))
    return evaluate(lines, [Rule("price_bounds", "Price", ~inside, "violation", on_breach="WARN")], "priced_lines")


def amount_rules():
    expected_tax = F.col("net_amount").cast("double") * (F.col("gst_rate").cast("double") / 100)
    expected_total = F.col("net_amount").cast("double") + F.col("gst_amount").cast("double")
    return [
        Rule("tax_recomputed", "Price", ~close_to(F.col("gst_amount"), expected_tax), on_breach="WARN"),
        Rule("total_recomputed", "Price", ~close_to(F.col("total_amount"), expected_total), on_breach="WARN"),
    ]


def _far(actual: str, expected: str) -> str:
    return (f"abs(coalesce({actual}::DOUBLE, 0) - coalesce({expected}, 0)) > 1e-8::DOUBLE + 0.01::DOUBLE * abs(coalesce({expected}, 0))")


AMOUNT_SQL = [
    ("tax_recomputed", "Price", _far("gst_amount", "net_amount::DOUBLE * (gst_rate::DOUBLE / 100)"), 0.0, "WARN", "WARN"),
    ("total_recomputed", "Price", _far("total_amount", "(net_amount::DOUBLE + gst_amount::DOUBLE)"), 0.0, "WARN", "WARN"),
]


@query("recomputed_amount_mismatch", rule_sql("order_lines", "order_lines", AMOUNT_SQL, LINES))
def recomputed_amount_mismatch(spark, folder):
    return evaluate(i.order_lines(spark, folder), amount_rules(), "order_lines")


@query(
    "linkage_expectation",
    f"""{LINES}, f AS (SELECT batch_id IS NOT NULL AS linked, coalesce(delivery_qty > 0, false) AS delivered FROM order_lines)
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE linked) AS linked_rows, count(*) FILTER (WHERE delivered) AS delivered_rows,
    count(*) FILTER (WHERE linked = delivered) AS as_expected, count(*) FILTER (WHERE linked AND NOT delivered) AS linked_without_delivery,
    count(*) FILTER (WHERE delivered AND NOT linked) AS delivery_without_link FROM f""",
)
def linkage_expectation(spark, folder):
    linked = F.col("batch_id").isNotNull()
    delivered = F.coalesce(F.col("delivery_qty") > 0, F.lit(False))
    return i.order_lines(spark, folder).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(linked).alias("linked_rows"),
        F.count_if(delivered).alias("delivered_rows"),
        F.count_if(linked == delivered).alias("as_expected"),
        F.count_if(linked & ~delivered).alias("linked_without_delivery"),
        F.count_if(delivered & ~linked).alias("delivery_without_link"),
    )


def status_rules():
    s, d = F.col("line_status"), F.col("delivery_qty")
    return [
        Rule("ordered_but_delivered", "Status", (s == "Ordered") & (d > 0), on_breach="WARN"),
        Rule("delivered_without_quantity", "Status", (s == "Delivered") & (d == 0), on_breach="WARN"),
    ]


STATUS_SQL = [
    ("ordered_but_delivered", "Status", "line_status = 'Ordered' AND delivery_qty > 0", 0.0, "WARN", "WARN"),
    ("delivered_without_quantity", "Status", "line_status = 'Delivered' AND delivery_qty = 0", 0.0, "WARN", "WARN"),
]


@query("status_contradictions", rule_sql("order_lines", "order_lines", STATUS_SQL, LINES))
def status_contradictions(spark, folder):
    return evaluate(i.order_lines(spark, folder), status_rules(), "order_lines")


BOUNDS_SQL = {
    "part": [
        ("price_negative", "Bounds", "p_retailprice < 0", 0.0, "WARN", "FAIL"),
        ("price_zero", "Bounds", "p_retailprice = 0", 0.0, "WARN", "WARN"),
        ("price_null", "Bounds", "p_retailprice IS NULL", 0.0, "WARN", "WARN"),
        ("shelf_life_range", "Bounds", "p_size < 1 OR p_size > 45", 0.0, "WARN", "WARN"),
        ("pack_count_positive", "Bounds", "p_size <= 0", 2.0, "WARN", "WARN"),
    ],
    "customer": [
        ("balance_negative", "Bounds", "c_acctbal < 0", 0.0, "WARN", "FAIL"),
        ("latitude_valid", "Bounds", "NOT coalesce(c_acctbal / 100 BETWEEN -90 AND 90, false)", 1.0, "WARN", "FAIL"),
        ("longitude_valid", "Bounds", "NOT coalesce(c_acctbal / 50 BETWEEN -180 AND 180, false)", 1.0, "WARN", "FAIL"),
    ],
}


def bound_rules():
    price, size, balance = F.col("p_retailprice"), F.col("p_size"), F.col("c_acctbal")
    part = [
        Rule("price_negative", "Bounds", price < 0),
        Rule("price_zero", "Bounds", price == 0, on_breach="WARN"),
        Rule("price_null", "Bounds", price.isNull(), on_breach="WARN"),
        Rule("shelf_life_range", "Bounds", ~size.between(1, 45), on_breach="WARN"),
        Rule("pack_count_positive", "Bounds", size <= 0, limit_pct=2.0, on_breach="WARN"),
    ]
    customer = [
        Rule("balance_negative", "Bounds", balance < 0),
        # plays: coordinates must be valid numbers
        Rule("latitude_valid", "Bounds", ~(balance / 100).between(-90, 90), "violation", limit_pct=1.0),
        Rule("longitude_valid", "Bounds", ~(balance / 50).between(-180, 180), "violation", limit_pct=1.0),
    ]
    return part, customer


def _union_sql(pieces: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in pieces)


@query("numeric_bounds", _union_sql([rule_sql(t, t, r) for t, r in BOUNDS_SQL.items()]))
def numeric_bounds(spark, folder):
    part, customer = bound_rules()
    return scorecard.scorecard([
        evaluate(load(spark, folder, "part"), part, "part"), evaluate(load(spark, folder, "customer"), customer, "customer")
    ])


CLEARANCE_SQL = """WITH clearance AS (SELECT CASE WHEN p_size > 48 THEN NULL WHEN p_size > 40 THEN 0 ELSE p_retailprice - 1200 END AS p_retailprice,
  p_size - 5 AS p_size FROM part)"""


@query("numeric_bounds_clearance", rule_sql("clearance", "clearance", BOUNDS_SQL["part"], CLEARANCE_SQL))
def numeric_bounds_clearance(spark, folder):
    """Parts at clearance prices and short of units: every bound is broken by some row."""
    size = F.col("p_size")
    price = F.when(size > 48, F.lit(None)).when(size > 40, F.lit(0)).otherwise(F.col("p_retailprice") - 1200)
    rows = load(spark, folder, "part").select(price.alias("p_retailprice"), (size - 5).alias("p_size"))
    return evaluate(rows, bound_rules()[0], "clearance")


# --- scorecards -----------------------------------------------------------------------


def all_results(spark, folder):
    """The full validation: references, business rules, grain, NULLs and year labels."""
    lines, part, customer = i.order_lines(spark, folder), *bound_rules()
    orders = load(spark, folder, "orders")
    found = [
        evaluate(lines, waterfall_rules() + amount_rules() + status_rules(), "order_lines"),
        evaluate(i.line_dates(spark, folder), date_rules(), "line_dates"),
        evaluate(i.moves(spark, folder), business.movement_rules(), "moves"),
        evaluate(labelled_orders(spark, folder), year_rules(), "orders"),
        evaluate(load(spark, folder, "part"), part, "part"),
        evaluate(load(spark, folder, "customer"), customer, "customer"),
    ]
    for table, column in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_name")):
        profile = keys.key_profile(load(spark, folder, table), [column])
        found.append(
            scorecard.as_rule(profile, table, f"unique:{column}", "Grain", F.col("rows_in_duplicates"), F.col("total_rows"))
        )
    part_parent, customer_parent = load(spark, folder, "part"), load(spark, folder, "customer")
    checks = [
        ("lineitem", i.lineitem_broken(spark, folder), [
            ("l_orderkey", "l_orderkey", orders, "o_orderkey", False), ("l_partkey", "l_partkey", part_parent, "p_partkey", False),
        ]),
        ("orders", orders, [("o_custkey", "o_custkey", customer_parent, "c_custkey", False)]),
    ]
    for table, child, edges in checks:
        check = references.reference_checks(child, edges)
        found.append(
            scorecard.as_rule(check, table, F.concat(F.lit("reference:"), F.col("reference")), "FK Integrity",
                              F.col("orphan_rows"), F.col("checked_rows"))
        )
    nulls = profiling.total_nulls(i.orders_nullable(spark, folder), ["o_custkey", "o_orderdate"])
    found.append(
        scorecard.as_rule(nulls, "orders", "critical_nulls", "Nulls", F.col("null_cells"), F.col("total_rows"))
    )
    return scorecard.scorecard(found)


def _metric_sql(table, rule, category, source, violations):
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule_id, '{category}' AS category,
      CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END AS status, v AS violations, t AS total, round(100::DOUBLE * v / t, 4) AS pct
      FROM (SELECT {violations} AS v, count(*) AS t FROM {source})"""


SCORECARD_SQL = f"""WITH {i.LINE_DATES_SQL}, {i.MOVES_SQL}, {i.BROKEN_SQL}, {LABELLED_SQL.removeprefix('WITH ')},
results AS (""" + _union_sql([
    rule_sql("order_lines", "order_lines", WATERFALL_SQL + AMOUNT_SQL + STATUS_SQL),
    rule_sql("line_dates", "line_dates", DATE_SQL),
    rule_sql("moves", "moves", MOVEMENT_SQL),
    rule_sql("orders", "labelled", YEAR_SQL),
    rule_sql("part", "part", BOUNDS_SQL["part"]),
    rule_sql("customer", "customer", BOUNDS_SQL["customer"]),
    *[_metric_sql(t, f"unique:{c}", "Grain", f"(SELECT count(*) OVER (PARTITION BY {c}) AS n FROM {t})", "count(*) FILTER (WHERE n > 1)")
      for t, c in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_name"))],
    *[_metric_sql(t, f"reference:{c}", "FK Integrity", s, f"count(*) FILTER (WHERE {c} NOT IN (SELECT {pc} FROM {p}))")
      for t, s, c, p, pc in (("lineitem", "lineitem_broken", "l_orderkey", "orders", "o_orderkey"),
                             ("lineitem", "lineitem_broken", "l_partkey", "part", "p_partkey"),
                             ("orders", "orders", "o_custkey", "customer", "c_custkey"))],
    _metric_sql("orders", "critical_nulls", "Nulls", "orders_nullable", "count(*) FILTER (WHERE o_custkey IS NULL) + count(*) FILTER (WHERE o_orderdate IS NULL)"),
]) + ")"


@query("validation_scorecard", f"{SCORECARD_SQL} SELECT * FROM results")
def validation_scorecard(spark, folder):
    return all_results(spark, folder)


@query(
    "scorecard_by_category",
    f"""{SCORECARD_SQL} SELECT category, count(*) FILTER (WHERE status = 'PASS') AS pass, count(*) FILTER (WHERE status = 'WARN') AS warn,
    count(*) FILTER (WHERE status = 'FAIL') AS fail, count(*) AS total FROM results GROUP BY 1""",
)
def scorecard_by_category(spark, folder):
    return scorecard.by_category(all_results(spark, folder))


@query(
    "scorecard_verdict",
    f"""{SCORECARD_SQL}, c AS (SELECT count(*) AS total_tests, count(*) FILTER (WHERE status = 'PASS') AS pass,
    count(*) FILTER (WHERE status = 'WARN') AS warn, count(*) FILTER (WHERE status = 'FAIL') AS fail FROM results)
    SELECT *, CASE WHEN fail > 0 THEN 'NOT READY - FIX FAILURES BEFORE PHASE 2' WHEN warn > 0 THEN 'REVIEW WARNINGS, PROCEED WITH CAUTION'
    ELSE 'READY FOR PHASE 2' END AS verdict FROM c""",
)
def scorecard_verdict(spark, folder):
    return scorecard.overall(all_results(spark, folder))


READY, NOT_READY = "READY FOR DIMENSIONAL MODELING (Accumulating Snapshot Fact)", "NOT READY - CRITICAL DATA QUALITY ISSUES PRESENT"


@query(
    "readiness_verdict",
    f"""WITH p AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS d, count(*) FILTER (WHERE o_custkey IS NULL OR o_orderdate IS NULL) AS nulls,
      count(*) FILTER (WHERE o_totalprice <= 0) AS bad FROM orders),
    k AS (SELECT unnest(['grain confirmed', 'critical columns complete', 'amounts positive']) AS check_name,
      unnest([n = d, nulls = 0, bad = 0]) AS passed FROM p)
    SELECT check_name, passed, round(100::DOUBLE * (SELECT count(*) FILTER (WHERE passed) FROM k) / 3, 4) AS passed_pct,
    CASE WHEN (SELECT bool_and(passed) FROM k) THEN '{READY}' ELSE '{NOT_READY}' END AS verdict FROM k""",
)
def readiness_verdict(spark, folder):
    orders = load(spark, folder, "orders")
    grain = keys.key_profile(orders, ["o_orderkey"]).select("is_key")
    facts = orders.agg(
        F.count_if(F.col("o_custkey").isNull() | F.col("o_orderdate").isNull()).alias("nulls"),
        F.count_if(F.col("o_totalprice") <= 0).alias("bad"),
    )
    checks = {
        "grain confirmed": F.col("is_key"),
        "critical columns complete": F.col("nulls") == 0,
        "amounts positive": F.col("bad") == 0,
    }
    return scorecard.readiness(scorecard.side_by_side([grain, facts]), checks, READY, NOT_READY)


ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations")


def _tables(spark, folder, names=ALL_TABLES):
    return {n: load(spark, folder, n) for n in names}


# keys that number the rows of their table from the smallest to the largest value
NUMBERED = {"region": "r_regionkey", "nation": "n_nationkey", "supplier": "s_suppkey", "customer": "c_custkey", "part": "p_partkey",
            "orders": "o_orderkey", "documents": "doc_id", "labels": "doc_id"}


@query(
    "row_count_baseline",
    "WITH c AS (" + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES)
    + "), b AS (" + " UNION ALL ".join(f"SELECT '{t}' AS t, CAST(max({k}) - min({k}) + 1 AS BIGINT) AS e FROM {t}" for t, k in NUMBERED.items())
    + """) SELECT table_name, row_count, e AS expected_rows, CASE WHEN e IS NULL THEN 'NO BASELINE' WHEN e = row_count THEN 'MATCH'
    ELSE 'MISMATCH' END AS status FROM c LEFT JOIN b ON t = table_name""",
)
def row_count_baseline(spark, folder):
    """Row counts against what the numbering of the keys leads one to expect; gaps show as a mismatch."""
    expected = scorecard.scorecard([
        load(spark, folder, t).agg((F.max(k) - F.min(k) + 1).cast("bigint").alias("expected_rows")).select(F.lit(t).alias("table_name"), "expected_rows")
        for t, k in NUMBERED.items()
    ])
    return scorecard.against_baseline(profiling.row_counts(_tables(spark, folder)), expected)


@query(
    "empty_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) = 0 AS is_empty FROM {t}" for t in ALL_TABLES),
)
def empty_tables(spark, folder):
    return profiling.empty_tables(_tables(spark, folder))
