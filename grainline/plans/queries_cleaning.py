"""Registered queries: cleaning, casting and conversion checks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from grainline.functions import cleaning as c
from grainline.operators import keys, profiling
from grainline.operators.curation import conversion_rules, table_rules, typed
from grainline.operators.rules import evaluate, rejects
from grainline.plans import inputs as i
from grainline.plans.registry import query
from grainline.session import load, scratch
from grainline.sinks.parquet import read_rejects, write_rejects
from grainline.sources import delimited
from grainline.spec import TableSpec, key, label, text

RAW = f"WITH {i.RAW_ORDERS_SQL}"


@query("clean_strings", f"{RAW} SELECT order_id, priority_text AS priority, status_text AS status FROM clean_orders")
def clean_strings(spark, folder):
    return i.raw_orders(spark, folder).select(
        "order_id", *[c.clean_text(F.col(n)).alias(n) for n in ("priority", "status")]
    )


@query("clean_numerics", f"{RAW} SELECT order_id, customer_text AS customer_id, price_text AS price FROM clean_orders")
def clean_numerics(spark, folder):
    return i.raw_orders(spark, folder).select(
        "order_id", *[c.clean_number(F.col(n)).alias(n) for n in ("customer_id", "price")]
    )


@query("normalize_enums", f"{RAW} SELECT order_id, status_canon AS status FROM typed_orders")
def normalize_enums(spark, folder):
    return i.raw_orders(spark, folder).select("order_id", c.canonical(F.col("status"), ("F", "O", "P")).alias("status"))


@query("range_to_null", f"{RAW} SELECT order_id, year_int AS raw_year, year_ok AS order_year FROM typed_orders")
def range_to_null(spark, folder):
    year = c.to_int(F.col("order_year"))
    return i.raw_orders(spark, folder).select(
        "order_id", year.alias("raw_year"), c.within(year, 1996, 2000).alias("order_year")
    )


@query(
    "typed_projection",
    f"""{RAW} SELECT order_id, customer_int AS customer_id, date3 AS order_date, CAST(price_dec AS DOUBLE) AS price,
    status_canon AS status, priority_text AS priority, year_ok AS order_year, urgent_flag AS is_urgent,
    large_flag AS is_large, open_flag AS is_open FROM typed_orders""",
)
def typed_projection(spark, folder):
    return typed(i.raw_orders(spark, folder), i.RAW_ORDERS_SPEC).withColumn("price", F.col("price").cast("double"))


@query("parse_dates_two_format", f"{RAW} SELECT order_id, date2 AS order_date FROM typed_orders")
def parse_dates_two_format(spark, folder):
    return i.raw_orders(spark, folder).select("order_id", c.to_date(F.col("order_date"), c.TWO_FORMATS).alias("order_date"))


@query(
    "parse_dates_three_format",
    f"{RAW} SELECT order_id, date_text8 AS date_text, date3 AS order_date FROM typed_orders",
)
def parse_dates_three_format(spark, folder):
    raw = F.col("order_date")
    return i.raw_orders(spark, folder).select(
        "order_id", c.date_text(raw, 8).alias("date_text"), c.to_date(raw, c.THREE_FORMATS, 8).alias("order_date")
    )


def _flag_query(name: str, column: str, encoding: str, sql_column: str) -> None:
    @query(name, f"{RAW} SELECT order_id, {sql_column} AS {column} FROM typed_orders")
    def run(spark, folder):
        return i.raw_orders(spark, folder).select("order_id", c.to_flag(F.col(column), (encoding,)).alias(column))


_flag_query("bool_yes_no", "is_urgent", "yes_no", "urgent_flag")
_flag_query("bool_zero_one", "is_large", "zero_one", "large_flag")
_flag_query("bool_true_false", "is_open", "true_false", "open_flag")


def rule_sql(table: str, source: str, rules: list[tuple[str, str, str, float, str, str]], ctes: str = "") -> str:
    """Check for ``evaluate``: (rule_id, category, condition, limit, within, breach) over one relation."""
    counts = ", ".join(f"count(*) FILTER (WHERE {cond}) AS v{n}" for n, (_, _, cond, *_) in enumerate(rules))
    rows = " UNION ALL ".join(
        f"SELECT '{rid}' AS rule_id, '{cat}' AS category, v{n} AS violations, {limit}::DOUBLE AS lim, '{within}' AS within, "
        f"'{breach}' AS breach, total FROM counted"
        for n, (rid, cat, _, limit, within, breach) in enumerate(rules)
    )
    head = f"{ctes}, " if ctes else "WITH "
    return f"""{head}counted AS (SELECT count(*) AS total, {counts} FROM {source}), rule_rows AS ({rows}),
    shares AS (SELECT *, coalesce(round(100::DOUBLE * violations / nullif(total, 0), 4), 0) AS pct FROM rule_rows)
    SELECT '{table}' AS table_name, rule_id, category,
      CASE WHEN violations = 0 THEN 'PASS' WHEN pct <= lim THEN within ELSE breach END AS status,
      violations, total, pct FROM shares"""


# the rules of RAW_ORDERS_SPEC: id, category, condition, limit, within, breach
CONVERSION_SQL = [
    ("cast:customer_id", "Conversion", "customer_text IS NOT NULL AND customer_int IS NULL", 0.0, "WARN", "FAIL"),
    ("date_parse:order_date", "Conversion", "date_text8 IS NOT NULL AND date3 IS NULL", 5.0, "WARN", "FAIL"),
    ("cast:price", "Conversion", "price_text IS NOT NULL AND price_dec IS NULL", 1.0, "WARN", "FAIL"),
    ("enum_invalid:status", "Domain", "status_text IS NOT NULL AND status_canon IS NULL", 100.0, "WARN", "WARN"),
    ("cast:order_year", "Conversion", "order_year IS NOT NULL AND year_int IS NULL", 1.0, "WARN", "FAIL"),
    ("out_of_range:order_year", "Domain", "year_int IS NOT NULL AND year_ok IS NULL", 100.0, "WARN", "WARN"),
    ("cast:is_urgent", "Conversion", "trim(is_urgent) <> '' AND urgent_flag IS NULL", 0.0, "WARN", "FAIL"),
    ("cast:is_large", "Conversion", "trim(is_large) <> '' AND large_flag IS NULL", 0.0, "WARN", "FAIL"),
    ("cast:is_open", "Conversion", "trim(is_open) <> '' AND open_flag IS NULL", 0.0, "WARN", "FAIL"),
]
TABLE_SQL = [
    ("key_null", "Grain", "nullif(trim(order_id), '') IS NULL", 0.0, "WARN", "FAIL"),
    ("critical_null:order_date", "Nulls", "date3 IS NULL", 2.0, "PASS", "FAIL"),
]


def _picked(prefix: str) -> list:
    return [r for r in CONVERSION_SQL if r[0].startswith(prefix)]


def _conversion_query(name: str, prefix: str) -> None:
    @query(name, rule_sql("raw_orders", "typed_orders", _picked(prefix), RAW))
    def run(spark, folder):
        rules = [r for r in conversion_rules(i.RAW_ORDERS_SPEC) if r.rule_id.startswith(prefix)]
        return evaluate(i.raw_orders(spark, folder), rules, "raw_orders")


_conversion_query("enum_invalid_counts", "enum_invalid")
_conversion_query("date_parse_failures", "date_parse")
_conversion_query("cast_failures", "cast")


@query("critical_null_gate", rule_sql("raw_orders", "typed_orders", TABLE_SQL[1:], RAW))
def critical_null_gate(spark, folder):
    rules = [r for r in table_rules(i.RAW_ORDERS_SPEC) if r.rule_id.startswith("critical_null")]
    return evaluate(i.raw_orders(spark, folder), rules, "raw_orders")


@query("raw_table_rules", rule_sql("raw_orders", "typed_orders", TABLE_SQL + CONVERSION_SQL, RAW))
def raw_table_rules(spark, folder):
    rules = table_rules(i.RAW_ORDERS_SPEC) + conversion_rules(i.RAW_ORDERS_SPEC)
    return evaluate(i.raw_orders(spark, folder), rules, "raw_orders")


@query(
    "reject_rows",
    RAW + " "
    + " UNION ALL ".join(
        f"SELECT '{rid}' AS rule_id, order_id, order_date, price, status FROM typed_orders WHERE {cond}"
        for rid, _, cond, *_ in TABLE_SQL + CONVERSION_SQL
    ),
)
def reject_rows(spark, folder):
    rules = table_rules(i.RAW_ORDERS_SPEC) + conversion_rules(i.RAW_ORDERS_SPEC)
    return rejects(i.raw_orders(spark, folder), rules, ["order_id", "order_date", "price", "status"])


@query(
    "reject_round_trip",
    RAW + ", bad AS ("
    + " UNION ALL ".join(
        f"SELECT '{rid}' AS rule_id, order_id FROM typed_orders WHERE {cond}" for rid, _, cond, *_ in TABLE_SQL + CONVERSION_SQL
    )
    + """), n AS (SELECT rule_id, count(*) AS rejected_rows, min(order_id) AS first_order FROM bad GROUP BY 1),
    s AS (SELECT rule_id, count(*) AS sampled FROM (SELECT rule_id FROM bad ORDER BY rule_id, order_id LIMIT 25) GROUP BY 1)
    SELECT n.rule_id, rejected_rows, first_order, coalesce(sampled, 0) AS sampled_rows FROM n LEFT JOIN s ON s.rule_id = n.rule_id""",
)
def reject_round_trip(spark, folder):
    """Rejects written as Parquet with a summary and a sample of 25 rows, all three read back."""
    path = scratch(spark, "rejects")
    bad = reject_rows(spark, folder).select("rule_id", "order_id")
    write_rejects(bad, path, ["rule_id", "order_id"], sample_rows=25)
    first = read_rejects(spark, path, bad).groupBy("rule_id").agg(F.min("order_id").alias("first_order"))
    summary = spark.read.schema("rule_id string, rejected_rows bigint").json(f"{path}/summary")
    sample = spark.read.schema("rule_id string, order_id string").option("header", True).csv(f"{path}/csv")
    sampled = sample.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))
    return summary.join(first, "rule_id").join(sampled, "rule_id", "left").select(
        "rule_id", "rejected_rows", "first_order", F.coalesce("n", F.lit(0)).alias("sampled_rows")
    )


DELIVERED = TableSpec("orders", "fact", ("order_key",), key("order_key") + text("status") + text("comment"))


@query(
    "row_preservation",
    """SELECT year(o_orderdate)::VARCHAR AS delivery, count(*) AS source_rows, count(*) FILTER (WHERE month(o_orderdate) <> 12) AS curated_rows,
    count(*) FILTER (WHERE month(o_orderdate) = 12) AS lost_rows, count(*) FILTER (WHERE month(o_orderdate) = 12) = 0 AS preserved
    FROM orders GROUP BY 1""",
)
def row_preservation(spark, folder):
    """Yearly deliveries whose December was lost on the way: line counts of the files against the rows that arrived."""
    path = scratch(spark, "delivered")
    o = load(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_key"), F.col("o_orderstatus").alias("status"),
        F.lit("with, comma").alias("comment"), F.date_format("o_orderdate", "yyyy").alias("year"), F.date_format("o_orderdate", "MM").alias("month"),
    )
    o.hint("rebalance", "year", "month").write.partitionBy("year", "month").option("header", True).csv(path)
    year = F.regexp_extract("file", "/year=([0-9]+)/", 1).alias("delivery")
    lines = delimited.data_lines(spark, path).groupBy(year).agg(F.sum("source_rows").alias("source_rows"))
    raw = delimited.read_raw(spark, path, replace(DELIVERED, columns=DELIVERED.columns + tuple(label("year", "month")), partitions=("year", "month")))
    arrived = raw.where("month <> '12'").groupBy(F.col("year").alias("delivery")).agg(F.count(F.lit(1)).alias("curated_rows"))
    both = lines.join(arrived, "delivery", "left").withColumn("curated_rows", F.coalesce("curated_rows", F.lit(0)))
    both = both.withColumn("lost_rows", F.col("source_rows") - F.col("curated_rows"))
    return both.withColumn("preserved", F.col("lost_rows") == 0)


@query(
    "prefix_match_rate",
    f"""WITH {i.PRODUCTS_SQL} SELECT count(*) AS total_rows,
    count(*) FILTER (WHERE starts_with(product_code, generic_code)) AS matching_rows,
    round(100::DOUBLE * count(*) FILTER (WHERE starts_with(product_code, generic_code)) / count(*), 4) AS match_pct FROM products""",
)
def prefix_match_rate(spark, folder):
    return keys.prefix_rate(i.products(spark, folder), c.starts_with(F.col("product_code"), F.col("generic_code")))


@query(
    "placeholder_values",
    f"""WITH {i.PRODUCTS_SQL} SELECT product_id, product_name, strength_value FROM products
    WHERE strength_value IS NULL OR lower(trim(strength_value)) IN ('na', 'n/a', 'none', 'unknown', 'as directed', 'nan')""",
)
def placeholder_values(spark, folder):
    p = i.products(spark, folder)
    return p.where(c.is_placeholder(F.col("strength_value"))).select("product_id", "product_name", "strength_value")


@query(
    "partial_pairs",
    f"""WITH {i.PRODUCTS_SQL} SELECT product_id, strength_value, strength_unit FROM products
    WHERE (strength_value IS NULL) <> (strength_unit IS NULL)""",
)
def partial_pairs(spark, folder):
    p = i.products(spark, folder)
    return p.where(c.exactly_one_present(F.col("strength_value"), F.col("strength_unit"))).select(
        "product_id", "strength_value", "strength_unit"
    )


@query(
    "split_measure_text",
    f"""WITH {i.PRODUCTS_SQL}, parts AS (SELECT product_id, strength_value,
      regexp_extract(trim(strength_value), '^([0-9]+(?:\\.[0-9]+)?)\\s*([A-Za-z%]+)?(?:\\s*/\\s*([0-9]+(?:\\.[0-9]+)?)?\\s*([A-Za-z]+))?$', ['a', 'u', 'pa', 'pu']) AS m FROM products)
    SELECT product_id, strength_value, TRY_CAST(nullif(m.a, '') AS DOUBLE) AS amount, nullif(lower(m.u), '') AS unit,
      TRY_CAST(coalesce(nullif(m.pa, ''), CASE WHEN nullif(m.pu, '') IS NOT NULL THEN '1' END) AS DOUBLE) AS per_amount,
      nullif(lower(m.pu), '') AS per_unit FROM parts""",
)
def split_measure_text(spark, folder):
    p = i.products(spark, folder).select("product_id", "strength_value", c.split_measure(F.col("strength_value")).alias("m"))
    return p.select(
        "product_id",
        "strength_value",
        F.col("m.amount").cast("double").alias("amount"),
        F.col("m.unit").alias("unit"),
        F.col("m.per_amount").cast("double").alias("per_amount"),
        F.col("m.per_unit").alias("per_unit"),
    )


@query(
    "inconsistent_flag",
    """SELECT c_custkey, c_mktsegment, c_acctbal, (c_mktsegment = 'MACHINERY' AND c_acctbal > 0) AS is_inconsistent FROM customer""",
)
def inconsistent_flag(spark, folder):
    cu = load(spark, folder, "customer")
    # plays: cold storage "not available" (segment) but a capacity above 0 (balance)
    off = F.col("c_mktsegment") == "MACHINERY"
    return cu.select("c_custkey", "c_mktsegment", "c_acctbal", (off & (F.col("c_acctbal") > 0)).alias("is_inconsistent"))


@query(
    "null_rates",
    f"""WITH {i.ORDERS_NULLABLE_SQL}, n AS (SELECT count(*) AS t, {', '.join(f"count(*) FILTER (WHERE {x} IS NULL) AS n_{x}" for x in ('o_orderkey', 'o_custkey', 'o_orderdate', 'o_orderpriority'))} FROM orders_nullable)
    {' UNION ALL '.join(f"SELECT '{x}' AS column_name, n_{x} AS null_count, t AS total_rows, round(100::DOUBLE * n_{x} / t, 4) AS null_pct, round(100::DOUBLE * (t - n_{x}) / t, 4) AS success_pct FROM n" for x in ('o_orderkey', 'o_custkey', 'o_orderdate', 'o_orderpriority'))}""",
)
def null_rates(spark, folder):
    return profiling.null_rates(
        i.orders_nullable(spark, folder), ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]
    )


@query(
    "critical_nulls_total",
    f"""WITH {i.ORDERS_NULLABLE_SQL} SELECT count(*) AS total_rows,
    count(*) FILTER (WHERE o_custkey IS NULL) + count(*) FILTER (WHERE o_orderpriority IS NULL)
    + count(*) FILTER (WHERE o_orderdate IS NULL) AS null_cells FROM orders_nullable""",
)
def critical_nulls_total(spark, folder):
    return profiling.total_nulls(i.orders_nullable(spark, folder), ["o_custkey", "o_orderpriority", "o_orderdate"])
