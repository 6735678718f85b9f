"""Registered queries: profiles and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainline.functions.compare import days_between
from grainline.operators import keys, profiling, scorecard, sketches, supply
from grainline.operators.quantiles import describe
from grainline.plans import inputs as i
from grainline.plans.queries_rules import ALL_TABLES
from grainline.plans.registry import query
from grainline.session import load, settle

LINES = f"WITH {i.ORDER_LINES_SQL}"
DATES = f"WITH {i.LINE_DATES_SQL}"
NULLABLE = f"WITH {i.ORDERS_NULLABLE_SQL}"

# Columns and types of the given tables, in order.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@query(
    "entity_inventory",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({n} AS INTEGER) AS position, '{c}' AS column_name, '{d}' AS data_type, "
        f"count(*) AS row_count, CAST({len(spec.split(', '))} AS INTEGER) AS column_count FROM {t}"
        for t, spec in COLUMNS.items()
        for n, (c, d) in enumerate((x.split() for x in spec.split(", ")), start=1)
    ),
)
def entity_inventory(spark, folder):
    return profiling.inventory({t: load(spark, folder, t) for t in COLUMNS})


@query(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES),
)
def table_row_counts(spark, folder):
    return profiling.row_counts({t: load(spark, folder, t) for t in ALL_TABLES})


@query(
    "sample_rows",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{name}' AS sample, o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY {order} LIMIT 5)"
        for name, order in (("head", "o_orderkey"), ("tail", "o_orderkey DESC"), ("random", "md5(CAST(o_orderkey AS VARCHAR)), o_orderkey"))
    ),
)
def sample_rows(spark, folder):
    return profiling.samples(load(spark, folder, "orders"), ["o_orderkey"], ["o_orderkey", "o_custkey", "o_orderstatus"])


def describe_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS std,
        round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50,
        round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75, round(max({c})::DOUBLE, 4) AS max FROM {source}"""
        for c in columns
    )


@query("numeric_describe", describe_sql("orders", ["o_totalprice"]))
def numeric_describe(spark, folder):
    return describe(load(spark, folder, "orders"), ["o_totalprice"])


@query(
    "line_quantity_describe",
    f"{LINES} " + describe_sql("order_lines", ["order_qty", "delivery_qty", "invoice_qty"]),
)
def line_quantity_describe(spark, folder):
    return describe(i.order_lines(spark, folder), ["order_qty", "delivery_qty", "invoice_qty"])


@query(
    "line_price_describe",
    f"{LINES} " + describe_sql("order_lines", ["order_price", "net_amount", "gst_amount", "total_amount"]),
)
def line_price_describe(spark, folder):
    return describe(i.order_lines(spark, folder), ["order_price", "net_amount", "gst_amount", "total_amount"])


@query(
    "lag_stats",
    f"""{DATES}, lags AS (SELECT date_diff('day', order_date, delivery_date) AS delivery_lag, date_diff('day', delivery_date, invoice_date) AS invoice_lag FROM line_dates),
    d AS ({describe_sql("lags", ["delivery_lag", "invoice_lag"])}),
    n AS (SELECT 'delivery_lag' AS column_name, count(*) FILTER (WHERE delivery_lag < 0) AS negative_rows FROM lags
      UNION ALL SELECT 'invoice_lag', count(*) FILTER (WHERE invoice_lag < 0) FROM lags)
    SELECT * FROM d JOIN n USING (column_name)""",
)
def lag_stats(spark, folder):
    lags = i.line_dates(spark, folder).select(
        days_between(F.col("order_date"), F.col("delivery_date")).alias("delivery_lag"),
        days_between(F.col("delivery_date"), F.col("invoice_date")).alias("invoice_lag"),
    )
    # days are few: the rest works on one weighted row per pair of lags
    weighted = lags.groupBy("delivery_lag", "invoice_lag").agg(F.count(F.lit(1)).alias("w"))
    names = ["delivery_lag", "invoice_lag"]
    negative = weighted.agg(*[F.coalesce(F.sum(F.when(F.col(n) < 0, F.col("w"))), F.lit(0)).alias(n) for n in names])
    cells = [F.struct(F.lit(n).alias("column_name"), F.col(n).alias("negative_rows")) for n in names]
    negative = negative.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return describe(weighted, names, weight="w").join(negative, "column_name")


@query(
    "value_counts",
    f"{NULLABLE} SELECT o_orderpriority, count(*) AS row_count FROM orders_nullable WHERE o_orderpriority IS NOT NULL GROUP BY 1",
)
def value_counts(spark, folder):
    return profiling.value_counts(i.orders_nullable(spark, folder), ["o_orderpriority"])


@query(
    "group_value_counts",
    f"""{NULLABLE} SELECT o_orderstatus, o_orderpriority, count(*) AS row_count FROM orders_nullable
    WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2""",
)
def group_value_counts(spark, folder):
    return profiling.value_counts(i.orders_nullable(spark, folder), ["o_orderstatus", "o_orderpriority"])


@query(
    "share_within_group",
    f"""{NULLABLE}, n AS (SELECT o_orderstatus, o_orderpriority, count(*) AS row_count FROM orders_nullable
      WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2)
    SELECT *, round(100::DOUBLE * row_count / CAST(sum(row_count) OVER (PARTITION BY o_orderstatus) AS BIGINT), 4) AS share_pct FROM n""",
)
def share_within_group(spark, folder):
    return profiling.share_within(i.orders_nullable(spark, folder), "o_orderstatus", "o_orderpriority")


@query(
    "crosstab",
    f"""{LINES} SELECT batch_id IS NOT NULL AS batch_populated, count(*) FILTER (WHERE NOT coalesce(delivery_qty > 0, false)) AS not_delivered,
    count(*) FILTER (WHERE coalesce(delivery_qty > 0, false)) AS delivered FROM order_lines GROUP BY 1""",
)
def crosstab(spark, folder):
    return profiling.crosstab(
        i.order_lines(spark, folder), F.col("batch_id").isNotNull(), F.coalesce(F.col("delivery_qty") > 0, F.lit(False)),
        [False, True], ["not_delivered", "delivered"], "batch_populated",
    )


@query(
    "crosstab_margins",
    f"""{NULLABLE} SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'All' ELSE o_orderpriority END AS o_orderpriority,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o,
    count(*) FILTER (WHERE o_orderstatus = 'P') AS p, count(*) AS all_columns FROM orders_nullable
    WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY ROLLUP (o_orderpriority)""",
)
def crosstab_margins(spark, folder):
    return profiling.crosstab_margins(
        i.orders_nullable(spark, folder), "o_orderpriority", "o_orderstatus", ["F", "O", "P"], ["f", "o", "p"]
    )


CONDITIONS = {
    "order_qty_positive": "order_qty > 0",
    "delivery_qty_positive": "delivery_qty > 0",
    "invoice_qty_positive": "invoice_qty > 0",
    "batch_filled": "batch_id IS NOT NULL",
    "total_missing": "total_amount IS NULL",
    "cancelled": "line_status = 'Cancelled'",
    "returned": "line_status = 'Returned'",
    "cancel_reason_filled": "cancel_reason IS NOT NULL",
    "return_reason_filled": "return_reason IS NOT NULL",
}


@query(
    "conditional_counts",
    f"{LINES} " + " UNION ALL ".join(
        f"SELECT '{n}' AS condition, count(*) FILTER (WHERE {c}) AS row_count FROM order_lines" for n, c in CONDITIONS.items()
    ),
)
def conditional_counts(spark, folder):
    return profiling.conditional_counts(i.order_lines(spark, folder), {n: F.expr(c) for n, c in CONDITIONS.items()})


@query(
    "status_quantity_matrix",
    f"""{LINES} SELECT line_status, count(delivery_qty) AS delivery_lines, count(*) FILTER (WHERE delivery_qty > 0) AS lines_with_delivery,
    count(invoice_qty) AS invoice_lines, count(*) FILTER (WHERE invoice_qty > 0) AS lines_with_invoice FROM order_lines GROUP BY 1""",
)
def status_quantity_matrix(spark, folder):
    d, n = F.col("delivery_qty"), F.col("invoice_qty")
    return i.order_lines(spark, folder).groupBy("line_status").agg(
        F.count(d).alias("delivery_lines"),
        F.count_if(d > 0).alias("lines_with_delivery"),
        F.count(n).alias("invoice_lines"),
        F.count_if(n > 0).alias("lines_with_invoice"),
    )


@query(
    "fulfilment_rate",
    f"""{LINES} SELECT count(*) FILTER (WHERE delivery_qty > 0) AS delivered_lines,
    round(avg(delivery_qty::DOUBLE / nullif(order_qty, 0)) FILTER (WHERE delivery_qty > 0), 4) AS fulfilment_rate,
    count(*) FILTER (WHERE invoice_qty > 0) AS invoiced_lines,
    round(avg(invoice_qty::DOUBLE / nullif(delivery_qty, 0)) FILTER (WHERE invoice_qty > 0), 4) AS invoice_rate FROM order_lines""",
)
def fulfilment_rate(spark, folder):
    o, d, n = F.col("order_qty"), F.col("delivery_qty"), F.col("invoice_qty")
    return i.order_lines(spark, folder).agg(
        F.count_if(d > 0).alias("delivered_lines"),
        F.round(F.avg(F.when(d > 0, F.try_divide(d, o))), 4).alias("fulfilment_rate"),
        F.count_if(n > 0).alias("invoiced_lines"),
        F.round(F.avg(F.when(n > 0, F.try_divide(n, d))), 4).alias("invoice_rate"),
    )


HEADER_SQL = """h AS (SELECT order_no, count(*) AS line_count, count(DISTINCT product_id) AS unique_products,
  count(DISTINCT supplier_id) AS unique_suppliers, count(DISTINCT ship_date) AS unique_dates,
  CAST(sum(order_qty) AS BIGINT) AS total_qty, CAST(sum(order_price) AS DOUBLE) AS total_amount FROM order_lines GROUP BY 1)"""


def _headers(spark, folder):
    return supply.header_rollup(
        i.order_lines(spark, folder), "order_no",
        {"unique_products": "product_id", "unique_suppliers": "supplier_id", "unique_dates": "ship_date"},
        {"total_qty": "order_qty", "total_amount": "order_price"},
    )


@query("order_header_rollup", f"{LINES}, {HEADER_SQL} SELECT * FROM h")
def order_header_rollup(spark, folder):
    return _headers(spark, folder).withColumn("total_amount", F.col("total_amount").cast("double"))


HEADER_MEASURES = ["line_count", "unique_products", "unique_suppliers", "unique_dates", "total_qty", "total_amount"]


@query("order_header_describe", f"{LINES}, {HEADER_SQL} " + describe_sql("h", HEADER_MEASURES))
def order_header_describe(spark, folder):
    return describe(_headers(spark, folder), HEADER_MEASURES)


@query(
    "inconsistent_headers",
    f"""{LINES} SELECT order_no, count(DISTINCT line_status) > 1 AS line_status_differs, count(DISTINCT ship_date) > 1 AS ship_date_differs
    FROM order_lines GROUP BY 1 HAVING count(DISTINCT line_status) > 1 OR count(DISTINCT ship_date) > 1""",
)
def inconsistent_headers(spark, folder):
    return supply.inconsistent_headers(i.order_lines(spark, folder), "order_no", ["line_status", "ship_date"])


@query(
    "multi_plant_headers",
    """WITH h AS (SELECT l_orderkey, count(DISTINCT l_suppkey) AS d FROM lineitem GROUP BY 1)
    SELECT count(*) AS headers, count(*) FILTER (WHERE d > 1) AS multi_plant_headers,
    round(100::DOUBLE * count(*) FILTER (WHERE d > 1) / count(*), 4) AS multi_plant_pct FROM h""",
)
def multi_plant_headers(spark, folder):
    spread = load(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("low"), F.max("l_suppkey").alias("high")
    )
    return keys.prefix_rate(spread, F.col("low") != F.col("high")).toDF("headers", "multi_plant_headers", "multi_plant_pct")


@query(
    "null_pattern_by_type",
    f"""WITH {i.MOVES_SQL} SELECT movement_type, from_plant_id IS NULL AS from_plant_id_null, to_plant_id IS NULL AS to_plant_id_null,
    count(*) AS row_count FROM moves GROUP BY 1, 2, 3""",
)
def null_pattern_by_type(spark, folder):
    return profiling.null_pattern(i.moves(spark, folder), "movement_type", ["from_plant_id", "to_plant_id"])


@query(
    "date_ranges",
    """SELECT 'orders' AS table_name, 'order_date' AS column_name, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders
    UNION ALL SELECT 'lineitem', 'ship_date', CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE) FROM lineitem
    UNION ALL SELECT 'events', 'event_date', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) FROM events""",
)
def date_ranges(spark, folder):
    dated = [("orders", "o_orderdate", "order_date"), ("lineitem", "l_shipdate", "ship_date"), ("events", "ts", "event_date")]
    return scorecard.scorecard([
        profiling.date_ranges(load(spark, folder, t).select(F.col(c).cast("date").alias(n)), [n], t) for t, c, n in dated
    ])


@query("distinct_years", "SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem")
def distinct_years(spark, folder):
    return profiling.distinct_years(load(spark, folder, "lineitem"), "l_shipdate").orderBy("year")


@query(
    "top_k_groups",
    """SELECT l_partkey, count(*) AS row_count FROM lineitem GROUP BY 1 ORDER BY row_count DESC, l_partkey LIMIT 10""",
)
def top_k_groups(spark, folder):
    return profiling.top_groups(load(spark, folder, "lineitem"), ["l_partkey"], 10)


@query(
    "top_reasons",
    f"""{LINES}, c AS (SELECT 'cancel' AS kind, cancel_reason AS reason, count(*) AS row_count FROM order_lines WHERE cancel_reason IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10),
    r AS (SELECT 'return' AS kind, return_reason AS reason, count(*) AS row_count FROM order_lines WHERE return_reason IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
    SELECT * FROM c UNION ALL SELECT * FROM r""",
)
def top_reasons(spark, folder):
    lines = i.order_lines(spark, folder)
    return scorecard.scorecard([
        profiling.top_groups(lines, [f"{kind}_reason"], 10).select(
            F.lit(kind).alias("kind"), F.col(f"{kind}_reason").alias("reason"), "row_count"
        )
        for kind in ("cancel", "return")
    ])


SKETCHED = ["o_custkey", "o_totalprice", "o_orderpriority"]


@query(
    "merged_profiles",
    f"WITH {i.ORDERS_NULLABLE_SQL} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
        {f"CAST(min({c}) AS DOUBLE)" if c != "o_orderpriority" else "NULL::DOUBLE"} AS min, {f"CAST(max({c}) AS DOUBLE)" if c != "o_orderpriority" else "NULL::DOUBLE"} AS max,
        true AS distinct_in_bound FROM orders_nullable""" for c in SKETCHED
    ),
)
def merged_profiles(spark, folder):
    """Profiles per year, written and merged without the rows; the distinct counts are checked against exact ones."""
    orders = i.orders_nullable(spark, folder)
    yearly = settle(sketches.profile(orders.withColumn("year", F.year("o_orderdate")), ["year"], SKETCHED), "profiles")
    found = sketches.estimates(sketches.merged(yearly, []))
    exact = keys.candidate_keys(orders, SKETCHED).select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.ceil(F.col("exact") * sketches.DISTINCT_ERROR)
    return found.join(exact, "column_name").select("column_name", "row_count", "null_count", "min", "max", near.alias("distinct_in_bound"))



@query(
    "exact_describe",
    """WITH v AS (SELECT 'order_ref' AS column_name, CAST(o_orderkey AS HUGEINT) * 900719925474 + o_custkey AS v FROM orders
      UNION ALL SELECT 'price_cents', CAST(round(o_totalprice * 100) AS HUGEINT) FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY v) - 1 AS place, count(*) OVER (PARTITION BY column_name) - 1 AS last FROM v)
    SELECT column_name, max(last) + 1 AS count, CAST(min(v) AS VARCHAR) AS min, CAST(max(v) AS VARCHAR) AS max,
    CAST(max(v) FILTER (WHERE place = last // 2) + max(v) FILTER (WHERE place = (last + 1) // 2) AS VARCHAR) AS median_twice FROM r GROUP BY 1""",
)
def exact_describe(spark, folder):
    """Extremes and median of whole numbers, some beyond what a double holds, as text; twice the median is whole."""
    ref = (F.col("o_orderkey").cast("bigint") * F.lit(900719925474) + F.col("o_custkey")).alias("order_ref")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("price_cents")
    found = describe(load(spark, folder, "orders").select(ref, cents), ["order_ref", "price_cents"], exact=True)
    text = lambda c, times=1: (F.col(c) * times).cast("decimal(38,0)").cast("string")
    return found.select("column_name", "count", text("min").alias("min"), text("max").alias("max"), text("q50", 2).alias("median_twice"))
