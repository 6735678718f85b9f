"""Registered queries: readers, writers, manifests and the run ledger.

Queries that write use a new folder below the shared scratch folder and read it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.operators import profiling
from grainline.operators.curation import conversion_rules, table_rules
from grainline.operators.rules import evaluate
from grainline.plans import inputs as i
from grainline.plans.curate import curate, read_curated
from grainline.plans.curate import publication_drift as drift_of_run
from grainline.plans.incremental import curate_incremental, read_incremental
from grainline.plans.queries_cleaning import CONVERSION_SQL, RAW, TABLE_SQL, rule_sql
from grainline.plans.registry import query
from grainline.session import load, scratch
from grainline.sinks import ledger
from grainline.sinks.parquet import with_period, write_partitioned, write_table
from grainline.sinks.reports import quality_report as report_rows
from grainline.sources import delimited, manifest
from grainline.spec import TableSpec, ids, key, label, money, text, date

EXPORT_SPEC = TableSpec(
    "export", "fact", ("order_key",),
    key("order_key") + ids("customer_key") + text("status") + money("total_price") + date("order_date")
    + text("priority", "channel") + label("year"),
    partitions=("year",),
)

PERIOD = "strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month"


def _export(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as an export: text, padded, with mixed-case column names."""
    o = load(spark, folder, "orders")
    pad = lambda c: F.concat(F.lit(" "), c, F.lit("  "))
    return o.select(
        F.col("o_orderkey").cast("string").alias("Order Key"),
        pad(F.col("o_custkey").cast("string")).alias(" CUSTOMER_KEY"),
        pad(F.col("o_orderstatus")).alias("Status"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("Total Price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ORDER_DATE"),
        F.col("o_orderpriority").alias("priority"),
        F.date_format("o_orderdate", "yyyy").alias("year"),
        F.date_format("o_orderdate", "MM").alias("month"),
    )


EXPORT_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS VARCHAR) AS customer_key, o_orderstatus AS status,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_price, strftime(o_orderdate, '%Y-%m-%d') AS order_date"""


@query("csv_scan_roundtrip", f"{EXPORT_SQL} FROM orders")
def csv_scan_roundtrip(spark, folder):
    path = scratch(spark, "csv")
    _export(spark, folder).drop("priority", "year", "month").write.option("header", True).csv(path)
    return delimited.scan_csv(spark, path, ["order_key", "customer_key", "status", "total_price", "order_date"])


@query("normalize_columns", f"{EXPORT_SQL}, o_orderpriority AS priority FROM orders")
def normalize_columns(spark, folder):
    export = _export(spark, folder).drop("year", "month")
    return delimited.normalize_columns(export).withColumn("customer_key", F.trim("customer_key")).withColumn(
        "status", F.trim("status")
    )


@query("partitioned_scan", f"SELECT CAST(o_orderkey AS VARCHAR) AS order_key, {PERIOD} FROM orders")
def partitioned_scan(spark, folder):
    path = scratch(spark, "partitioned")
    export = _export(spark, folder).select(F.col("Order Key").alias("order_key"), "year", "month")
    export.hint("rebalance", "year", "month").write.partitionBy("year", "month").option("header", True).csv(path)
    return delimited.scan_csv(spark, path, ["order_key"], ["year", "month"])


@query("partition_split", f"SELECT o_orderkey, o_custkey, o_totalprice, {PERIOD} FROM orders")
def partition_split(spark, folder):
    path = scratch(spark, "split")
    rows = with_period(load(spark, folder, "orders"), "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_totalprice", "year", "month"
    )
    write_partitioned(rows, path, ["year", "month"])
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "union_yearly_exports",
    "SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y') AS export_year FROM orders",
)
def union_yearly_exports(spark, folder):
    path = scratch(spark, "yearly")
    o = load(spark, folder, "orders").withColumn("export_year", F.date_format("o_orderdate", "yyyy"))
    columns = ["o_orderkey", "o_orderstatus", "export_year"]
    o.select(*columns, F.col("export_year").alias("y")).hint("rebalance", "y").write.partitionBy("y").parquet(path)
    # one folder per export; the number of exports, not of rows, reaches the driver
    years = [r.y for r in spark.read.parquet(path).select("y").distinct().collect()]
    return delimited.union_drifting([spark.read.parquet(f"{path}/y={y}").select(*columns) for y in sorted(years)])


def _drifting_exports(spark: SparkSession, folder: str, path: str | None = None, condition: str = "true") -> str:
    """Yearly CSV exports below one folder; older ones lack ``priority``, the newest adds ``channel`` and moves columns."""
    path, delivered = path or scratch(spark, "drift"), condition
    e = delimited.normalize_columns(_export(spark, folder)).drop("month")
    base = ["order_key", "customer_key", "status", "total_price", "order_date"]
    parts = [
        ("year < '1998'", base),
        ("year between '1998' and '2000'", [*base, "priority"]),
        ("year > '2000'", ["customer_key", "order_key", "status", "total_price", "order_date", "priority", "channel"]),
    ]
    e = e.withColumn("channel", F.concat(F.lit("ch-"), "status"))
    for condition, columns in parts:
        e.where(condition).where(delivered).select(*columns, "year").hint("rebalance", "year").write.mode("append").partitionBy(
            "year"
        ).option("header", True).csv(path)
    return path


@query(
    "schema_drift_union",
    f"""{EXPORT_SQL}, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS priority,
    CASE WHEN year(o_orderdate) > 2000 THEN 'ch- ' || o_orderstatus END AS channel,
    strftime(o_orderdate, '%Y') AS year FROM orders""",
)
def schema_drift_union(spark, folder):
    return delimited.read_raw(spark, _drifting_exports(spark, folder), EXPORT_SPEC)


@query(
    "curated_publication",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS INTEGER) AS customer_key, o_orderstatus AS status, o_totalprice AS total_price,
    CAST(o_orderdate AS DATE) AS order_date, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS priority,
    CASE WHEN year(o_orderdate) > 2000 THEN 'ch- ' || o_orderstatus END AS channel, strftime(o_orderdate, '%Y') AS year FROM orders""",
)
def curated_publication(spark, folder):
    """The whole job: drifting CSV exports are read, staged, gated, published and read back."""
    target = scratch(spark, "curated")
    curate(spark, [EXPORT_SPEC], {EXPORT_SPEC.name: _drifting_exports(spark, folder)}, target, "run-1")
    return read_curated(spark, target, EXPORT_SPEC).withColumn("total_price", F.col("total_price").cast("double"))


PUBLISHED_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS INTEGER) AS customer_key, o_orderstatus AS status, o_totalprice AS total_price,
    CAST(o_orderdate AS DATE) AS order_date, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS priority,
    CASE WHEN year(o_orderdate) > 2000 THEN 'ch- ' || o_orderstatus END AS channel, strftime(o_orderdate, '%Y') AS year FROM orders"""


@query("incremental_publication", PUBLISHED_SQL)
def incremental_publication(spark, folder):
    """Two deliveries into one folder; the second run reads only the files of the second."""
    target, root = scratch(spark, "increments"), scratch(spark, "deliveries")
    for run, years in (("run-1", "year < '1997'"), ("run-2", "year >= '1997'")):
        _drifting_exports(spark, folder, root, years)
        curate_incremental(spark, [EXPORT_SPEC], {EXPORT_SPEC.name: root}, target, run)
    return read_incremental(spark, target, EXPORT_SPEC).withColumn("total_price", F.col("total_price").cast("double"))


@query("publication_as_of", f"SELECT * FROM ({PUBLISHED_SQL}) WHERE year < '1997'")
def publication_as_of(spark, folder):
    """The table as the first of two runs left it."""
    target = scratch(spark, "curated")
    for run, years in (("run-1", "year < '1997'"), ("run-2", "year >= '1996'")):
        curate(spark, [EXPORT_SPEC], {EXPORT_SPEC.name: _drifting_exports(spark, folder, condition=years)}, target, run)
    return read_curated(spark, target, EXPORT_SPEC, as_of="run-1").withColumn("total_price", F.col("total_price").cast("double"))


# The second delivery lacks the finished orders of one year and all orders of another.
SECOND = "not (year = '1996' and trim(status) = 'F') and year <> '1994'"


@query(
    "publication_drift",
    """WITH o AS (SELECT strftime(o_orderdate, '%Y') AS year, o_orderstatus AS status, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS priority FROM orders),
    v AS (SELECT year, unnest(['status', 'priority']) AS column_name, unnest([status, priority]) AS value, year <> '1996' OR status <> 'F' AS kept FROM o),
    c AS (SELECT year, column_name, value, count(*) AS b, CASE WHEN year = '1994' THEN count(*) ELSE count(*) FILTER (WHERE kept) END AS a FROM v GROUP BY 1, 2, 3),
    t AS (SELECT *, sum(b) OVER w AS nb, sum(a) OVER w AS na FROM c WINDOW w AS (PARTITION BY year, column_name)),
    d AS (SELECT year, column_name, CAST(nb AS BIGINT) AS rows_before, CAST(na AS BIGINT) AS rows_after, round(100.0::DOUBLE * (na - nb) / nb, 4) AS change_pct,
      round(sum(abs(b * na - a * nb))::DOUBLE / (2.0::DOUBLE * nb * na), 6) AS distance FROM t GROUP BY year, column_name, nb, na)
    SELECT *, CASE WHEN abs(change_pct) > 20 THEN 'COUNT DRIFT' WHEN distance > 0.1 THEN 'VALUE DRIFT' ELSE 'STABLE' END AS status FROM d""",
)
def publication_drift(spark, folder):
    """What the second of two runs changed, per year: a year not delivered again stays as it was."""
    target = scratch(spark, "curated")
    for run, delivered in (("run-1", "true"), ("run-2", SECOND)):
        curate(spark, [EXPORT_SPEC], {EXPORT_SPEC.name: _drifting_exports(spark, folder, condition=delivered)}, target, run)
    return drift_of_run(spark, target, EXPORT_SPEC, "run-2", ["status", "priority"])


@query(
    "schema_diff",
    """WITH y AS (SELECT DISTINCT strftime(o_orderdate, '%Y') AS year FROM orders)
    SELECT year, 'priority' AS column_name, 'missing' AS finding FROM y WHERE year < '1998'
    UNION ALL SELECT year, 'channel', 'extra' FROM y WHERE year > '2000'
    UNION ALL SELECT year, unnest(['order_key', 'customer_key']), 'moved' FROM y WHERE year > '2000'
    UNION ALL SELECT year, 'month', 'label' FROM y""",
)
def schema_diff(spark, folder):
    headers = delimited.file_headers(spark, _drifting_exports(spark, folder))
    expected = ["order_key", "customer_key", "status", "total_price", "order_date", "priority"]
    found = delimited.schema_differences(headers, expected).unionByName(
        delimited.missing_labels(headers, ["year", "month"]).select(
            "path", F.col("label").alias("column_name"), F.lit("label").alias("finding")
        )
    )
    year = F.regexp_extract("path", r"/year=([^/]+)/", 1).alias("year")
    return found.select(year, "column_name", "finding").distinct()


@query(
    "dynamic_partition_overwrite",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 2000 THEN 'REVISED' ELSE o_orderstatus END AS o_orderstatus,
    strftime(o_orderdate, '%Y') AS year FROM orders""",
)
def dynamic_partition_overwrite(spark, folder):
    path = scratch(spark, "dynamic")
    rows = load(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy").alias("year")
    )
    write_partitioned(rows, path, ["year"])
    write_partitioned(rows.where("year >= '2000'").withColumn("o_orderstatus", F.lit("REVISED")), path, ["year"])
    return spark.read.schema(rows.schema).parquet(path)


@query("dimension_overwrite", "SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment FROM customer")
def dimension_overwrite(spark, folder):
    path = scratch(spark, "dimension")
    rows = load(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    write_table(rows, path)
    write_table(rows.withColumn("c_name", F.upper("c_name")), path)
    return spark.read.parquet(path)


@query(
    "file_manifest",
    f"""WITH {i.FILES_SQL} SELECT path, size_bytes, md5, 'fact' AS table_type, 'documents' AS table_name, CAST(NULL AS VARCHAR) AS year,
    CAST(NULL AS VARCHAR) AS month, 'doc-' || doc_id || '.txt' AS file_name FROM document_files""",
)
def file_manifest(spark, folder):
    return manifest.manifest_rows(i.document_files(spark, folder))


@query("manifest_diff", f"WITH {i.FILES_SQL} SELECT path, md5, size_bytes, etag, reason, status, verification FROM decisions")
def manifest_diff(spark, folder):
    return manifest.transfer_decisions(i.document_files(spark, folder), i.stored_files(spark, folder))


FORCED_SQL = """CASE WHEN etag IS NULL THEN 'file_not_exists' WHEN etag LIKE '%-%' THEN 'force_overwrite_multipart'
  WHEN etag = md5 THEN 'force_overwrite' ELSE 'force_overwrite_mismatch' END"""


@query(
    "manifest_diff_forced",
    f"WITH {i.FILES_SQL} SELECT path, md5, size_bytes, etag, {FORCED_SQL} AS reason, 'success' AS status, verification FROM decisions",
)
def manifest_diff_forced(spark, folder):
    return manifest.transfer_decisions(i.document_files(spark, folder), i.stored_files(spark, folder), force=True)


@query(
    "manifest_summary",
    f"WITH {i.FILES_SQL} SELECT status, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS total_bytes FROM decisions GROUP BY 1",
)
def manifest_summary(spark, folder):
    return manifest.manifest_totals(
        manifest.transfer_decisions(i.document_files(spark, folder), i.stored_files(spark, folder))
    )


@query("manifest_error_list", f"WITH {i.FILES_SQL} SELECT path, reason FROM decisions WHERE status = 'failed'")
def manifest_error_list(spark, folder):
    return manifest.manifest_errors(
        manifest.transfer_decisions(i.document_files(spark, folder), i.stored_files(spark, folder))
    )


@query(
    "partition_labels_from_path",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'dimension' ELSE 'fact' END AS table_type,
    CASE WHEN o_orderstatus = 'P' THEN 'customers' ELSE 'orders' END AS table_name,
    CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y') END AS year,
    CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%m') END AS month,
    'part-' || o_orderkey || '.csv' AS file_name FROM orders""",
)
def partition_labels_from_path(spark, folder):
    o = load(spark, folder, "orders")
    file = F.concat(F.lit("part-"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    year = F.concat(F.lit("year="), F.date_format("o_orderdate", "yyyy"), F.lit("/"))
    month = F.concat(F.lit("month="), F.date_format("o_orderdate", "MM"), F.lit("/"))
    path = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("raw/dimensions/customers/"), file))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("raw/facts/orders/"), year, month, file))
        .otherwise(F.concat(F.lit("raw/facts/orders/"), year, file))
    )
    return o.select("o_orderkey", *manifest.path_labels(path))


LEDGER_SQL = """ledger AS (SELECT event_id, 'table-' || user_id AS table_name, ts,
  CASE event_type WHEN 'purchase' THEN 'COMMITTED' WHEN 'error' THEN 'FAILED' ELSE 'IN_PROGRESS' END AS status,
  CAST(round(value * 100) AS BIGINT) AS row_count FROM events)"""


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream read as run states: a user is a table, an event a state change."""
    status = (
        F.when(F.col("event_type") == "purchase", ledger.COMMITTED)
        .when(F.col("event_type") == "error", ledger.FAILED)
        .otherwise(ledger.STARTED)
    )
    return load(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("table-"), F.col("user_id").cast("string")).alias("table_name"),
        "ts",
        status.alias("status"),
        F.round(F.col("value") * 100).cast("bigint").alias("row_count"),
    )


@query(
    "run_ledger_latest",
    f"""WITH {LEDGER_SQL} SELECT table_name, count(*) AS entries, arg_max(status, (ts, event_id)) AS latest_status,
    arg_max(row_count, (ts, event_id)) FILTER (WHERE status = 'COMMITTED') AS committed_rows FROM ledger GROUP BY 1""",
)
def run_ledger_latest(spark, folder):
    return ledger.latest(_ledger(spark, folder), "table_name", "status", ["ts", "event_id"], "row_count")


@query(
    "run_totals",
    f"""WITH {LEDGER_SQL}, last AS (SELECT table_name, count(*) AS entries, arg_max(status, (ts, event_id)) AS latest_status,
    arg_max(row_count, (ts, event_id)) FILTER (WHERE status = 'COMMITTED') AS committed_rows FROM ledger GROUP BY 1)
    SELECT latest_status, count(*) AS tables, CAST(sum(committed_rows) AS BIGINT) AS row_total FROM last GROUP BY 1""",
)
def run_totals(spark, folder):
    last = ledger.latest(_ledger(spark, folder), "table_name", "status", ["ts", "event_id"], "row_count")
    return last.groupBy("latest_status").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("committed_rows").alias("row_total")
    )


@query(
    "quality_report",
    rule_sql("raw_orders", "typed_orders", TABLE_SQL + CONVERSION_SQL, RAW).replace(
        "SELECT 'raw_orders' AS table_name, rule_id", ", results AS (SELECT 'raw_orders' AS table_name, rule_id"
    )
    + """), body AS (SELECT table_name, max(total) AS total_rows, count(*) AS rules,
      count(*) FILTER (WHERE status = 'FAIL') AS failed, count(*) FILTER (WHERE status = 'WARN') AS warned,
      string_agg('{"rule_id":"' || rule_id || '","status":"' || status || '","violations":' || violations || '}', ',' ORDER BY rule_id)
        FILTER (WHERE violations > 0) AS violated FROM results GROUP BY 1)
    SELECT table_name, '{"run_id":"run-1","table":"' || table_name || '","status":"' || CASE WHEN failed > 0 THEN 'FAILED' ELSE 'SUCCESS' END
      || '","total_rows":' || total_rows || ',"rules":' || rules || ',"failed":' || failed || ',"warned":' || warned
      || ',"violated":[' || violated || ']}' AS report FROM body""",
)
def quality_report(spark, folder):
    rules = table_rules(i.RAW_ORDERS_SPEC) + conversion_rules(i.RAW_ORDERS_SPEC)
    return report_rows(evaluate(i.raw_orders(spark, folder), rules, "raw_orders"), "run-1")


PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "column_profile",
    f"WITH {i.ORDERS_NULLABLE_SQL}, "
    + "v AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM orders_nullable GROUP BY 2" for c in PROFILED
    )
    + """), m AS (SELECT column_name, CAST(sum(n) AS BIGINT) AS rows_, CAST(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS nulls,
      count(*) FILTER (WHERE value IS NOT NULL) AS distinct_, max(n) FILTER (WHERE value IS NOT NULL) AS top FROM v GROUP BY 1)
    SELECT 'orders' AS table_name, column_name, unnest(['rows', 'nulls', 'distinct', 'most_frequent']) AS metric,
      unnest([rows_, nulls, distinct_, top]) AS value FROM m""",
)
def column_profile(spark, folder):
    return profiling.column_profile(i.orders_nullable(spark, folder), "orders", PROFILED)
