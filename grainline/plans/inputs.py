"""Inputs the registered queries derive from the given tables, in Spark and in SQL.

They give the order, ledger and mapping tables of the model their roles on the given data:
whole tables, with messy text, missing values and broken rules derived row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.session import load
from grainline.spec import TableSpec, date, enum, flag, key, money, text, whole

# --- raw_orders: orders as messy text ------------------------------------------------

RAW_ORDERS_SPEC = TableSpec(
    "raw_orders", "fact", ("order_id",),
    key("order_id")
    + whole("customer_id", limit_pct=0.0)
    + date("order_date", nullable=False)
    + money("price")
    + enum("status", "F", "O", "P")
    + text("priority")
    + whole("order_year", bounds=(1996, 2000))
    + flag("is_urgent", "yes_no")
    + flag("is_large", "zero_one")
    + flag("is_open", "true_false"),
    critical_date="order_date",
)


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = load(spark, folder, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    iso = F.date_format(d, "yyyy-MM-dd")
    day = (
        F.when(k % 6 == 0, iso)
        .when(k % 6 == 1, F.date_format(d, "dd-MM-yyyy"))
        .when(k % 6 == 2, F.date_format(d, "yyyy/MM/dd"))
        .when(k % 6 == 3, F.concat(iso, F.lit("T00:00:00")))
        .when(k % 6 == 4, F.lit("N/A-bad-date"))
        .otherwise(F.lit("  "))
    )
    return o.select(
        k.cast("string").alias("order_id"),
        F.when(k % 13 == 0, F.lit("")).when(k % 7 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .when(k % 17 == 0, F.lit("12x")).otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string"))).alias("customer_id"),
        day.alias("order_date"),
        F.when(k % 19 == 0, F.lit("free")).otherwise(F.format_number("o_totalprice", 2)).alias("price"),
        F.when(k % 11 == 0, F.lit("X")).otherwise(F.concat(F.lit("  "), F.lower("o_orderstatus"), F.lit(" "))).alias("status"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" "))).alias("priority"),
        F.year(d).cast("string").alias("order_year"),
        F.when(k % 3 == 0, F.lit("yes")).when(k % 3 == 1, F.lit(" No ")).otherwise(F.lit("maybe")).alias("is_urgent"),
        F.when(k % 4 == 0, F.lit("1")).when(k % 4 == 1, F.lit("0")).when(k % 4 == 2, F.lit("7")).alias("is_large"),
        F.when(k % 5 == 0, F.lit("true")).when(k % 5 == 1, F.lit(" FALSE")).otherwise(F.lit("?")).alias("is_open"),
    )


RAW_ORDERS_SQL = """raw_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN CAST(o_custkey AS VARCHAR) || '.0'
         WHEN o_orderkey % 17 = 0 THEN '12x' ELSE ' ' || CAST(o_custkey AS VARCHAR) END AS customer_id,
    CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y')
         WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00'
         WHEN 4 THEN 'N/A-bad-date' ELSE '  ' END AS order_date,
    CASE WHEN o_orderkey % 19 = 0 THEN 'free' ELSE format('{:,.2f}', o_totalprice) END AS price,
    CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE '  ' || lower(o_orderstatus) || ' ' END AS status,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '  ' ELSE ' ' || o_orderpriority || ' ' END AS priority,
    CAST(year(o_orderdate) AS VARCHAR) AS order_year,
    CASE o_orderkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN ' No ' ELSE 'maybe' END AS is_urgent,
    CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '7' END AS is_large,
    CASE o_orderkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN ' FALSE' ELSE '?' END AS is_open
  FROM orders),
clean_orders AS (
  SELECT *, nullif(trim(customer_id), '') AS customer_text,
    nullif(replace(trim(price), ',', ''), '') AS price_text,
    nullif(trim(priority), '') AS priority_text, nullif(trim(status), '') AS status_text,
    nullif(split_part(trim(order_date), 'T', 1), '') AS date_text,
    CASE WHEN length(trim(order_date)) >= 8 THEN split_part(trim(order_date), 'T', 1) END AS date_text8
  FROM raw_orders),
typed_orders AS (
  SELECT *,
    CASE WHEN regexp_full_match(customer_text, '[+-]?[0-9]+(\\.0+)?') THEN CAST(CAST(customer_text AS DECIMAL(20,4)) AS INTEGER) END AS customer_int,
    TRY_CAST(price_text AS DECIMAL(18,2)) AS price_dec,
    coalesce(CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE), CAST(try_strptime(date_text, '%d-%m-%Y') AS DATE)) AS date2,
    coalesce(CAST(try_strptime(date_text8, '%Y-%m-%d') AS DATE), CAST(try_strptime(date_text8, '%d-%m-%Y') AS DATE),
             CAST(try_strptime(date_text8, '%Y/%m/%d') AS DATE)) AS date3,
    CASE WHEN upper(trim(status)) IN ('F', 'O', 'P') THEN upper(trim(status)) END AS status_canon,
    CAST(order_year AS INTEGER) AS year_int,
    CASE WHEN CAST(order_year AS INTEGER) BETWEEN 1996 AND 2000 THEN CAST(order_year AS INTEGER) END AS year_ok,
    CASE upper(trim(is_urgent)) WHEN 'YES' THEN true WHEN 'NO' THEN false END AS urgent_flag,
    CASE trim(is_large) WHEN '1' THEN true WHEN '0' THEN false END AS large_flag,
    CASE upper(trim(is_open)) WHEN 'TRUE' THEN true WHEN 'FALSE' THEN false END AS open_flag
  FROM clean_orders)"""


# --- orders with missing values ------------------------------------------------------


def orders_nullable(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
    )


ORDERS_NULLABLE_SQL = """orders_nullable AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice,
    CAST(o_orderdate AS DATE) AS o_orderdate, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
  FROM orders)"""


# --- children with broken keys: some keys point outside their parent, no row is left out ---


def orders_broken(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_custkey")
    return orders_nullable(spark, folder).withColumn("o_custkey", F.when(key % 5 == 1, key + 10**12).otherwise(key))


def lineitem_broken(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("l_partkey")
    return load(spark, folder, "lineitem").withColumn("l_partkey", F.when(key % 5 == 0, key + 10**12).otherwise(key))


BROKEN_SQL = f"""{ORDERS_NULLABLE_SQL}, orders_broken AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 5 = 1 THEN o_custkey + 1000000000000 ELSE o_custkey END AS o_custkey, o_orderdate FROM orders_nullable),
lineitem_broken AS (SELECT l_orderkey, l_suppkey, CASE WHEN l_partkey % 5 = 0 THEN l_partkey + 1000000000000 ELSE l_partkey END AS l_partkey FROM lineitem)"""


# --- order lines as lifecycle events --------------------------------------------------


def _line_columns() -> list:
    qty = F.col("l_quantity").cast("int")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    status = (
        F.when((rf == "N") & (ls == "O"), "Ordered")
        .when((rf == "N") & (ls == "F"), "Delivered")
        .when((rf == "A") & (ls == "O"), "Delivered")
        .when((rf == "A") & (ls == "F"), "Invoiced")
        .when((rf == "R") & (ls == "O"), "Cancelled")
        .otherwise("Returned")
    )
    return [
        F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        status.alias("line_status"),
        qty.alias("order_qty"),
    ]


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with delivered and invoiced quantities, prices and a batch link. No join."""
    li = load(spark, folder, "lineitem")
    tax, disc = F.col("l_tax"), F.col("l_discount")
    s, q = F.col("line_status"), F.col("order_qty")
    net = F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(5,2)"))
    base = li.select(
        *_line_columns(), tax.alias("tax"), disc.alias("disc"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("order_price"),
        net.cast("decimal(18,2)").alias("net_amount"),
        (F.col("l_tax").cast("decimal(5,2)") * 100).cast("decimal(5,2)").alias("gst_rate"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )
    delivered = (
        F.when(s == "Ordered", F.when(F.col("disc") > 0.08, q).otherwise(F.lit(0)))
        .when(s == "Cancelled", F.lit(None).cast("int"))
        .when(s == "Returned", -q)
        .when(F.col("tax") > 0.06, q + 1)
        .when((s == "Delivered") & (F.col("disc") < 0.01), F.lit(0))
        .otherwise(q)
    )
    invoiced = (
        F.when(s == "Invoiced", F.when(F.col("tax") < 0.02, q + 2).otherwise(q))
        .when(s == "Returned", -q)
        .when(s == "Cancelled", F.lit(None).cast("int"))
        .otherwise(F.lit(0))
    )
    gst = (F.col("net_amount") * F.col("gst_rate") / 100).cast("decimal(18,2)")
    lines = base.select("*", delivered.alias("delivery_qty"), invoiced.alias("invoice_qty"), gst.alias("_gst"))
    wrong_gst = (F.col("_gst") + F.col("line_no")).cast("decimal(18,2)")
    return lines.select(
        "order_no", "line_no", "product_id", "supplier_id", "line_status", "order_qty", "delivery_qty", "invoice_qty",
        "order_price", "net_amount", "gst_rate", "ship_date",
        F.when(F.col("line_no") == 7, wrong_gst).otherwise(F.col("_gst")).alias("gst_amount"),
        F.when(F.col("line_no") == 5, F.lit(None)).otherwise((F.col("net_amount") + F.col("_gst")).cast("decimal(18,2)")).alias("total_amount"),
        F.when((F.col("delivery_qty") > 0) & (F.col("disc") != 0.05) | (F.col("tax") == 0.01),
               F.concat_ws("-", "product_id", "supplier_id")).alias("batch_id"),
        F.when(s == "Cancelled", F.concat(F.lit("cancel-"), F.col("line_no"))).alias("cancel_reason"),
        F.when(s == "Returned", F.concat(F.lit("return-"), F.col("line_no"))).alias("return_reason"),
    )


ORDER_LINES_SQL = """line_base AS (
  SELECT l_orderkey AS order_no, l_linenumber AS line_no, l_partkey AS product_id, l_suppkey AS supplier_id,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Ordered' WHEN l_returnflag = 'N' THEN 'Delivered'
         WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Delivered' WHEN l_returnflag = 'A' THEN 'Invoiced'
         WHEN l_linestatus = 'O' THEN 'Cancelled' ELSE 'Returned' END AS line_status,
    CAST(l_quantity AS INTEGER) AS order_qty, l_tax AS tax, l_discount AS disc,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS order_price,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))) AS DECIMAL(18,2)) AS net_amount,
    CAST(CAST(l_tax AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS gst_rate, CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem),
line_qty AS (
  SELECT *,
    CASE WHEN line_status = 'Ordered' THEN CASE WHEN disc > 0.08::DOUBLE THEN order_qty ELSE 0 END
         WHEN line_status = 'Cancelled' THEN NULL WHEN line_status = 'Returned' THEN -order_qty
         WHEN tax > 0.06::DOUBLE THEN order_qty + 1
         WHEN line_status = 'Delivered' AND disc < 0.01::DOUBLE THEN 0 ELSE order_qty END AS delivery_qty,
    CASE WHEN line_status = 'Invoiced' THEN CASE WHEN tax < 0.02::DOUBLE THEN order_qty + 2 ELSE order_qty END
         WHEN line_status = 'Returned' THEN -order_qty WHEN line_status = 'Cancelled' THEN NULL ELSE 0 END AS invoice_qty,
    CAST(round(net_amount * gst_rate * 0.01, 2) AS DECIMAL(18,2)) AS gst
  FROM line_base),
order_lines AS (
  SELECT order_no, line_no, product_id, supplier_id, line_status, order_qty, delivery_qty, invoice_qty, order_price,
    net_amount, gst_rate, ship_date,
    CASE WHEN line_no = 7 THEN CAST(gst + line_no AS DECIMAL(18,2)) ELSE gst END AS gst_amount,
    CASE WHEN line_no <> 5 THEN CAST(net_amount + gst AS DECIMAL(18,2)) END AS total_amount,
    CASE WHEN (delivery_qty > 0 AND disc <> 0.05::DOUBLE) OR tax = 0.01::DOUBLE
         THEN CAST(product_id AS VARCHAR) || '-' || CAST(supplier_id AS VARCHAR) END AS batch_id,
    CASE WHEN line_status = 'Cancelled' THEN 'cancel-' || line_no END AS cancel_reason,
    CASE WHEN line_status = 'Returned' THEN 'return-' || line_no END AS return_reason
  FROM line_qty)"""


def line_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with order, delivery and invoice dates; dates missing by lifecycle stage."""
    o = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_no"), F.col("o_orderdate").cast("date").alias("order_date")
    )
    li = load(spark, folder, "lineitem").select(*_line_columns(), F.col("l_shipdate").cast("date").alias("ship_date"))
    s = F.col("line_status")
    shipped = ~s.isin("Ordered", "Cancelled")
    billed = s.isin("Invoiced", "Returned")
    return li.join(o, "order_no").select(
        "order_no", "line_no", "product_id", "supplier_id", "line_status", "order_qty", "order_date",
        F.when(shipped, F.col("ship_date")).alias("delivery_date"),
        F.when(billed, F.date_add("ship_date", F.col("line_no") * 3 - 8)).alias("invoice_date"),
        F.when(s == "Returned", F.concat(F.lit("return-"), F.col("line_no"))).alias("return_reason"),
    )


LINE_DATES_SQL = ORDER_LINES_SQL + """,
line_dates AS (
  SELECT order_no, line_no, product_id, supplier_id, line_status, order_qty, CAST(o_orderdate AS DATE) AS order_date,
    CASE WHEN line_status NOT IN ('Ordered', 'Cancelled') THEN ship_date END AS delivery_date,
    CASE WHEN line_status IN ('Invoiced', 'Returned') THEN ship_date + (line_no * 3 - 8) END AS invoice_date,
    return_reason
  FROM order_lines JOIN orders ON o_orderkey = order_no)"""


# --- movements: one per line, supplier nation to customer nation ----------------------


def moves(spark: SparkSession, folder: str) -> DataFrame:
    li = load(spark, folder, "lineitem")
    o = load(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = load(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    s = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = li.join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey")
    inbound = F.col("s_nationkey") == F.col("c_nationkey")
    broken = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
    return joined.select(
        F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("manufacturer_id"),
        F.when(inbound, "IN").otherwise("TRANSFER").alias("movement_type"),
        F.when(~inbound | broken, F.col("s_nationkey")).alias("from_plant_id"),
        F.when(inbound | ~broken, F.col("c_nationkey")).alias("to_plant_id"),
        F.col("l_quantity").cast("bigint").alias("units"),
        F.col("l_shipdate").cast("date").alias("movement_date"),
    )


MOVES_SQL = """moves AS (
  SELECT l_orderkey AS order_no, l_linenumber AS line_no, l_partkey AS product_id, l_suppkey AS manufacturer_id,
    CASE WHEN s_nationkey = c_nationkey THEN 'IN' ELSE 'TRANSFER' END AS movement_type,
    CASE WHEN s_nationkey <> c_nationkey OR (l_linenumber = 7 AND l_returnflag = 'R') THEN s_nationkey END AS from_plant_id,
    CASE WHEN s_nationkey = c_nationkey OR NOT (l_linenumber = 7 AND l_returnflag = 'R') THEN c_nationkey END AS to_plant_id,
    CAST(l_quantity AS BIGINT) AS units, CAST(l_shipdate AS DATE) AS movement_date
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey)"""


# --- customer to nation mapping with a priority ---------------------------------------


def customer_plants(spark: SparkSession, folder: str) -> DataFrame:
    """(customer_id, plant_id, order_lines, priority_flag): PRIMARY for the most lines, ties by plant.

    The link has at most one row per nation for a customer, which bounds the ranking window.
    """
    from pyspark.sql import Window

    li = load(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    o = load(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    s = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    pairs = (
        li.join(o, "l_orderkey").join(s, "l_suppkey")
        .groupBy(F.col("o_custkey").alias("customer_id"), F.col("s_nationkey").alias("plant_id"))
        .agg(F.count(F.lit(1)).alias("order_lines"))
    )
    place = F.row_number().over(Window.partitionBy("customer_id").orderBy(F.desc("order_lines"), "plant_id"))
    return pairs.select(
        "*", F.when(place == 1, "PRIMARY").when(place == 2, "SECONDARY").when(place == 3, "BACKUP").alias("priority_flag")
    )


CUSTOMER_PLANTS_SQL = """pairs AS (
  SELECT o_custkey AS customer_id, s_nationkey AS plant_id, count(*) AS order_lines
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2),
customer_plants AS (
  SELECT *, CASE row_number() OVER (PARTITION BY customer_id ORDER BY order_lines DESC, plant_id)
    WHEN 1 THEN 'PRIMARY' WHEN 2 THEN 'SECONDARY' WHEN 3 THEN 'BACKUP' END AS priority_flag FROM pairs)"""


# --- documents as files of a drop folder ----------------------------------------------


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as a file: path, MD5 and size of its text."""
    return load(spark, folder, "documents").select(
        F.concat(F.lit("facts/documents/lang="), "lang", F.lit("/"), "source", F.lit("/doc-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.md5("text").alias("md5"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
        "doc_id",
        "n_chars",
    )


def stored_files(spark: SparkSession, folder: str) -> DataFrame:
    """Etags already stored: the labelled documents; large ones as multipart, toxic ones outdated."""
    labels = load(spark, folder, "labels").select("doc_id", "toxic")
    files = document_files(spark, folder).join(labels, "doc_id")
    return files.select(
        "path",
        F.when(F.col("n_chars") > 2000, F.concat("md5", F.lit("-2")))
        .when(F.col("toxic") == 1, F.md5(F.concat("md5", F.lit("old"))))
        .otherwise(F.col("md5")).alias("etag"),
    )


FILES_SQL = """document_files AS (
  SELECT 'facts/documents/lang=' || lang || '/' || source || '/doc-' || doc_id || '.txt' AS path, md5(text) AS md5,
    CAST(strlen(text) AS BIGINT) AS size_bytes, doc_id, n_chars FROM documents),
stored_files AS (
  SELECT path, CASE WHEN n_chars > 2000 THEN md5 || '-2' WHEN toxic = 1 THEN md5(md5 || 'old') ELSE md5 END AS etag
  FROM document_files JOIN labels USING (doc_id)),
decisions AS (
  SELECT path, md5, size_bytes, etag,
    CASE WHEN etag IS NULL THEN 'file_not_exists' WHEN etag LIKE '%-%' THEN 'multipart_unverifiable'
         WHEN etag = md5 THEN 'checksum_match' ELSE 'mismatch' END AS reason,
    CASE WHEN etag IS NULL THEN 'success' WHEN etag LIKE '%-%' THEN 'skipped_unverifiable'
         WHEN etag = md5 THEN 'skipped' ELSE 'failed' END AS status,
    CASE WHEN etag IS NULL THEN 'none' WHEN etag LIKE '%-%' THEN 'unverifiable' ELSE 'md5' END AS verification
  FROM document_files LEFT JOIN stored_files USING (path))"""


# --- product texts with strengths -----------------------------------------------------


def products(spark: SparkSession, folder: str) -> DataFrame:
    p = load(spark, folder, "part")
    size = F.col("p_size").cast("string")
    strength = (
        F.when(F.col("p_size") % 5 == 0, F.concat(size, F.lit("mg/5ml")))
        .when(F.col("p_size") % 5 == 1, F.concat(size, F.lit(".5 MG")))
        .when(F.col("p_size") % 5 == 2, F.lit(" As Directed "))
        .when(F.col("p_size") % 5 == 3, size)
    )
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.concat_ws("-", F.split("p_name", " ")[0], "p_size").alias("product_code"),
        F.when(F.col("p_size") > 45, F.lit(None)).when(F.col("p_size") > 25, F.split("p_name", " ")[1])
        .otherwise(F.split("p_name", " ")[0]).alias("generic_code"),
        strength.alias("strength_value"),
        F.when(F.col("p_size") % 4 != 0, F.lit("mg")).alias("strength_unit"),
        F.col("p_size").alias("pack_count"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
    )


PRODUCTS_SQL = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS type,
    split_part(p_name, ' ', 1) || '-' || p_size AS product_code,
    CASE WHEN p_size > 45 THEN NULL WHEN p_size > 25 THEN split_part(p_name, ' ', 2) ELSE split_part(p_name, ' ', 1) END AS generic_code,
    CASE p_size % 5 WHEN 0 THEN p_size || 'mg/5ml' WHEN 1 THEN p_size || '.5 MG' WHEN 2 THEN ' As Directed '
         WHEN 3 THEN CAST(p_size AS VARCHAR) END AS strength_value,
    CASE WHEN p_size % 4 <> 0 THEN 'mg' END AS strength_unit, p_size AS pack_count,
    CAST(p_retailprice AS DECIMAL(18,2)) AS price
  FROM part)"""


# --- customers below customers: long chains, subtrees, cycles, parents that are not there ---


def customer_tree(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    parent = (
        F.when(k % 100 == 40, k).when(k % 500 == 250, k + 1).when(k % 400 == 399, k + 10**9).when(k % 1000 == 1, F.lit(None))
        .when(k % 37 > 1, k - 1).otherwise(F.nullif(F.expr("c_custkey div 37"), F.lit(0)))
    )
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    return load(spark, folder, "customer").select("c_custkey", parent.alias("parent_key"), cents.alias("balance"))


CUSTOMER_TREE_SQL = """customer_tree AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 100 = 40 THEN c_custkey WHEN c_custkey % 500 = 250 THEN c_custkey + 1
    WHEN c_custkey % 400 = 399 THEN c_custkey + 1000000000 WHEN c_custkey % 1000 = 1 THEN NULL
    WHEN c_custkey % 37 > 1 THEN c_custkey - 1 ELSE nullif(c_custkey // 37, 0) END AS parent, CAST(round(c_acctbal * 100) AS BIGINT) AS balance
  FROM customer),
placed AS (
  SELECT k AS node, k AS root, 0 AS depth, CAST(k AS VARCHAR) AS path, CASE WHEN parent IS NULL THEN 'root' ELSE 'orphan' END AS state
  FROM customer_tree WHERE parent IS NULL OR parent NOT IN (SELECT k FROM customer_tree)
  UNION ALL SELECT t.k, placed.root, placed.depth + 1, placed.path || '/' || t.k, 'below' FROM placed JOIN customer_tree t ON t.parent = placed.node)"""
