"""Registered queries: keys, grain, references and domains."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from grainline.operators import key_search, keys, profiling, references, scorecard
from grainline.plans import inputs as i
from grainline.plans.registry import query
from grainline.session import load

NULLABLE = f"WITH {i.ORDERS_NULLABLE_SQL}"


def key_profile_sql(source: str, columns: list[str]) -> str:
    on = ", ".join(columns)
    filled = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"""SELECT '{"+".join(columns)}' AS key_columns, CAST(sum(n) AS BIGINT) AS total_rows,
      CAST(coalesce(sum(n) FILTER (WHERE NOT ok), 0) AS BIGINT) AS null_rows, count(*) FILTER (WHERE ok) AS distinct_keys,
      CAST(coalesce(sum(n - 1) FILTER (WHERE ok AND n > 1), 0) AS BIGINT) AS surplus_rows,
      count(*) FILTER (WHERE ok AND n > 1) AS duplicated_keys,
      CAST(coalesce(sum(n) FILTER (WHERE ok AND n > 1), 0) AS BIGINT) AS rows_in_duplicates,
      count(*) FILTER (WHERE NOT ok OR n > 1) = 0 AS is_key
      FROM (SELECT {on}, count(*) AS n, ({filled}) AS ok FROM {source} GROUP BY {on})"""


LINE_KEY = ["l_orderkey", "l_linenumber"]


@query(
    "pk_profile",
    NULLABLE + " " + " UNION ALL ".join([
        key_profile_sql("orders_nullable", ["o_orderkey"]),
        key_profile_sql("orders_nullable", ["o_custkey"]),
        key_profile_sql("lineitem", LINE_KEY),
        key_profile_sql("part", ["p_name"]),
    ]),
)
def pk_profile(spark, folder):
    orders = i.orders_nullable(spark, folder)
    found = [
        keys.key_profile(orders, ["o_orderkey"]),
        keys.key_profile(orders, ["o_custkey"]),
        keys.key_profile(load(spark, folder, "lineitem"), LINE_KEY),
        keys.key_profile(load(spark, folder, "part"), ["p_name"]),
    ]
    return scorecard.scorecard(found)


@query(
    "pk_null_breakdown",
    f"""{NULLABLE} SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, count(*) AS null_count
    FROM orders_nullable WHERE o_custkey IS NULL GROUP BY 1, 2""",
)
def pk_null_breakdown(spark, folder):
    rows = i.orders_nullable(spark, folder).select(
        "o_custkey", F.date_format("o_orderdate", "yyyy").alias("year"), F.date_format("o_orderdate", "MM").alias("month")
    )
    return keys.null_key_breakdown(rows, ["o_custkey"], ["year", "month"])


@query(
    "composite_pk_nulls",
    f"""{NULLABLE} SELECT count(*) AS total_rows, count(*) FILTER (WHERE o_custkey IS NULL) AS o_custkey_nulls,
    count(*) FILTER (WHERE o_orderpriority IS NULL) AS o_orderpriority_nulls,
    count(*) FILTER (WHERE o_custkey IS NULL OR o_orderpriority IS NULL) AS null_key_rows FROM orders_nullable""",
)
def composite_pk_nulls(spark, folder):
    return keys.composite_nulls(i.orders_nullable(spark, folder), ["o_custkey", "o_orderpriority"])


DUPES = "SELECT l_orderkey, l_linenumber, count(*) AS occurrence_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"


@query("duplicate_keys", DUPES)
def duplicate_keys(spark, folder):
    return keys.duplicate_keys(load(spark, folder, "lineitem"), LINE_KEY)


@query(
    "duplicate_rows",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
    WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM ({DUPES}))""",
)
def duplicate_rows(spark, folder):
    rows = load(spark, folder, "lineitem").select(*LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return keys.duplicate_rows(rows, LINE_KEY)


@query(
    "duplicate_distribution",
    f"SELECT occurrence_count, count(*) AS key_count FROM ({DUPES}) GROUP BY 1 ORDER BY 1",
)
def duplicate_distribution(spark, folder):
    return keys.duplicate_distribution(load(spark, folder, "lineitem"), LINE_KEY).orderBy("occurrence_count")


DEFINITION = ["p_name", "p_brand", "p_type"]


@query(
    "duplicate_definitions",
    """SELECT p_name, p_brand, p_type, count(*) AS row_count FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1
    ORDER BY row_count DESC, p_name, p_brand, p_type LIMIT 10""",
)
def duplicate_definitions(spark, folder):
    return keys.duplicate_definitions(load(spark, folder, "part"), DEFINITION)


@query(
    "duplicate_definition_rows",
    """SELECT p_name, p_brand, p_type, p_partkey, p_retailprice FROM part WHERE (p_name, p_brand, p_type) IN
    (SELECT (p_name, p_brand, p_type) FROM part GROUP BY p_name, p_brand, p_type HAVING count(*) > 1)""",
)
def duplicate_definition_rows(spark, folder):
    rows = load(spark, folder, "part").select(*DEFINITION, "p_partkey", "p_retailprice")
    return keys.duplicate_rows(rows, DEFINITION)


@query(
    "candidate_keys",
    NULLABLE + " " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(DISTINCT {c}) AS distinct_values,
        count(*) FILTER (WHERE {c} IS NULL) AS null_rows, round(count(DISTINCT {c})::DOUBLE / count(*), 4) AS unique_ratio
        FROM orders_nullable""" for c in ("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    ),
)
def candidate_keys(spark, folder):
    return keys.candidate_keys(
        i.orders_nullable(spark, folder), ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]
    )


@query(
    "composite_distinct",
    f"{NULLABLE} SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders_nullable)",
)
def composite_distinct(spark, folder):
    return keys.composite_distinct(i.orders_nullable(spark, folder), ["o_custkey", "o_orderdate"])


@query(
    "composite_grain",
    """SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
    count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS surplus_rows FROM lineitem""",
)
def composite_grain(spark, folder):
    return keys.repeated_rows(load(spark, folder, "lineitem"), LINE_KEY)


@query(
    "repeated_rows_with_nulls",
    f"""{NULLABLE} SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n) - count(*) AS BIGINT) AS surplus_rows
    FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders_nullable GROUP BY 1, 2)""",
)
def repeated_rows_with_nulls(spark, folder):
    """Rows beyond the first of each key, where keys have NULLs."""
    return keys.repeated_rows(i.orders_nullable(spark, folder), ["o_custkey", "o_orderpriority"])


@query(
    "rows_per_value",
    f"""{NULLABLE} SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS distinct_values,
    round(count(*)::DOUBLE / count(DISTINCT o_custkey), 4) AS avg_rows FROM orders_nullable""",
)
def rows_per_value(spark, folder):
    return keys.rows_per_value(i.orders_nullable(spark, folder), "o_custkey")


def _rows_per_key_sql(source: str, key: str) -> str:
    return f"""SELECT '{source}.{key}' AS grain, count(*) AS key_count, min(n) AS min_rows, max(n) AS max_rows,
      round(CAST(sum(n) AS BIGINT)::DOUBLE / count(*), 4) AS avg_rows
      FROM (SELECT {key}, count(*) AS n FROM {source} WHERE {key} IS NOT NULL GROUP BY 1)"""


GRAINS = [("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("part", "p_name"), ("conversations", "conv_id")]


@query("rows_per_key", " UNION ALL ".join(_rows_per_key_sql(t, k) for t, k in GRAINS))
def rows_per_key(spark, folder):
    return scorecard.scorecard([
        keys.rows_per_key(load(spark, folder, t), [k]).select(F.lit(f"{t}.{k}").alias("grain"), "*") for t, k in GRAINS
    ])


@query(
    "statuses_per_key",
    """WITH s AS (SELECT l_orderkey, count(DISTINCT l_returnflag) AS d FROM lineitem GROUP BY 1)
    SELECT 'statuses' AS column_name, count(*) AS count, round(avg(d), 4) AS mean, round(stddev_samp(d), 4) AS std,
    min(d)::DOUBLE AS min, quantile_cont(d, 0.25)::DOUBLE AS q25, quantile_cont(d, 0.5)::DOUBLE AS q50,
    quantile_cont(d, 0.75)::DOUBLE AS q75, max(d)::DOUBLE AS max FROM s""",
)
def statuses_per_key(spark, folder):
    from grainline.operators.quantiles import describe

    per_key = keys.distinct_per_key(load(spark, folder, "lineitem"), "l_orderkey", "l_returnflag")
    # the description works on the few distinct counts, weighted by their keys
    weights = per_key.groupBy(F.col("distinct_values").alias("statuses")).agg(F.count(F.lit(1)).alias("w"))
    return describe(weights, ["statuses"], weight="w")


@query(
    "repeated_pairs",
    "SELECT l_orderkey, l_returnflag, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def repeated_pairs(spark, folder):
    return keys.repeated_pairs(load(spark, folder, "lineitem"), ["l_orderkey", "l_returnflag"])


# --- references --------------------------------------------------------------------

# child, column, parent, parent column, optional
EDGES = [
    ("orders_broken", "o_custkey", "customer", "c_custkey", False),
    ("lineitem_broken", "l_partkey", "part", "p_partkey", False),
    ("lineitem_broken", "l_orderkey", "orders", "o_orderkey", False),
    ("lineitem_broken", "l_suppkey", "supplier", "s_suppkey", False),
    ("customer", "c_nationkey", "nation", "n_nationkey", False),
    ("supplier", "s_nationkey", "nation", "n_nationkey", False),
    ("nation", "n_regionkey", "region", "r_regionkey", False),
    ("events", "user_id", "customer", "c_custkey", False),
    ("documents", "doc_id", "labels", "doc_id", False),
]
OPTIONAL_EDGES = [("orders_broken", "o_custkey", "customer", "c_custkey", True)]
BROKEN = f"WITH {i.BROKEN_SQL}"
DERIVED = {"orders_broken": i.orders_broken, "lineitem_broken": i.lineitem_broken}


def _table(spark, folder, name):
    return DERIVED[name](spark, folder) if name in DERIVED else load(spark, folder, name)


def _edge_sql(child, column, parent, parent_column, optional):
    rows = f"SELECT * FROM {child} WHERE {column} IS NOT NULL" if optional else f"SELECT * FROM {child}"
    found = f"count(*) FILTER (WHERE {column} IN (SELECT {parent_column} FROM {parent}))"
    return f"""SELECT '{child}.{column}->{parent}.{parent_column}' AS reference, count(*) AS checked_rows,
      count(*) - {found} AS orphan_rows, round(100::DOUBLE * {found} / count(*), 4) AS overlap_pct FROM ({rows})"""


def _edges(spark, folder, edges):
    """One scan per child table, whatever the number of its keys."""
    children = list(dict.fromkeys(e[0] for e in edges))
    return scorecard.scorecard([
        references.reference_checks(_table(spark, folder, child), [
            (f"{c}.{column}->{parent}.{pc}", column, _table(spark, folder, parent), pc, optional)
            for c, column, parent, pc, optional in edges if c == child
        ])
        for child in children
    ])


@query("fk_overlap_pct", f"{BROKEN} " + " UNION ALL ".join(_edge_sql(*e) for e in EDGES))
def fk_overlap_pct(spark, folder):
    return _edges(spark, folder, EDGES)


@query(
    "fk_orphans",
    f"""{BROKEN} SELECT o_orderkey, o_custkey, o_orderdate FROM orders_broken
    WHERE o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def fk_orphans(spark, folder):
    rows = i.orders_broken(spark, folder).select("o_orderkey", "o_custkey", "o_orderdate")
    return references.orphan_rows(rows, "o_custkey", load(spark, folder, "customer"), "c_custkey")


@query(
    "fk_orphans_conditional",
    f"""{BROKEN} SELECT o_orderkey, o_custkey, o_orderdate FROM orders_broken
    WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def fk_orphans_conditional(spark, folder):
    rows = i.orders_broken(spark, folder).select("o_orderkey", "o_custkey", "o_orderdate")
    return references.orphan_rows(rows, "o_custkey", load(spark, folder, "customer"), "c_custkey", optional=True)


@query(
    "fk_orphans_by_reference",
    f"{BROKEN} " + " UNION ALL ".join(_edge_sql(*e) for e in OPTIONAL_EDGES),
)
def fk_orphans_by_reference(spark, folder):
    return _edges(spark, folder, OPTIONAL_EDGES)


@query(
    "parents_without_children",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def parents_without_children(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return references.unreferenced(orders, "o_orderkey", load(spark, folder, "lineitem"), "l_orderkey")


@query(
    "unexpected_domain_values",
    """SELECT 'p_type' AS column_name, p_type AS value, count(*) AS row_count FROM part
    WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE') GROUP BY 2
    UNION ALL SELECT 'event_type', event_type, count(*) FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 2
    UNION ALL SELECT 'role', role, count(*) FROM conversations WHERE role NOT IN ('user', 'assistant') GROUP BY 2""",
)
def unexpected_domain_values(spark, folder):
    domains = [
        ("part", "p_type", ["ECONOMY", "SMALL", "LARGE"]),
        ("events", "event_type", ["view", "click", "purchase"]),
        ("conversations", "role", ["user", "assistant"]),
    ]
    return scorecard.scorecard([
        references.unexpected_values(load(spark, folder, t), c, values).select(
            F.lit(c).alias("column_name"), F.col(c).alias("value"), "row_count"
        )
        for t, c, values in domains
    ])


# --- customer to plant mapping --------------------------------------------------------

PLANTS = f"WITH {i.CUSTOMER_PLANTS_SQL}"


@query(
    "exactly_one_flag",
    f"""{PLANTS}, n AS (SELECT c_custkey, count(customer_id) AS n FROM customer
      LEFT JOIN customer_plants ON customer_id = c_custkey AND priority_flag = 'PRIMARY' GROUP BY 1)
    SELECT count(*) AS keys, count(*) FILTER (WHERE n = 0) AS without, count(*) FILTER (WHERE n = 1) AS exactly_one,
    count(*) FILTER (WHERE n > 1) AS more_than_one FROM n""",
)
def exactly_one_flag(spark, folder):
    return keys.exactly_one(
        load(spark, folder, "customer"), "c_custkey", i.customer_plants(spark, folder), "customer_id",
        F.col("priority_flag") == "PRIMARY",
    )


@query(
    "exactly_one_main_plant",
    f"""{PLANTS}, n AS (SELECT c_custkey, count(customer_id) AS n FROM customer
      LEFT JOIN customer_plants ON customer_id = c_custkey AND order_lines >= 3 GROUP BY 1)
    SELECT count(*) AS keys, count(*) FILTER (WHERE n = 0) AS without, count(*) FILTER (WHERE n = 1) AS exactly_one,
    count(*) FILTER (WHERE n > 1) AS more_than_one FROM n""",
)
def exactly_one_main_plant(spark, folder):
    """A plant that serves many lines of a customer; some customers have none, some several."""
    return keys.exactly_one(
        load(spark, folder, "customer"), "c_custkey", i.customer_plants(spark, folder), "customer_id", F.col("order_lines") >= 3
    )


@query(
    "flag_coverage",
    f"""{PLANTS} SELECT count(DISTINCT customer_id) AS all_keys,
    count(DISTINCT customer_id) FILTER (WHERE priority_flag = 'PRIMARY') AS primary_keys,
    count(DISTINCT customer_id) FILTER (WHERE priority_flag = 'SECONDARY') AS secondary_keys,
    count(DISTINCT customer_id) FILTER (WHERE priority_flag = 'BACKUP') AS backup_keys FROM customer_plants""",
)
def flag_coverage(spark, folder):
    return keys.flag_coverage(
        i.customer_plants(spark, folder), "customer_id", "priority_flag", ["PRIMARY", "SECONDARY", "BACKUP"]
    )


@query(
    "value_counts_with_null",
    f"{PLANTS} SELECT priority_flag, count(*) AS row_count FROM customer_plants GROUP BY 1",
)
def value_counts_with_null(spark, folder):
    return profiling.value_counts(i.customer_plants(spark, folder), ["priority_flag"], keep_null=True)


@query(
    "join_fanout",
    """WITH l AS (SELECT p_name, count(*) AS left_rows FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
    r AS (SELECT p_name, count(*) AS right_rows FROM part GROUP BY 1)
    SELECT CAST(sum(left_rows) AS BIGINT) AS left_rows, CAST(sum(left_rows * right_rows) AS BIGINT) AS joined_rows,
    max(right_rows) AS max_matches, round(CAST(sum(left_rows * right_rows) AS BIGINT)::DOUBLE / CAST(sum(left_rows) AS BIGINT), 4) AS fanout_factor
    FROM l JOIN r USING (p_name)""",
)
def join_fanout(spark, folder):
    part = load(spark, folder, "part").select("p_partkey", "p_name")
    per_part = load(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    left = per_part.join(part, "p_partkey").groupBy("p_name").agg(F.sum("n").alias("left_rows"))
    right = part.groupBy("p_name").agg(F.count(F.lit(1)).alias("right_rows"))
    return keys.fanout_from_counts(left, right, "p_name")


KEY_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"]
_SETS = [s for n in (1, 2, 3) for s in combinations(KEY_COLUMNS, n)]


@query(
    "minimal_keys",
    "WITH k AS (" + " UNION ALL ".join(
        f"SELECT '{'+'.join(s)}' AS key_columns, {len(s)} AS size, {list(s)} AS cols, count(*) = count(DISTINCT ({', '.join(s)})) AS is_key FROM lineitem"
        for s in _SETS
    ) + """) SELECT key_columns, size FROM k WHERE is_key AND NOT EXISTS (SELECT 1 FROM k p WHERE p.is_key AND p.size < k.size AND list_has_all(k.cols, p.cols))""",
)
def minimal_keys(spark, folder):
    """All minimal keys of the order lines up to three columns."""
    return key_search.minimal_keys(load(spark, folder, "lineitem"), KEY_COLUMNS, 3)
