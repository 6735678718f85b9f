"""Registered queries: supply-chain analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainline.operators import flows, hierarchy, sequences, supply
from grainline.plans import inputs as i
from grainline.plans.registry import query
from grainline.session import load

MOVES = f"WITH {i.MOVES_SQL}"


@query(
    "batch_trace",
    """WITH l AS (SELECT * FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
      AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'),
    ord AS (SELECT DISTINCT l_orderkey FROM l), cust AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM ord))
    SELECT 'product' AS level, l_partkey AS entity FROM (SELECT DISTINCT l_partkey FROM l)
    UNION ALL SELECT 'order', l_orderkey FROM ord UNION ALL SELECT 'customer', o_custkey FROM cust
    UNION ALL SELECT 'plant', c_nationkey FROM (SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM cust))""",
)
def batch_trace(spark, folder):
    """Recall: manufacturers with a negative balance, shipped in 1997 -> products, orders, customers, plants."""
    recalled = load(spark, folder, "supplier").where("s_acctbal < 0").select("s_suppkey")
    shipped = load(spark, folder, "lineitem").where(
        "l_shipdate >= timestamp_ntz '1997-01-01' and l_shipdate < timestamp_ntz '1998-01-01'"
    )
    orders, customer = load(spark, folder, "orders"), load(spark, folder, "customer")
    customer = customer.select("c_custkey", F.col("c_nationkey").cast("bigint").alias("c_nationkey"))
    chain = [
        (shipped, "l_suppkey", "l_orderkey", "order"),
        (orders, "o_orderkey", "o_custkey", "customer"),
        (customer, "c_custkey", "c_nationkey", "plant"),
    ]
    products = [(shipped, "l_suppkey", "l_partkey", "product")]
    return supply.trace(recalled, products).unionByName(supply.trace(recalled, chain))


@query(
    "recall_chain",
    f"""{MOVES}, b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)),
    a AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem JOIN b USING (l_partkey, l_suppkey)),
    m AS (SELECT DISTINCT order_no, line_no, movement_type FROM moves JOIN a ON order_no = l_orderkey AND line_no = l_linenumber WHERE movement_type IS NOT NULL),
    o AS (SELECT DISTINCT moves.order_no FROM moves JOIN m USING (order_no, line_no, movement_type)),
    c AS (SELECT DISTINCT o_custkey FROM orders JOIN o ON order_no = o_orderkey)
    SELECT 'batch' AS level, l_partkey || '/' || l_suppkey AS entity FROM b UNION ALL SELECT 'allocation', l_orderkey || '/' || l_linenumber FROM a
    UNION ALL SELECT 'movement', order_no || '/' || line_no || '/' || movement_type FROM m
    UNION ALL SELECT 'order', CAST(order_no AS VARCHAR) FROM o UNION ALL SELECT 'customer', CAST(o_custkey AS VARCHAR) FROM c""",
)
def recall_chain(spark, folder):
    """The whole chain with composite keys: manufacturer, batch, allocation, movement, order, customer."""
    makers = load(spark, folder, "supplier").where("s_acctbal < 0").select("s_suppkey")
    lines, moves = load(spark, folder, "lineitem"), i.moves(spark, folder)
    chain = [
        (lines, "l_suppkey", ["l_partkey", "l_suppkey"], "batch"),
        (lines, ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"], "allocation"),
        (moves, ["order_no", "line_no"], ["order_no", "line_no", "movement_type"], "movement"),
        (moves, ["order_no", "line_no", "movement_type"], "order_no", "order"),
        (load(spark, folder, "orders"), "o_orderkey", "o_custkey", "customer"),
    ]
    return supply.trace(makers, chain)


STAGES = ("signup", "view", "click", "purchase")


@query(
    "order_lifecycle",
    "WITH f AS (SELECT user_id, count(*) AS event_count, CAST(min(ts) AS DATE) AS first_date, CAST(max(ts) AS DATE) AS last_date, "
    + ", ".join(f"min(CAST(ts AS DATE)) FILTER (WHERE event_type = '{s}') AS first_{s}" for s in STAGES)
    + " FROM events GROUP BY 1) SELECT *, "
    + ", ".join(f"CAST(date_diff('day', first_{a}, first_{b}) AS INTEGER) AS {a}_to_{b}_days" for a, b in zip(STAGES, STAGES[1:]))
    + " FROM f",
)
def order_lifecycle(spark, folder):
    events = load(spark, folder, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("day"))
    return supply.lifecycle(events, "user_id", "event_type", "day", list(STAGES))


ENTRIES_SQL = f"""{MOVES}, entries AS (
  SELECT order_no, line_no, product_id, movement_date, to_plant_id AS plant_id, units AS signed_units FROM moves WHERE to_plant_id IS NOT NULL
  UNION ALL SELECT order_no, line_no, product_id, movement_date, from_plant_id, -units FROM moves WHERE from_plant_id IS NOT NULL)"""


@query(
    "stock_balance",
    f"""{ENTRIES_SQL}, e AS (SELECT plant_id, product_id, movement_date, order_no * 8 + line_no AS entry_no,
      CAST(sum(signed_units) AS BIGINT) AS signed_units FROM entries GROUP BY 1, 2, 3, 4)
    SELECT *, CAST(sum(signed_units) OVER (PARTITION BY plant_id, product_id ORDER BY movement_date, entry_no
      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance FROM e""",
)
def stock_balance(spark, folder):
    """Balance after every ledger entry of a plant and product."""
    moves = i.moves(spark, folder)
    entries = supply.ledger_entries(moves, ["order_no", "line_no", "product_id", "movement_date"])
    # order lines repeat, so entries of the same line and day are one ledger entry
    merged = entries.groupBy(
        "plant_id", "product_id", "movement_date", (F.col("order_no") * 8 + F.col("line_no")).alias("entry_no")
    ).agg(F.sum("signed_units").alias("signed_units"))
    return supply.running_balance(merged, ["plant_id", "product_id"], "movement_date", "entry_no")


@query(
    "stock_balance_daily",
    f"""{ENTRIES_SQL}, e AS (SELECT plant_id, movement_date, CAST(sum(signed_units) AS BIGINT) AS net_units FROM entries GROUP BY 1, 2)
    SELECT *, CAST(sum(net_units) OVER (PARTITION BY plant_id ORDER BY movement_date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance FROM e""",
)
def stock_balance_daily(spark, folder):
    entries = supply.ledger_entries(i.moves(spark, folder), ["movement_date"])
    return supply.daily_balance(entries, ["plant_id"], "movement_date")


@query(
    "plan_vs_actual",
    """WITH p AS (SELECT l_partkey AS product_id, s_nationkey AS plant_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS planned_units
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2),
    a AS (SELECT l_partkey AS product_id, s_nationkey AS plant_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS actual_units
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_linestatus = 'F' GROUP BY 1, 2)
    SELECT product_id, plant_id, coalesce(planned_units, 0) AS planned_units, coalesce(actual_units, 0) AS actual_units,
    coalesce(actual_units, 0) - coalesce(planned_units, 0) AS difference FROM p FULL JOIN a USING (product_id, plant_id)""",
)
def plan_vs_actual(spark, folder):
    """Planned = all ordered units of a product and supplying plant, executed = the finished ones."""
    plants = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("plant_id"))
    lines = load(spark, folder, "lineitem").join(plants, "l_suppkey").select(
        F.col("l_partkey").alias("product_id"), "plant_id", F.col("l_quantity").cast("bigint").alias("units"), "l_linestatus"
    )
    return supply.plan_against_actual(lines, "units", lines.where("l_linestatus = 'F'"), "units", ["product_id", "plant_id"])


@query(
    "routing_share",
    f"""WITH {i.CUSTOMER_PLANTS_SQL}, served AS (SELECT o_custkey AS customer_id, s_nationkey AS plant_id, count(*) AS n
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2),
    f AS (SELECT coalesce(priority_flag, 'UNMAPPED') AS priority_flag, CAST(sum(n) AS BIGINT) AS order_count
      FROM served LEFT JOIN customer_plants USING (customer_id, plant_id) GROUP BY 1)
    SELECT *, round(100::DOUBLE * order_count / CAST(sum(order_count) OVER () AS BIGINT), 4) AS share_pct FROM f""",
)
def routing_share(spark, folder):
    """The mapping counts the lines of each customer and plant, which is what is to be shared out."""
    return supply.routing_totals(i.customer_plants(spark, folder), "priority_flag", "order_lines")


@query(
    "demand_vs_actual",
    """WITH a AS (SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS u FROM lineitem GROUP BY 1)
    SELECT p_partkey AS product_id, p_size * 10 AS target_units, coalesce(u, 0) AS actual_units,
    round(coalesce(u, 0)::DOUBLE / (p_size * 10), 4) AS ratio FROM part LEFT JOIN a ON l_partkey = p_partkey""",
)
def demand_vs_actual(spark, folder):
    demand = load(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), (F.col("p_size") * 10).alias("annual_target_units")
    )
    actual = load(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("bigint").alias("units")
    )
    return supply.demand_against_actual(demand, actual, "product_id", "annual_target_units", "units")


@query(
    "single_source",
    """SELECT l_orderkey, min(l_suppkey) AS only_source, count(*) AS link_count FROM lineitem GROUP BY 1
    HAVING count(DISTINCT l_suppkey) = 1""",
)
def single_source(spark, folder):
    return supply.single_source(load(spark, folder, "lineitem").select("l_orderkey", "l_suppkey"), "l_orderkey", "l_suppkey")


@query(
    "status_safe_totals",
    f"""WITH {i.ORDER_LINES_SQL} SELECT product_id,
    CAST(coalesce(sum(order_qty) FILTER (WHERE line_status = 'Ordered'), 0) AS BIGINT) AS ordered_units,
    CAST(coalesce(sum(delivery_qty) FILTER (WHERE line_status = 'Delivered'), 0) AS BIGINT) AS delivered_units,
    CAST(coalesce(sum(invoice_qty) FILTER (WHERE line_status = 'Invoiced'), 0) AS BIGINT) AS invoiced_units,
    CAST(coalesce(sum(delivery_qty) FILTER (WHERE line_status = 'Returned'), 0) AS BIGINT) AS returned_units
    FROM order_lines GROUP BY 1""",
)
def status_safe_totals(spark, folder):
    return supply.status_totals(
        i.order_lines(spark, folder), "line_status",
        {
            "ordered_units": ("Ordered", "order_qty"),
            "delivered_units": ("Delivered", "delivery_qty"),
            "invoiced_units": ("Invoiced", "invoice_qty"),
            "returned_units": ("Returned", "delivery_qty"),
        },
        ["product_id"],
    )


@query(
    "return_patterns",
    f"""WITH {i.LINE_DATES_SQL} SELECT coalesce(return_reason, 'none') AS reason, count(*) AS line_count,
    count(*) FILTER (WHERE line_status = 'Returned') AS return_count,
    round(100::DOUBLE * count(*) FILTER (WHERE line_status = 'Returned') / count(*), 4) AS return_pct,
    count(*) FILTER (WHERE line_status = 'Returned' AND invoice_date < delivery_date) AS early_credits FROM line_dates GROUP BY 1""",
)
def return_patterns(spark, folder):
    return supply.return_patterns(
        i.line_dates(spark, folder),
        F.coalesce(F.col("return_reason"), F.lit("none")),
        F.col("line_status") == "Returned",
        F.col("invoice_date") < F.col("delivery_date"),
    )


@query(
    "plant_hierarchy",
    """SELECT s_suppkey, s_nationkey, n_name, r_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def plant_hierarchy(spark, folder):
    """Two levels up: supplier site to nation to region."""
    nation = load(spark, folder, "nation")
    upper = supply.hierarchy(nation, "n_nationkey", "n_regionkey", load(spark, folder, "region"), "r_regionkey", ["r_name"])
    parents = nation.select("n_nationkey", "n_name").join(upper.select("n_nationkey", "r_name"), "n_nationkey")
    return supply.hierarchy(load(spark, folder, "supplier"), "s_suppkey", "s_nationkey", parents, "n_nationkey", ["n_name", "r_name"])


@query(
    "self_parent_hierarchy",
    """SELECT c.c_custkey, nullif(c.c_custkey // 10, 0) AS parent_key, p.c_name AS parent_name FROM customer c
    LEFT JOIN customer p ON p.c_custkey = nullif(c.c_custkey // 10, 0)""",
)
def self_parent_hierarchy(spark, folder):
    """Customers below other customers: the table is its own parent, roots have none."""
    cu = load(spark, folder, "customer").withColumn("parent_key", F.nullif(F.expr("c_custkey div 10"), F.lit(0)))
    up = cu.select("c_custkey", F.col("c_name").alias("parent_name"))
    return supply.hierarchy(cu, "c_custkey", "parent_key", up, "c_custkey", ["parent_name"])


@query(
    "date_dimension",
    """WITH b AS (SELECT least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem)) AS lo,
      greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) AS hi),
    d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
    SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
    CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, CAST(isodow(date) AS INTEGER) AS iso_weekday FROM d""",
)
def date_dimension(spark, folder):
    o = load(spark, folder, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    li = load(spark, folder, "lineitem").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    return supply.date_dimension(o.unionByName(li), ["a", "b"])


@query(
    "bridge_join",
    """SELECT l_partkey, l_suppkey, p_name, s_name, n FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2)
    JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
)
def bridge_join(spark, folder):
    bridge = load(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    part = load(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    supplier = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return supply.bridge_join(part, "l_partkey", bridge, supplier, "l_suppkey").select(
        "l_partkey", "l_suppkey", "p_name", "s_name", "n"
    )


@query(
    "role_playing_join",
    f"""{MOVES} SELECT f.n_name AS source_n_name, t.n_name AS target_n_name, count(*) AS move_count, CAST(sum(units) AS BIGINT) AS units
    FROM moves LEFT JOIN nation f ON f.n_nationkey = from_plant_id LEFT JOIN nation t ON t.n_nationkey = to_plant_id GROUP BY 1, 2""",
)
def role_playing_join(spark, folder):
    # moves are summed per pair of plants first, so the two dimension joins see few rows
    pairs = i.moves(spark, folder).groupBy("from_plant_id", "to_plant_id").agg(
        F.count(F.lit(1)).alias("move_count"), F.sum("units").alias("units")
    )
    named = supply.role_join(
        pairs, load(spark, folder, "nation"), "n_nationkey", {"from_plant_id": "source", "to_plant_id": "target"}, ["n_name"]
    )
    return named.groupBy("source_n_name", "target_n_name").agg(
        F.sum("move_count").alias("move_count"), F.sum("units").alias("units")
    )


@query(
    "hierarchy_paths",
    f"""WITH RECURSIVE {i.CUSTOMER_TREE_SQL},
    reach AS (SELECT k AS start, parent AS node FROM customer_tree WHERE k NOT IN (SELECT node FROM placed)
      UNION SELECT reach.start, t.parent FROM reach JOIN customer_tree t ON t.k = reach.node),
    ring AS (SELECT start FROM reach WHERE start = node),
    rings AS (SELECT start, min(node) AS root FROM reach WHERE node IN (SELECT start FROM ring) GROUP BY 1)
    SELECT node, root, depth, path, state FROM placed
    UNION ALL SELECT start, root, NULL, NULL, CASE WHEN start IN (SELECT start FROM ring) THEN 'cycle' ELSE 'circling' END FROM rings""",
)
def hierarchy_paths(spark, folder):
    """Root, depth and path of every customer of a tree of any depth; cycles as rows of their own."""
    return hierarchy.paths(i.customer_tree(spark, folder), "c_custkey", "parent_key")


@query(
    "hierarchy_subtrees",
    f"""WITH RECURSIVE {i.CUSTOMER_TREE_SQL},
    above AS (SELECT node AS ancestor, node, 0 AS distance FROM placed
      UNION ALL SELECT p.k, above.node, distance + 1 FROM above JOIN customer_tree t ON t.k = above.ancestor JOIN customer_tree p ON p.k = t.parent)
    SELECT ancestor AS node, count(*) AS subtree_nodes, max(distance) AS height, CAST(sum(balance) AS BIGINT) AS balance
    FROM above JOIN customer_tree t ON t.k = above.node GROUP BY 1""",
)
def hierarchy_subtrees(spark, folder):
    return hierarchy.subtree_totals(i.customer_tree(spark, folder), "c_custkey", "parent_key", {"balance": "balance"})


@query(
    "fifo_consumption",
    """WITH lines AS (SELECT l_partkey AS product_id, s_nationkey AS plant_id, l_orderkey * 8 + l_linenumber AS id, CAST(l_shipdate AS DATE) AS day,
      l_returnflag, l_linestatus, CAST(l_quantity AS BIGINT) AS units FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
    s AS (SELECT product_id, plant_id, id, sum(units) AS units, sum(sum(units)) OVER (PARTITION BY product_id, plant_id ORDER BY day, id) AS high
      FROM lines WHERE l_returnflag <> 'R' GROUP BY product_id, plant_id, day, id),
    u AS (SELECT product_id, plant_id, id, sum(units) AS units, sum(sum(units)) OVER (PARTITION BY product_id, plant_id ORDER BY id, day) AS high
      FROM lines WHERE l_linestatus = 'F' GROUP BY product_id, plant_id, day, id),
    st AS (SELECT product_id, plant_id, max(high) AS total FROM s GROUP BY 1, 2), ut AS (SELECT product_id, plant_id, max(high) AS total FROM u GROUP BY 1, 2),
    m AS (SELECT s.product_id, s.plant_id, s.id AS allocation_id, u.id AS movement_id, least(s.high, u.high) - greatest(s.high - s.units, u.high - u.units) AS units
        FROM s JOIN u ON s.product_id = u.product_id AND s.plant_id = u.plant_id
      UNION ALL SELECT s.product_id, s.plant_id, s.id, NULL, s.high - greatest(s.high - s.units, coalesce(ut.total, 0))
        FROM s LEFT JOIN ut ON s.product_id = ut.product_id AND s.plant_id = ut.plant_id
      UNION ALL SELECT u.product_id, u.plant_id, NULL, u.id, u.high - greatest(u.high - u.units, coalesce(st.total, 0))
        FROM u LEFT JOIN st ON u.product_id = st.product_id AND u.plant_id = st.plant_id)
    SELECT product_id, plant_id, allocation_id, movement_id, CAST(units AS BIGINT) AS units FROM m WHERE units > 0""",
)
def fifo_consumption(spark, folder):
    """Which finished line consumed which allocated line of the same product and plant, first in first out."""
    plants = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("plant_id"))
    lines = load(spark, folder, "lineitem").join(plants, "l_suppkey").select(
        F.col("l_partkey").alias("product_id"), "plant_id", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_shipdate").cast("date").alias("day"), "l_returnflag", "l_linestatus", F.col("l_quantity").cast("bigint").alias("units"),
    )
    merged = lambda rows, name: rows.groupBy("product_id", "plant_id", "day", F.col("id").alias(name)).agg(F.sum("units").alias("units"))
    return flows.fifo(
        merged(lines.where("l_returnflag <> 'R'"), "allocation_id"), merged(lines.where("l_linestatus = 'F'"), "movement_id"),
        ["product_id", "plant_id"], "allocation_id", ["day"], "units", "movement_id", ["movement_id", "day"], "units",
    )


def _spread_sql(name, here, source, target, links):
    """SQL of one level of recalled units: ``links`` has source, target and weight ``w``."""
    on = " AND ".join(f"h.{c} = p.{c}" for c in source)
    src, tgt, ptgt = ", ".join(f"p.{c}" for c in source), ", ".join(target), ", ".join(f"p.{c}" for c in target)
    both = ", ".join(dict.fromkeys([*source, *target]))
    return f"""{name}_p AS (SELECT {both}, CAST(sum(w) AS HUGEINT) AS w FROM ({links}) GROUP BY {both}),
    {name}_c AS (SELECT p.*, h.units AS held, sum(p.w) OVER (PARTITION BY {src} ORDER BY {ptgt}) AS upto, sum(p.w) OVER (PARTITION BY {src}) AS total
      FROM {name}_p p JOIN {here} h ON {on}),
    {name} AS (SELECT {tgt}, CAST(sum(held * upto // total - held * (upto - w) // total) AS HUGEINT) AS units FROM {name}_c GROUP BY {tgt})"""


RECALL_LINKS = "SELECT l_suppkey, l_partkey, l_orderkey, l_quantity::BIGINT AS w FROM lineitem"


@query(
    "recall_units",
    f"""WITH {i.ORDERS_NULLABLE_SQL}, maker AS (SELECT s_suppkey AS l_suppkey, CAST(1000 + s_suppkey % 97 AS HUGEINT) AS units FROM supplier WHERE s_acctbal < 0),
    {_spread_sql("batch", "maker", ["l_suppkey"], ["l_partkey", "l_suppkey"], RECALL_LINKS)},
    {_spread_sql("line", "batch", ["l_partkey", "l_suppkey"], ["l_orderkey"], RECALL_LINKS)},
    {_spread_sql("cust", "line", ["l_orderkey"], ["o_custkey"], "SELECT o_orderkey AS l_orderkey, o_custkey, 1 AS w FROM orders_nullable WHERE o_custkey IS NOT NULL")}
    SELECT 'manufacturer' AS level, CAST(l_suppkey AS VARCHAR) AS entity, CAST(units AS BIGINT) AS units,
      CAST(CASE WHEN l_suppkey IN (SELECT l_suppkey FROM lineitem) THEN 0 ELSE units END AS BIGINT) AS stopped FROM maker
    UNION ALL SELECT 'batch', l_partkey || '/' || l_suppkey, CAST(units AS BIGINT), 0 FROM batch
    UNION ALL SELECT 'order', CAST(l_orderkey AS VARCHAR), CAST(units AS BIGINT),
      CAST(CASE WHEN l_orderkey IN (SELECT o_orderkey FROM orders_nullable WHERE o_custkey IS NOT NULL) THEN 0 ELSE units END AS BIGINT) FROM line
    UNION ALL SELECT 'customer', CAST(o_custkey AS VARCHAR), CAST(units AS BIGINT), 0 FROM cust""",
)
def recall_units(spark, folder):
    """Units of manufacturers with a negative balance, split over batches, orders and customers by quantity."""
    makers = load(spark, folder, "supplier").where("s_acctbal < 0").select("s_suppkey", (F.lit(1000) + F.col("s_suppkey") % 97).alias("units"))
    lines = load(spark, folder, "lineitem").withColumn("units", F.col("l_quantity").cast("bigint"))
    orders = i.orders_nullable(spark, folder).withColumn("one", F.lit(1))
    found = flows.recall_units(
        makers,
        [
            (lines, "l_suppkey", ["l_partkey", "l_suppkey"], "units", "batch"),
            (lines, ["l_partkey", "l_suppkey"], "l_orderkey", "units", "order"),
            (orders, "o_orderkey", "o_custkey", "one", "customer"),
        ],
    )
    return found.withColumn("level", F.when(F.col("level") == "start", "manufacturer").otherwise(F.col("level")))


# The steps a visitor may take; None before the first.
VISITS = [
    (None, "signup"), (None, "view"), ("signup", "view"), ("view", "view"), ("view", "click"), ("click", "view"), ("click", "purchase"),
    ("purchase", "view"), ("error", "view"), ("view", "error"), ("click", "error"),
]
STEPS_SQL = """steps AS (SELECT user_id, ts, event_id, event_type, lag(ts) OVER w AS previous_ts, lag(event_id) OVER w AS previous_event_id,
  lag(event_type) OVER w AS previous_event_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
_VISITS_SQL = ", ".join("({}, '{}')".format("'-'" if a is None else f"'{a}'", b) for a, b in VISITS)


def _event_steps(spark, folder):
    return sequences.steps(load(spark, folder, "events"), "user_id", ["ts", "event_id"], "event_type", [])


@query("illegal_transitions", f"WITH {STEPS_SQL} SELECT user_id, event_id, event_type, previous_event_id, previous_event_type FROM steps WHERE (coalesce(previous_event_type, '-'), event_type) NOT IN ({_VISITS_SQL})")
def illegal_transitions(spark, folder):
    """Events that may not follow the event before them, with both."""
    found = sequences.illegal_steps(_event_steps(spark, folder), VISITS, "event_type")
    return found.select("user_id", "event_id", "event_type", "previous_event_id", "previous_event_type")


@query(
    "transition_counts",
    f"""WITH {STEPS_SQL} SELECT previous_event_type, event_type, count(*) AS step_count,
    (coalesce(previous_event_type, '-'), event_type) IN ({_VISITS_SQL}) AS legal FROM steps GROUP BY 1, 2""",
)
def transition_counts(spark, folder):
    return sequences.transition_counts(_event_steps(spark, folder), VISITS, "event_type")
