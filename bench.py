"""Time the registered queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores and BENCH_QUERIES
(optional, comma-separated) the queries. Results go to a sink that discards them, so every
column of every row is computed and nothing reaches the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

from grainline.plans import QUERIES
from grainline.session import local_session

HEADLINE = (
    "order_header_rollup", "pk_profile", "duplicate_rows", "duplicate_distribution", "candidate_keys", "statuses_per_key",
    "fk_overlap_pct", "fk_orphans", "parents_without_children", "typed_projection", "raw_table_rules", "reject_rows",
    "quantity_waterfall", "date_progression", "recomputed_amount_mismatch", "price_bounds", "conditional_null_semantics",
    "validation_scorecard", "column_profile", "numeric_describe", "line_price_describe", "lag_stats", "crosstab_margins",
    "inconsistent_headers", "exactly_one_flag", "batch_trace", "order_lifecycle", "stock_balance", "plan_vs_actual",
    "routing_share", "demand_vs_actual", "bridge_join", "schema_drift_union", "dynamic_partition_overwrite", "manifest_diff",
    "run_ledger_latest", "curated_publication",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = local_session("bench", cores, cores)
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's code paths before the first measurement
    QUERIES["value_counts"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores),
            }
        )
    )


if __name__ == "__main__":
    main()
