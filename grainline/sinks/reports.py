"""Run reports as rows of JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quality_report(results: DataFrame, run_id: str) -> DataFrame:
    """One JSON document per table: totals per status and every rule that was violated.

    The rules of a table are few, so their list per table is bounded by the specification.
    """
    violated = F.collect_list(
        F.when(F.col("violations") > 0, F.struct("rule_id", "status", "violations"))
    )
    per_table = results.groupBy("table_name").agg(
        F.max("total").alias("total_rows"),
        F.count(F.lit(1)).alias("rules"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.sort_array(violated).alias("violated"),
    )
    body = F.struct(
        F.lit(run_id).alias("run_id"),
        F.col("table_name").alias("table"),
        F.when(F.col("failed") > 0, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        "total_rows",
        "rules",
        "failed",
        "warned",
        "violated",
    )
    return per_table.select("table_name", F.to_json(body).alias("report"))


def write_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)
