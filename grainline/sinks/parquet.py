"""Parquet output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# 100,000 suits tables of a few million rows; it would cut terabytes into millions of small files.
MAX_RECORDS_PER_FILE = 2_000_000


def by_partition(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a partition together, without one task per partition.

    A rebalance lets AQE split a partition that holds a large share of all rows and merge
    the small ones; a plain repartition by the same columns would do neither.
    """
    return df.hint("rebalance", *columns)


def write_partitioned(
    df: DataFrame, path: str, partitions: list[str], max_records: int = MAX_RECORDS_PER_FILE, clustered: bool = False
) -> None:
    """Replace only the partitions present in ``df``. The mode is set for this write, not the session.

    ``clustered`` says that the files ``df`` is read from already hold few partitions each, so
    that another shuffle would gain nothing.
    """
    rows = df if clustered else by_partition(df, partitions)
    (
        rows.write.mode("overwrite")
        .partitionBy(*partitions)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .option("compression", "snappy")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Replace an unpartitioned table as a whole."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records).option("compression", "snappy").parquet(path)


def with_period(df: DataFrame, day: str) -> DataFrame:
    """Add the text labels year and month (two digits) of a date."""
    return df.withColumn("year", F.date_format(day, "yyyy")).withColumn("month", F.date_format(day, "MM"))


def write_rejects(rejected: DataFrame, path: str, sample_order: list[str] | None = None, sample_rows: int = 500) -> None:
    """All rejected rows as Parquet by rule, their number per rule as JSON, and optionally a bounded CSV sample for people.

    The sample and the summary read what was written, so the rejects are worked out once.
    """
    by_partition(rejected, ["rule_id"]).write.mode("overwrite").partitionBy("rule_id").parquet(f"{path}/parquet")
    written = read_rejects(rejected.sparkSession, path, rejected)
    written.groupBy("rule_id").agg(F.count(F.lit(1)).alias("rejected_rows")).write.mode("overwrite").json(f"{path}/summary")
    if sample_order:
        # TakeOrderedAndProject: at most sample_rows rows leave the tasks
        sample = written.orderBy(*sample_order).limit(sample_rows)
        sample.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def read_rejects(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rejected rows written by ``write_rejects``, with the columns of ``like``."""
    return spark.read.schema(like.schema).parquet(f"{path}/parquet").select(*like.columns)
