"""Session helpers: table access and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "grainline", cores: str = "8", shuffle: str = "8") -> SparkSession:
    """A session for tests and the benchmark. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # HotSpot never compiles a method above 8,000 bytes; Spark then plans such a stage in smaller pieces
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder the cluster names in spark.checkpoint.dir.

    A machine-local temporary folder is used only by local-mode sessions that set none:
    executors of a cluster could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="grainline-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to a new shared folder and read it back: computed once, and its lineage ends there."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
