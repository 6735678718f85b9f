"""File manifests: what is there, what changed and what to transfer."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.sources.delimited import all_paths, file_opener, list_files


def _hasher():
    open_file = file_opener()

    def md5(path):
        digest = hashlib.md5()
        with open_file(path, compression=None) as stream:
            while chunk := stream.read(1 << 20):
                digest.update(chunk)
        return digest.hexdigest()

    def read(batches):
        for batch in batches:
            yield batch.assign(md5=[md5(p) for p in batch["path"]])

    return read


def path_labels(path: Column) -> list[Column]:
    """Table type, table and partition labels, as written in a path."""

    def part(pattern: str, name: str) -> Column:
        return F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).alias(name)

    return [
        F.when(F.contains(path, F.lit("dimensions/")), F.lit("dimension"))
        .when(F.contains(path, F.lit("facts/")), F.lit("fact"))
        .alias("table_type"),
        part(r"(?:dimensions|facts)/([^/]+)/", "table_name"),
        part(r"/year=([^/]+)/", "year"),
        part(r"/month=([^/]+)/", "month"),
        part(r"([^/]+)$", "file_name"),
    ]


def manifest_rows(files: DataFrame) -> DataFrame:
    """The manifest of files known by (path, md5, size_bytes): path, size, MD5 and the labels in the path."""
    return files.select("path", "size_bytes", "md5", *path_labels(F.col("path")))


def hashed_files(files: DataFrame) -> DataFrame:
    """(path, size_bytes, md5) of files (path, size_bytes), hashed as streams inside the tasks."""
    return files.select("path", "size_bytes").mapInPandas(_hasher(), "path string, size_bytes bigint, md5 string")


def file_manifest(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, size, MD5 and labels of every file.

    Files are listed without content and hashed as a stream inside the tasks, so a file may
    be larger than memory or than the 2 GB a binary column holds.
    """
    files = list_files(spark, root, pattern).select("path", F.col("length").alias("size_bytes"))
    hashed = hashed_files(files)
    # a scan plans no task for an empty file; those are found by name
    empty = all_paths(spark, root, pattern).join(files, "path", "left_anti").select(
        "path", F.lit(0).cast("bigint").alias("size_bytes"), F.md5(F.lit("")).alias("md5")
    )
    return manifest_rows(hashed.unionByName(empty))


def transfer_decisions(new: DataFrame, prior: DataFrame, key: str = "path", force: bool = False) -> DataFrame:
    """What to do with each new file, given the etags already stored.

    ``new`` has (key, md5, size_bytes), ``prior`` has (key, etag) and, where a key may have been
    stored more than once, ``stored_at``: the latest entry counts, of equal ones the larger etag.
    An etag with a dash comes from a multipart transfer and cannot be compared with an MD5.
    """
    when = F.struct("stored_at", "etag") if "stored_at" in prior.columns else F.struct("etag")
    latest = prior.groupBy(key).agg(F.max_by("etag", when).alias("etag"))
    joined = new.select(key, "md5", "size_bytes").join(latest, key, "left")
    absent = F.col("etag").isNull()
    multipart = F.contains(F.col("etag"), F.lit("-"))
    same = F.col("etag") == F.col("md5")
    # The reasons, statuses and verification names.
    if force:
        reason = (
            F.when(absent, "file_not_exists")
            .when(multipart, "force_overwrite_multipart")
            .when(same, "force_overwrite")
            .otherwise("force_overwrite_mismatch")
        )
        status = F.lit("success")
    else:
        reason = (
            F.when(absent, "file_not_exists")
            .when(multipart, "multipart_unverifiable")
            .when(same, "checksum_match")
            .otherwise("mismatch")
        )
        status = (
            F.when(absent, "success").when(multipart, "skipped_unverifiable").when(same, "skipped").otherwise("failed")
        )
    verification = F.when(absent, "none").when(multipart, "unverifiable").otherwise("md5")
    return joined.select(
        key, "md5", "size_bytes", "etag", reason.alias("reason"), status.alias("status"), verification.alias("verification")
    )


def manifest_totals(decisions: DataFrame) -> DataFrame:
    """Files and bytes per status."""
    return decisions.groupBy("status").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes")
    )


def manifest_errors(decisions: DataFrame, key: str = "path") -> DataFrame:
    """The failed files with their reason."""
    return decisions.where(F.col("status") == "failed").select(key, "reason")
