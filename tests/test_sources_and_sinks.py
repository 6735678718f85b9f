import hashlib
import json
import os
import subprocess
import sys

import pytest
from conftest import one, rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from grainline.operators.rules import Rule, evaluate
from grainline.sinks import ledger
from grainline.sinks.parquet import write_partitioned, write_rejects, write_table
from grainline.sinks.reports import quality_report
from grainline.session import scratch
from grainline.sources import delimited, manifest
from grainline.spec import TableSpec, date, key, label, text, whole

SPEC = TableSpec(
    "t", "fact", ("id",), key("id") + text("name", "rma_no") + whole("qty") + date("day") + label("year"), partitions=("year",)
)
DIMENSION = TableSpec("d", "dimension", ("id",), key("id") + text("name"))


def put(root, name, content, encoding="utf-8"):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(content)
    return path


def test_names_are_normalised_and_may_not_collide():
    assert delimited.normalized([" Order No", "QTY"]) == ["order_no", "qty"]
    with pytest.raises(ValueError, match="order_no"):
        delimited.normalized(["Order No", "order_no "])


def test_files_with_other_headers_are_matched_by_name(spark, tmp_path):
    root = str(tmp_path)
    put(root, "year=2022/a.csv", "ID,Name,QTY,Day\n1, ann ,1,2022-01-01\n")
    put(root, "year=2023/a.csv", "Name,ID,QTY,Day,RMA No,New\nbob,2,2,2023-01-01,r1,x\n")
    put(root, "year=2023/b.csv", "﻿ID,Name,QTY,Day,RMA No\r\n3,cy,3,2023-01-02,\r\n")
    df = delimited.read_raw(spark, root, SPEC)
    assert df.columns == SPEC.names
    assert rows(df) == [
        ("1", "ann", None, "1", "2022-01-01", "2022"),
        ("2", "bob", "r1", "2", "2023-01-01", "2023"),
        ("3", "cy", None, "3", "2023-01-02", "2023"),
    ]


def test_missing_and_unexpected_columns_fail(spark, tmp_path):
    put(str(tmp_path / "a"), "year=2022/a.csv", "Name,QTY,Day\nx,1,2022-01-01\n")
    with pytest.raises(ValueError, match="missing required"):
        delimited.read_raw(spark, str(tmp_path / "a"), SPEC)
    put(str(tmp_path / "b"), "b.csv", "id,name,extra\n1,x,y\n")
    with pytest.raises(ValueError, match="unexpected"):
        delimited.read_raw(spark, str(tmp_path / "b"), DIMENSION)


def test_files_outside_the_partition_folders_are_read(spark, tmp_path):
    root = str(tmp_path)
    put(root, "a.csv", "ID,Name,QTY,Day\n1,ann,1,2022-01-01\n")
    put(root, "year=2022/b.csv", "ID,Name,QTY,Day\n2,bob,2,2022-01-02\n")
    put(root, "year=a%3Ab/c d.csv", "ID,Name,QTY,Day\n3,cy,3,2022-01-03\n\n")
    put(root, "year=2022/notes.txt", "99,junk\n")
    put(root, "year=2022/empty.csv", "")
    df = delimited.read_raw(spark, root, SPEC).select("id", "name", "year")
    assert rows(df) == [("1", "ann", None), ("2", "bob", "2022"), ("3", "cy", "a:b")]
    found = delimited.file_findings(spark, root, SPEC).where("finding <> 'missing_column'")
    name = F.regexp_extract("path", "([^/]+)$", 1).alias("name")
    assert rows(found.select(name, "finding", "column_name")) == [
        ("a.csv", "missing_label", "year"), ("empty.csv", "empty_file", None), ("notes.txt", "outside_pattern", None),
    ]
    lines = delimited.data_lines(spark, root)
    assert (lines.count(), lines.agg(F.sum("source_rows")).first()[0]) == (3, 3)


def test_a_quoted_comma_in_a_header(spark, tmp_path):
    put(str(tmp_path), "a.csv", 'id,"a, b"\n1,x\n')
    spec = TableSpec("t", "fact", ("id",), key("id") + text("a,_b"))
    assert rows(delimited.read_raw(spark, str(tmp_path), spec)) == [("1", "x")]
    assert delimited.schema_differences(delimited.file_headers(spark, str(tmp_path)), ["id", "a,_b"]).count() == 0


def test_schema_differences(spark, tmp_path):
    root = str(tmp_path)
    put(root, "year=2022/a.csv", 'ID,"Name",QTY,Day\n')
    put(root, "year=2023/a.csv", "Name,ID,QTY,Day,RMA No,New\n")
    headers = delimited.file_headers(spark, root)
    expected = ["id", "name", "rma_no", "qty", "day"]
    year = F.regexp_extract("path", r"year=([0-9]+)", 1)
    found = delimited.schema_differences(headers, expected).select(year, "column_name", "finding")
    assert rows(found) == [
        ("2022", "day", "moved"), ("2022", "qty", "moved"), ("2022", "rma_no", "missing"),
        ("2023", "day", "moved"), ("2023", "id", "moved"), ("2023", "name", "moved"), ("2023", "new", "extra"),
        ("2023", "qty", "moved"), ("2023", "rma_no", "moved"),
    ]
    assert {r.label for r in delimited.missing_labels(headers, ["year", "month"]).collect()} == {"month"}


def test_long_header_lines(spark, tmp_path):
    names = [f"column_{i}" for i in range(4000)]
    put(str(tmp_path), "a.csv", ",".join(names) + "\n1\n")
    assert one(delimited.file_headers(spark, str(tmp_path)))["header"] == ",".join(names)


def test_labels_keep_their_zero(spark, tmp_path):
    put(str(tmp_path), "year=2022/month=01/a.csv", "id\n1\n")
    df = delimited.scan_csv(spark, str(tmp_path), ["id"], ["year", "month"])
    assert rows(df) == [("1", "2022", "01")]


def test_manifest_against_plain_md5(spark, tmp_path):
    root = str(tmp_path)
    paths = [
        put(root, "facts/orders/year=2022/month=01/a.csv", "x" * 3_000_000),
        put(root, "dimensions/customers/c.csv", "id\n1\n"),
        put(root, "facts/moves/year=2023/empty.csv", ""),
    ]
    got = {r.file_name: r for r in manifest.file_manifest(spark, root).collect()}
    for path in paths:
        with open(path, "rb") as f:
            content = f.read()
        r = got[os.path.basename(path)]
        assert (r.md5, r.size_bytes) == (hashlib.md5(content).hexdigest(), len(content))
    assert tuple(got["a.csv"][3:7]) == ("fact", "orders", "2022", "01")
    assert tuple(got["c.csv"][3:7]) == ("dimension", "customers", None, None)


def test_task_functions_need_no_package_on_the_executors(tmp_path):
    """A worker started elsewhere can load and run them: they travel by value."""
    file = put(str(tmp_path), "a.csv", "id,name\n1,x\n")
    run = "import pickle, sys, pandas as pd; f = pickle.load(open(sys.argv[1], 'rb'))\nassert 'grainline' not in sys.modules\n" \
          "print(list(f([pd.DataFrame({'path': ['file:' + sys.argv[2]]})]))[0].iloc[0, 1])"
    for made, expected in ((delimited._header_reader(), "id,name"), (manifest._hasher(), hashlib.md5(b"id,name\n1,x\n").hexdigest())):
        pickled = tmp_path / "f.pickle"
        pickled.write_bytes(cloudpickle.dumps(made))
        done = subprocess.run([sys.executable, "-c", run, str(pickled), file], cwd="/", capture_output=True, text=True, timeout=120)
        assert done.stdout.strip() == expected, done.stderr


def test_transfer_decisions(spark):
    new = spark.createDataFrame([(p, "m", 1) for p in "abcd"], "path string, md5 string, size_bytes bigint")
    prior = spark.createDataFrame([("b", "m-2"), ("c", "m"), ("d", "other")], "path string, etag string")
    plain = manifest.transfer_decisions(new, prior)
    assert rows(plain.select("path", "reason", "status", "verification")) == [
        ("a", "file_not_exists", "success", "none"),
        ("b", "multipart_unverifiable", "skipped_unverifiable", "unverifiable"),
        ("c", "checksum_match", "skipped", "md5"),
        ("d", "mismatch", "failed", "md5"),
    ]
    again = spark.createDataFrame([("b", "m-2", 1), ("b", "m", 3), ("b", "other", 2)], "path string, etag string, stored_at int")
    assert [r.reason for r in manifest.transfer_decisions(new.where("path = 'b'"), again).collect()] == ["checksum_match"]
    forced = manifest.transfer_decisions(new, prior, force=True)
    assert [r.reason for r in forced.orderBy("path").collect()] == [
        "file_not_exists", "force_overwrite_multipart", "force_overwrite", "force_overwrite_mismatch"
    ]
    assert rows(manifest.manifest_errors(plain)) == [("d", "mismatch")]
    assert one(manifest.manifest_totals(plain).where("status = 'failed'"))["files"] == 1


def test_overwrite_replaces_only_written_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "2022"), (2, "2023"), (3, "2023")], "v int, year string")
    write_partitioned(first, path, ["year"])
    write_partitioned(spark.createDataFrame([(9, "2023")], "v int, year string"), path, ["year"])
    assert rows(spark.read.schema(first.schema).parquet(path)) == [(1, "2022"), (9, "2023")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    write_table(first, str(tmp_path / "d"))
    write_table(first.limit(1), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 1


def test_records_per_file(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).withColumn("year", F.lit("2022"))
    write_partitioned(df, path, ["year"], max_records=100)
    files = [f for f in os.listdir(f"{path}/year=2022") if f.endswith(".parquet")]
    assert len(files) >= 10 and spark.read.parquet(path).count() == 1000


def test_rejects_keep_all_rows_and_a_bounded_sample(spark, tmp_path):
    bad = spark.range(700).withColumn("rule_id", F.lit("r"))
    write_rejects(bad, str(tmp_path / "x"), ["id"], 500)
    assert spark.read.parquet(str(tmp_path / "x/parquet")).count() == 700
    assert spark.read.option("header", True).csv(str(tmp_path / "x/csv")).count() == 500


def test_ledger_latest_state(spark):
    data = [("t", 1, "IN_PROGRESS", None), ("t", 2, "COMMITTED", 5), ("t", 3, "FAILED", None), ("u", 1, "IN_PROGRESS", None)]
    df = spark.createDataFrame(data, "table_name string, ts int, status string, n bigint")
    got = rows(ledger.latest(df, "table_name", "status", ["ts"], "n"))
    assert got == [("t", 3, "FAILED", 5), ("u", 1, "IN_PROGRESS", None)]


def test_quality_report_is_json(spark):
    df = spark.createDataFrame([(1,), (-1,)], "v int")
    results = evaluate(df, [Rule("positive", "x", F.col("v") < 0), Rule("filled", "x", F.col("v").isNull())], "t")
    report = json.loads(one(quality_report(results, "run"))["report"])
    assert report["status"] == "FAILED" and report["rules"] == 2 and report["total_rows"] == 2
    assert report["violated"] == [{"rule_id": "positive", "status": "FAIL", "violations": 1}]


def test_scratch_is_new_and_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch(spark, "x"), scratch(spark, "x")
    assert a != b and a.startswith(shared + "/x-")
