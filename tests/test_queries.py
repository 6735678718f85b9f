"""Every registered query: same rows as its SQL check, and a plan fit for a cluster."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from grainline.plans import CHECKS, QUERIES  # noqa: E402
from grainline.plans.check import TABLES, compare  # noqa: E402

FOLDER = os.environ.get("GRAINLINE_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")

# Queries whose file headers are read inside tasks; everything else stays in the JVM.
READS_FILES = {"schema_diff", "schema_drift_union", "row_preservation"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    kept = []

    def run(session, folder):
        kept.append(QUERIES[name](session, folder))
        return kept[0]

    text, _, good = compare(spark, FOLDER, name, run, CHECKS.get(name), db)
    assert good, text
    assert "types" not in text, text
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert node not in plan, f"{name}: {node}"
    if name not in READS_FILES:
        assert "MapInPandas" not in plan


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    df = contract.entry(spark)
    assert df.columns == ["table_name", "rule_id", "category", "status", "violations", "total", "pct"]
    assert df.count() > 0
