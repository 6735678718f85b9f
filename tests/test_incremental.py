"""Incremental publication, reads as of a run, retention and compaction of the ledger."""

import os
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_curate import ROWS, batch, write

from grainline import catalog
from grainline.plans.curate import GateFailure, curate, read_curated
from grainline.plans.incremental import SOURCE, curate_incremental, known_files, read_incremental
from grainline.plans.retention import sweep
from grainline.sinks import ledger, store

SPEC = catalog.PRODUCT_BATCHES


@pytest.fixture
def place(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")

    def deliver(*records, file):
        return write(raw, SPEC, records, file)

    def publish(run):
        return curate_incremental(spark, [SPEC], {SPEC.name: f"{raw}/{SPEC.name}"}, target, run)

    return raw, target, deliver, publish


def ids(df):
    return sorted(r.batch_id for r in df.select("batch_id").collect())


def files_read(spark, target):
    """Source files per attempt, in the order of the runs."""
    done = {r.attempt: r.logged_at for r in ledger.committed(spark, f"{target}/ledger", SPEC.name).collect()}
    stored = {}
    for a in sorted(done, key=done.get):
        at = f"{target}/increments/{SPEC.name}/attempt={a}"
        stored[a] = spark.read.parquet(at).select(SOURCE).distinct().count() if os.path.isdir(at) else 0
    return list(stored.values())


def test_a_second_run_reads_the_new_file_alone(spark, place):
    raw, target, deliver, publish = place
    for n in range(10):
        deliver(batch(n), file=f"part-{n}.csv")
    publish("one")
    assert ids(read_incremental(spark, target, SPEC)) == [f"B{n}" for n in range(10)]
    deliver(batch(77, mfg_date="2023-05-01", year="2023"), file="part 10+%.csv")
    results = publish("two")
    assert files_read(spark, target) == [10, 1]
    assert {r.rule_id: r.total for r in results.collect()}["row_preservation"] == 1
    curate(spark, [SPEC], {SPEC.name: f"{raw}/{SPEC.name}"}, f"{target}-full", "all")
    assert rows(read_incremental(spark, target, SPEC)) == rows(read_curated(spark, f"{target}-full", SPEC))
    assert ids(read_incremental(spark, target, SPEC, as_of="one")) == [f"B{n}" for n in range(10)]
    publish("three")
    assert files_read(spark, target) == [10, 1, 0] and read_incremental(spark, target, SPEC).count() == 11


def test_changed_touched_and_removed_files(spark, place):
    raw, target, deliver, publish = place
    for n in range(3):
        deliver(batch(n), file=f"{n}.csv")
    publish("one")
    os.utime(f"{raw}/{SPEC.name}/year=2022/0.csv", (1, 1))
    deliver(batch(8), batch(9), file="1.csv")
    os.remove(f"{raw}/{SPEC.name}/year=2022/2.csv")
    publish("two")
    assert ids(read_incremental(spark, target, SPEC)) == ["B0", "B8", "B9"] and files_read(spark, target) == [3, 1]
    states = {r.path.rsplit("/", 1)[1]: r.state for r in known_files(spark, target, SPEC.name).collect()}
    assert states == {"0.csv": "present", "1.csv": "present", "2.csv": "gone"}
    deliver(batch(2), file="2.csv")
    publish("three")
    assert ids(read_incremental(spark, target, SPEC)) == ["B0", "B2", "B8", "B9"] and files_read(spark, target) == [3, 1, 1]
    assert ids(read_incremental(spark, target, SPEC, as_of="two")) == ["B0", "B8", "B9"]


def test_gates_see_the_table_as_it_will_be(spark, place):
    raw, target, deliver, publish = place
    deliver(batch(1), file="a.csv")
    publish("one")
    deliver(batch(1), file="b.csv")
    with pytest.raises(GateFailure, match="key_duplicate"):
        publish("twice")
    assert ids(read_incremental(spark, target, SPEC)) == ["B1"]
    # the old file no longer holds the key
    deliver(batch(2), file="a.csv")
    publish("moved")
    assert ids(read_incremental(spark, target, SPEC)) == ["B1", "B2"]
    open(f"{raw}/{SPEC.name}/year=2022/none.csv", "w").close()
    with pytest.raises(GateFailure, match="empty"):
        publish("empty")
    os.remove(f"{raw}/{SPEC.name}/year=2022/none.csv")
    os.remove(f"{raw}/{SPEC.name}/year=2022/a.csv")
    os.remove(f"{raw}/{SPEC.name}/year=2022/b.csv")
    with pytest.raises(GateFailure, match="empty_table"):
        publish("nothing left")


def test_a_removed_parent_fails_the_references(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    specs = [catalog.MANUFACTURERS, SPEC]
    other = {**ROWS["manufacturers"], "manufacturer_id": "MFG0003", "manufacturer_name": "Other"}
    sources = {"manufacturers": write(raw, specs[0], [ROWS["manufacturers"]], "a.csv"), SPEC.name: write(raw, SPEC, [batch(1)])}
    write(raw, specs[0], [other], "b.csv")
    curate_incremental(spark, specs, sources, target, "one")
    os.remove(f"{raw}/manufacturers/a.csv")
    with pytest.raises(GateFailure, match="manufacturer_id->manufacturers"):
        curate_incremental(spark, specs, sources, target, "two")


def test_reads_as_of_a_run_and_only_the_folders_they_need(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    for n in range(3):
        sources = {SPEC.name: write(f"{raw}/{n}", SPEC, [batch(n)])}
        curate(spark, [SPEC], sources, target, f"run{n}")
    assert [ids(read_curated(spark, target, SPEC, as_of=f"run{n}")) for n in range(3)] == [["B0"], ["B1"], ["B2"]]
    files = [f for f in read_curated(spark, target, SPEC).inputFiles() if "/tables/" in f]
    assert files and all("/attempt=run2-" in f for f in files)
    assert ids(read_curated(spark, target, SPEC)) == ["B2"]
    with pytest.raises(ValueError, match="run9"):
        read_curated(spark, target, SPEC, as_of="run9")
    assert read_curated(spark, str(tmp_path / "never"), SPEC).count() == 0


def test_sweep_keeps_what_a_reader_may_still_need(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    run = lambda n, *records: curate(spark, [SPEC], {SPEC.name: write(f"{raw}/{n}", SPEC, records)}, target, n)
    attempts = lambda: [n for n in store.names(spark, f"{target}/tables/{SPEC.name}") if n.startswith("attempt=")]
    run("one", batch(1))
    with pytest.raises(GateFailure):
        run("bad", batch(1), batch(1))
    run("two", batch(2), batch(5, mfg_date="2023-05-01", year="2023"))
    since = datetime.now(timezone.utc)
    reader = read_curated(spark, target, SPEC)
    run("three", batch(3))
    assert len(attempts()) == 4
    gone = sweep(spark, target, [SPEC], since)
    assert sorted(p.rsplit("=", 1)[1][:-13] for p in gone if "/tables/" in p) == ["bad", "one"]
    # begun before the sweep and before the third run
    assert ids(reader) == ["B2", "B5"] and ids(read_curated(spark, target, SPEC)) == ["B3", "B5"]
    with pytest.raises(Exception, match="[Pp]ath"):
        read_curated(spark, target, SPEC, as_of="one").count()
    sweep(spark, target, [SPEC], datetime.now(timezone.utc))
    # the year 2023 is still that of the second run
    assert len(attempts()) == 2 and ids(read_curated(spark, target, SPEC)) == ["B3", "B5"]


def test_sweep_of_increments(spark, place):
    raw, target, deliver, publish = place
    deliver(batch(1), file="a.csv")
    publish("one")
    deliver(batch(2), file="b.csv")
    publish("two")
    deliver(batch(3), batch(4), file="a.csv")
    publish("three")
    gone = sweep(spark, target, [SPEC], datetime.now(timezone.utc))
    assert [p.rsplit("=", 1)[1][:-13] for p in gone] == ["one"] and ids(read_incremental(spark, target, SPEC)) == ["B2", "B3", "B4"]
    deliver(batch(9), file="c.csv")
    publish("four")
    assert ids(read_incremental(spark, target, SPEC)) == ["B2", "B3", "B4", "B9"]


def test_ledger_compaction(spark, tmp_path):
    book = str(tmp_path / "ledger")
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    states = lambda: rows(ledger.read(spark, book).select("run_id", "status", "row_count"))
    assert states() == []
    for n in range(4):
        ledger.append(spark, book, [(f"r{n}", "t", ledger.COMMITTED, n, at, f"r{n}-x")])
    before = states()
    ledger.compact(spark, book)
    assert states() == before and len(store.names(spark, f"{book}/_snapshots")) == 1
    ledger.append(spark, book, [("r4", "t", ledger.FAILED, None, at, "why")])
    assert len(states()) == 5
    assert ledger.prune(spark, book, at) == [] and len(states()) == 5
    ledger.compact(spark, book)
    old = ledger.read(spark, book)
    gone = ledger.prune(spark, book, datetime.now(timezone.utc))
    assert len([n for n in gone if n.endswith(".parquet")]) == 5 and len(states()) == 5 and old.count() == 5
    ledger.append(spark, book, [("r5", "t", ledger.STARTED, None, at, None)])
    ledger.compact(spark, book)
    assert len(states()) == 6 and ledger.committed(spark, book, "t").count() == 4
    # a snapshot that was not finished is passed over
    os.makedirs(f"{book}/_snapshots/99999999-half/rows")
    assert len(states()) == 6
    assert ledger.read(spark, book).where(F.col("run_id") == "r4").first()["detail"] == "why"
