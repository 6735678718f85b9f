import os
from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from grainline import catalog
from grainline.plans.curate import GateFailure, curate, read_curated
from grainline.sinks import ledger

# one valid row per table, enough for every reference to resolve
ROWS = {
    "customers": dict(customer_id="C1", customer_code="K1", contract_start_date="2021-01-05"),
    "manufacturers": dict(manufacturer_id="MFG0002", manufacturer_name=" Acme "),
    "customer_plant_mapping": dict(mapping_id="M1", customer_id="C1", plant_code="P-1", priority_flag="PRIMARY", active_flag="TRUE"),
    "plant_warehouse": dict(plant_id="7", plant_code="P-1", latitude="12.5", longitude="77.1", cold_storage_available="Yes",
                            cold_storage_capacity="1,000"),
    "products_master": dict(product_id="3", productcode="X", isessentialdrug="1", coldchainrequired="0", gst_rate="12",
                            is_discontinued="FALSE", price="1,234.50", pack_count="10"),
    "products_annual_demand": dict(product_id="3", annual_target_units="500"),
    "product_manufacturer_bridge": dict(manufacturer_id="MFG0002", product_id="3", price="9.99"),
    "product_batches": dict(batch_id="B1", product_id="3.0", manufacturer_id="MFG0002", mfg_date="2022-02-01",
                            expiry_date="01-02-2024", coldchainrequired="0", year="2022"),
    "batch_allocator_central": dict(allocation_id="A1", batch_id="B1", product_id="3", manufacturer_id="MFG0002", plant_id="7",
                                    units_allocated="5", allocation_date="2022/02/03", year="2022"),
    "inventory_movements": dict(movement_id="V1", movement_type="IN", batch_id="B1", product_id="3", manufacturer_id="MFG0002",
                                to_plant_id="7.0", units="5", movement_date="2022-02-04", year="2022"),
    "orders": dict(erp_export_row_id="E1", customer_id="C1", product_id="3", plant_code="7", order_date="2022-03-01T00:00:00",
                   order_qty="-2", order_price="1,000.50", gst_rate="12.00", payment_mode="upi", line_status="RETURNED",
                   order_year="2022", year="2022", month="03"),
}


def write(root, spec, records, file="part.csv", names=None):
    """CSV below the partition folder; header in upper case."""
    names = names or [n for n in spec.names if n not in spec.partitions]
    folders = {}
    for r in records:
        folder = "/".join([root, spec.name, *[f"{p}={r[p]}" for p in spec.partitions]])
        folders.setdefault(folder, []).append(r)
    for folder, found in folders.items():
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{file}", "w") as f:
            f.write(",".join(n.upper() for n in names) + "\n")
            for r in found:
                f.write(",".join('"%s"' % r.get(n, "") for n in names) + "\n")
    return f"{root}/{spec.name}"


def test_all_tables_are_published_together(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    specs = [*catalog.DIMENSIONS, *catalog.FACTS]
    sources = {s.name: write(raw, s, [ROWS[s.name]]) for s in specs}
    results = curate(spark, specs, sources, target, "run-1")
    assert results.where("status = 'FAIL'").count() == 0
    order = read_curated(spark, target, catalog.ORDERS).collect()[0]
    assert order.order_date == date(2022, 3, 1) and order.order_price == Decimal("1000.50") and order.gst_rate == Decimal("12.00")
    assert (order.payment_mode, order.line_status, order.order_qty, order.year, order.month) == ("UPI", "Returned", -2, "2022", "03")
    plant = read_curated(spark, target, catalog.PLANT_WAREHOUSE).collect()[0]
    assert (plant.plant_id, plant.cold_storage_available, plant.cold_storage_capacity) == (7, True, 1000)
    last = ledger.latest(ledger.read(spark, f"{target}/ledger"), "table_name", "status", ["logged_at"], "row_count")
    assert rows(last.select("latest_status", "committed_rows").distinct()) == [("COMMITTED", 1)]


def batch(n, **changes):
    return {**ROWS["product_batches"], "batch_id": f"B{n}", **changes}


def run(spark, tmp_path, records, name):
    raw, target = str(tmp_path / name), str(tmp_path / "out")
    source = write(raw, catalog.PRODUCT_BATCHES, records)
    return curate(spark, [catalog.PRODUCT_BATCHES], {"product_batches": source}, target, name), target


def test_a_failed_gate_publishes_nothing(spark, tmp_path):
    _, target = run(spark, tmp_path, [batch(1), batch(2)], "good")
    with pytest.raises(GateFailure, match="key_duplicate"):
        run(spark, tmp_path, [batch(1), batch(1)], "twice")
    with pytest.raises(GateFailure, match="partition_year"):
        run(spark, tmp_path, [batch(1), batch(2, mfg_date="2023-01-01")], "year")
    with pytest.raises(GateFailure, match="critical_null:mfg_date"):
        run(spark, tmp_path, [batch(1), batch(2, mfg_date="soon-ish-x")], "date")
    with pytest.raises(GateFailure, match="cast:product_id"):
        run(spark, tmp_path, [batch(1), batch(2, product_id="abc")], "cast")
    assert read_curated(spark, target, catalog.PRODUCT_BATCHES).count() == 2
    states = ledger.read(spark, f"{target}/ledger").where("run_id = 'twice'").select("status")
    assert rows(states) == [("FAILED",), ("IN_PROGRESS",)]
    bad = spark.read.parquet(f"{target}/rejects/cast/product_batches/parquet")
    assert rows(bad.select("rule_id", "batch_id")) == [("cast:product_id", "B2")]


def test_tolerated_failures_become_null_and_are_counted(spark, tmp_path):
    records = [batch(n) for n in range(60)] + [batch(99, expiry_date="not a date")]
    results, target = run(spark, tmp_path, records, "tolerated")
    found = {r.rule_id: r for r in results.collect()}
    assert (found["date_parse:expiry_date"].status, found["date_parse:expiry_date"].violations) == ("WARN", 1)
    assert found["row_preservation"].status == "PASS"
    out = read_curated(spark, target, catalog.PRODUCT_BATCHES)
    assert out.count() == 61 and out.where(F.col("expiry_date").isNull()).count() == 1


def test_a_new_year_leaves_older_partitions_alone(spark, tmp_path):
    run(spark, tmp_path, [batch(1)], "y2022")
    _, target = run(spark, tmp_path, [batch(2, mfg_date="2023-05-01", year="2023")], "y2023")
    assert rows(read_curated(spark, target, catalog.PRODUCT_BATCHES).select("batch_id", "year")) == [("B1", "2022"), ("B2", "2023")]


def test_publishing_again_changes_nothing(spark, tmp_path):
    run(spark, tmp_path, [batch(1), batch(2)], "same")
    before = rows(read_curated(spark, str(tmp_path / "out"), catalog.PRODUCT_BATCHES))
    run(spark, tmp_path, [batch(1), batch(2)], "same")
    assert rows(read_curated(spark, str(tmp_path / "out"), catalog.PRODUCT_BATCHES)) == before


def test_orphans_block_the_run(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    specs = [catalog.MANUFACTURERS, catalog.PRODUCT_BATCHES]
    sources = {
        "manufacturers": write(raw, specs[0], [ROWS["manufacturers"]]),
        "product_batches": write(raw, specs[1], [batch(1, manufacturer_id="MFG9")]),
    }
    with pytest.raises(GateFailure, match="manufacturer_id->manufacturers"):
        curate(spark, specs, sources, target, "r")


def test_offending_keys_and_orphans_are_left_as_rejects(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    specs = [catalog.MANUFACTURERS, catalog.PRODUCT_BATCHES]
    sources = {
        "manufacturers": write(raw, specs[0], [ROWS["manufacturers"]]),
        "product_batches": write(raw, specs[1], [batch(1), batch(1), batch(2, manufacturer_id="MFG9")]),
    }
    with pytest.raises(GateFailure):
        curate(spark, specs, sources, target, "r")
    bad = spark.read.parquet(f"{target}/rejects/r/product_batches/parquet")
    assert rows(bad.select("rule_id", "batch_id")) == [
        ("key_duplicate", "B1"), ("key_duplicate", "B1"), ("reference:manufacturer_id->manufacturers", "B2")
    ]
    summary = spark.read.json(f"{target}/rejects/r/product_batches/summary")
    assert {r["rule_id"]: r["rejected_rows"] for r in summary.collect()}["key_duplicate"] == 2


def test_readers_see_all_tables_of_a_run_or_none(spark, tmp_path, monkeypatch):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    specs = [catalog.MANUFACTURERS, catalog.PRODUCT_BATCHES]

    def deliver(name, value):
        manufacturer = {**ROWS["manufacturers"], "manufacturer_name": value}
        return {"manufacturers": write(f"{raw}/{name}", specs[0], [manufacturer]), "product_batches": write(f"{raw}/{name}", specs[1], [batch(1)])}

    curate(spark, specs, deliver("one", "Old"), target, "one")
    kept = ledger.append

    def broken(session, path, records):
        if records[0][2] == ledger.COMMITTED:
            raise OSError("the store is away")
        kept(session, path, records)

    monkeypatch.setattr(ledger, "append", broken)
    with pytest.raises(OSError):
        curate(spark, specs, deliver("two", "New"), target, "two")
    assert [r.manufacturer_name for r in read_curated(spark, target, specs[0]).collect()] == ["Old"]
    monkeypatch.setattr(ledger, "append", kept)
    curate(spark, specs, deliver("two", "New"), target, "two")
    assert [r.manufacturer_name for r in read_curated(spark, target, specs[0]).collect()] == ["New"]
    assert read_curated(spark, str(tmp_path / "out"), specs[1]).count() == 1


def test_stray_and_empty_files_fail_the_gate(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    source = write(raw, catalog.PRODUCT_BATCHES, [batch(1)])
    with open(f"{source}/loose.csv", "w") as f, open(f"{source}/year=2022/part.csv") as given:
        f.write(given.read().replace("B1", "B2"))
    open(f"{source}/year=2022/nothing.csv", "w").close()
    with pytest.raises(GateFailure, match="schema:empty_file.*schema:missing_label"):
        curate(spark, [catalog.PRODUCT_BATCHES], {"product_batches": source}, target, "r")
    found = {r.rule_id: r for r in spark.read.parquet(f"{target}/reports/r/rules").collect()}
    assert found["row_preservation"].status == "PASS" and found["row_preservation"].total == 2


def test_new_columns_are_reported(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    names = [n for n in catalog.PRODUCT_BATCHES.names if n != "year"]
    source = write(raw, catalog.PRODUCT_BATCHES, [batch(1, extra="x")], names=[*names, "extra"])
    results = curate(spark, [catalog.PRODUCT_BATCHES], {"product_batches": source}, target, "r")
    found = {r.rule_id: r.status for r in results.collect()}
    assert found["schema:extra_column"] == "WARN" and found["schema:missing_column"] == "PASS"


def test_business_rules_of_the_catalog(spark):
    from grainline.operators.business import business_rules
    from grainline.operators.rules import evaluate

    def broken(spec, **values):
        full = {**ROWS[spec.name], **values}
        raw = spark.createDataFrame([tuple(full.get(n) for n in spec.names)], spec.raw_schema)
        return {r.rule_id for r in evaluate(raw, business_rules(spec), spec.name).collect() if r.violations}

    assert broken(catalog.PRODUCT_BATCHES, expiry_date="2021-01-01", batch_size_units="0") == {"expiry_after_mfg", "positive:batch_size_units"}
    assert broken(catalog.INVENTORY_MOVEMENTS, movement_type="TRANSFER", units="0") == {"movement_semantics", "units_positive"}
    assert broken(catalog.PLANT_WAREHOUSE, latitude="91") == {"bounds:latitude"}
    assert broken(catalog.PRODUCTS_MASTER, price="0", gst_rate="13", formulation="Brick", packing_type="strip") == {
        "positive:price", "domain:gst_rate", "domain:formulation"
    }
    assert broken(catalog.PRODUCT_MANUFACTURER_BRIDGE, price="-1") == {"positive:price"}
    assert all(not broken(s) for s in (*catalog.DIMENSIONS, *catalog.FACTS) if business_rules(s))
