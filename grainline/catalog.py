"""The eleven tables of the supply-chain model.

Column names, types, keys, enum values, year bounds and row counts below are fixed values
of the data model.
"""

from __future__ import annotations

from grainline.functions.cleaning import TWO_FORMATS
from grainline.spec import (
    Reference,
    TableSpec,
    date,
    enum,
    flag,
    ids,
    key,
    key_int,
    label,
    money,
    real,
    text,
    whole,
)

CUSTOMERS = TableSpec(
    "customers", "dimension", ("customer_id",),
    key("customer_id")
    + text("customer_code", "customer_name_desc", "customer_type", "district", "state", "region", "ownership_type")
    + date("contract_start_date", "contract_end_date"),
    alternate_keys=(("customer_code",),),
)

MANUFACTURERS = TableSpec(
    "manufacturers", "dimension", ("manufacturer_id",), key("manufacturer_id") + text("manufacturer_name")
)

CUSTOMER_PLANT_MAPPING = TableSpec(
    "customer_plant_mapping", "dimension", ("mapping_id",),
    key("mapping_id") + text("customer_id", "plant_code", "priority_flag") + flag("active_flag", "true_false"),
    alternate_keys=(("customer_id", "plant_code"),),
    references=(
        Reference("customer_id", "customers", "customer_id"),
        Reference("plant_code", "plant_warehouse", "plant_code"),
    ),
)

PLANT_WAREHOUSE = TableSpec(
    "plant_warehouse", "dimension", ("plant_id",),
    key_int("plant_id")
    + text("plant_code", "plant_name", "plant_type", "state", "district", "region")
    + real("latitude", "longitude")
    + whole("total_storage_capacity")
    + flag("cold_storage_available", "yes_no")
    + whole("cold_storage_capacity")
    + text("status", "parent_plant_code"),
    alternate_keys=(("plant_code",),),
    references=(Reference("parent_plant_code", "plant_warehouse", "plant_code", optional=True),),
)

PRODUCTS_MASTER = TableSpec(
    "products_master", "dimension", ("product_id",),
    key_int("product_id")
    + text("productcode")
    + ids("hsncode")
    + text("generic_composition", "strength_value", "strength_unit", "formulation", "packing_type")
    + text("pack_size_label", "therapeutic_segment")
    + flag("isessentialdrug", "zero_one")
    + flag("coldchainrequired", "zero_one")
    + money("gst_rate", precision=5)
    + text("product_name", "formulation_code")
    + whole("pack_count", limit_pct=2.0, on_breach="WARN")
    + text("generic_code")
    + flag("is_discontinued", "true_false")
    + money("price")
    + text("short_composition1", "short_composition2")
    + whole("shelflife_months"),
)

PRODUCTS_ANNUAL_DEMAND = TableSpec(
    "products_annual_demand", "dimension", ("product_id",),
    key_int("product_id")
    + text("product_code", "generic", "formulation")
    + whole("shelf_life_months", "pack_units_per_pack")
    + money("unit_mrp")
    + text("demand_tier")
    + whole("annual_target_units", "batches_per_year", "total_batches", "nominal_batch_size"),
    references=(Reference("product_id", "products_master", "product_id"),),
)

PRODUCT_MANUFACTURER_BRIDGE = TableSpec(
    "product_manufacturer_bridge", "dimension", ("manufacturer_id", "product_id"),
    key("manufacturer_id")
    + text("manufacturer_name", "production_level")
    + key_int("product_id")
    + text("generic_composition", "therapeutic_segment", "formulation", "strength_value", "strength_unit")
    + money("price"),
    references=(
        Reference("product_id", "products_master", "product_id"),
        Reference("manufacturer_id", "manufacturers", "manufacturer_id"),
    ),
)

PRODUCT_BATCHES = TableSpec(
    "product_batches", "fact", ("batch_id",),
    key("batch_id")
    + text("batch_number", "lot_number")
    + ids("product_id")
    + text("product_code", "manufacturer_id", "manufacturer_name")
    + date("mfg_date", "expiry_date")
    + whole("mfg_year")
    + text("formulation", "generic_name")
    + whole("pack_units_per_pack", "batch_size_units")
    + money("unit_mrp")
    + flag("coldchainrequired", "zero_one")
    + label("year"),
    partitions=("year",),
    critical_date="mfg_date",
    year_label=("year", "mfg_date"),
    references=(
        Reference("product_id", "products_master", "product_id"),
        Reference("manufacturer_id", "manufacturers", "manufacturer_id"),
    ),
)

BATCH_ALLOCATOR_CENTRAL = TableSpec(
    "batch_allocator_central", "fact", ("allocation_id",),
    key("allocation_id")
    + text("batch_id", "batch_number", "lot_number")
    + ids("product_id")
    + text("manufacturer_id")
    + ids("plant_id")
    + text("operational_zone")
    + whole("units_allocated")
    + date("allocation_date", "mfg_date", "expiry_date")
    + whole("allocation_year")
    + text("demand_tier", "formulation")
    + flag("coldchainrequired", "zero_one")
    + whole("batch_size_units")
    + label("year"),
    partitions=("year",),
    critical_date="allocation_date",
    year_label=("year", "allocation_date"),
    references=(
        Reference("batch_id", "product_batches", "batch_id"),
        Reference("product_id", "products_master", "product_id"),
        Reference("manufacturer_id", "manufacturers", "manufacturer_id"),
        Reference("plant_id", "plant_warehouse", "plant_id"),
    ),
)

INVENTORY_MOVEMENTS = TableSpec(
    "inventory_movements", "fact", ("movement_id",),
    key("movement_id")
    + text("movement_type", "batch_id", "batch_number", "lot_number", "allocation_id")
    + ids("product_id")
    + text("manufacturer_id")
    + ids("from_plant_id", "to_plant_id")
    + whole("units")
    + date("movement_date")
    + whole("movement_year")
    + date("mfg_date", "expiry_date")
    + text("demand_tier", "formulation")
    + flag("coldchainrequired", "zero_one")
    + text("operational_zone")
    + label("year"),
    partitions=("year",),
    critical_date="movement_date",
    year_label=("year", "movement_date"),
    references=(
        Reference("batch_id", "product_batches", "batch_id"),
        Reference("product_id", "products_master", "product_id"),
        Reference("manufacturer_id", "manufacturers", "manufacturer_id"),
        Reference("from_plant_id", "plant_warehouse", "plant_id", optional=True),
        Reference("to_plant_id", "plant_warehouse", "plant_id", optional=True),
        Reference("allocation_id", "batch_allocator_central", "allocation_id", optional=True),
    ),
)

ORDERS = TableSpec(
    "orders", "fact", ("erp_export_row_id",),
    key("erp_export_row_id")
    + text("order_line_id", "order_no", "so_number")
    + whole("order_line_no")
    + text("delivery_no")
    + whole("delivery_line_no")
    + text("invoice_no")
    + whole("invoice_line_no")
    + text("customer_id")
    + ids("product_id", "plant_code")
    + text("batch_id", "customer_name", "product_code", "product_name", "batch_no", "lot_number")
    + date("order_date", nullable=False)
    + date("expected_delivery_date", "actual_delivery_date", "invoice_date")
    + whole("order_qty", "delivery_qty", "invoice_qty")
    + money("mrp", "floor_price", "order_price", "delivery_price", "invoice_price")
    + money("gst_rate", precision=5)
    + money("gst_amount", "net_line_amount", "total_line_amount_incl_gst")
    + enum("payment_mode", "Cash", "Card", "Credit", "UPI", "Cheque")
    + enum("payment_status", "Pending", "Paid", "Failed", "Refunded")
    + enum("line_status", "Ordered", "Delivered", "Invoiced", "Cancelled", "Returned")
    + enum("order_status", "Completed", "Partial", "Unfulfilled", "Cancelled")
    + whole("order_year", bounds=(2020, 2026))
    + text("cancel_reason", "return_reason", "rma_no")
    + label("year", "month"),
    partitions=("year", "month"),
    date_formats=TWO_FORMATS,
    min_date_length=1,
    critical_date="order_date",
    references=(
        Reference("customer_id", "customers", "customer_id"),
        Reference("product_id", "products_master", "product_id"),
        # plant_code carries the surrogate plant_id despite its name
        Reference("plant_code", "plant_warehouse", "plant_id"),
        Reference("batch_id", "product_batches", "batch_id", optional=True),
    ),
)

DIMENSIONS = (
    CUSTOMERS,
    MANUFACTURERS,
    CUSTOMER_PLANT_MAPPING,
    PLANT_WAREHOUSE,
    PRODUCTS_MASTER,
    PRODUCTS_ANNUAL_DEMAND,
    PRODUCT_MANUFACTURER_BRIDGE,
)
FACTS = (PRODUCT_BATCHES, BATCH_ALLOCATOR_CENTRAL, INVENTORY_MOVEMENTS, ORDERS)
TABLES = {t.name: t for t in DIMENSIONS + FACTS}

# Published row counts per table.
ROW_COUNTS = {
    "customers": 2_500,
    "manufacturers": 10,
    "customer_plant_mapping": 3_384,
    "plant_warehouse": 57,
    "products_master": 702,
    "products_annual_demand": 702,
    "product_manufacturer_bridge": 702,
    "orders": 3_596_681,
    "inventory_movements": 1_042_914,
    "product_batches": 23_658,
    "batch_allocator_central": 94_306,
}

# Expected product domains.
FORMULATIONS = (
    "Tablet", "Injection", "Oral Suspension", "Powder for Injection", "Oral Drops",
    "Dry Syrup", "Capsule", "Syrup", "Cream", "Ointment",
)
PACKING_TYPES = ("Strip", "Vial", "Bottle", "Box", "Tube", "Sachet")
GST_RATES = (0, 5, 12, 18, 28)
