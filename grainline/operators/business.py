"""Business rules of the model, on the columns of ``catalog``.

Each function takes ``get``, which turns a column name into an expression: ``F.col`` on a typed table, or the typed
projection of a raw column inside the curation job. They report (WARN); what blocks a publication is decided elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainline import catalog
from grainline.functions.compare import close_to
from grainline.operators.curation import convert
from grainline.operators.rules import Rule
from grainline.spec import TableSpec

Get = Callable[[str], Column]


def movement_rules(get: Get = F.col, on_breach: str = "FAIL") -> list[Rule]:
    """What each movement type demands of its two plants, and positive units."""
    kind, a, b = get("movement_type"), get("from_plant_id"), get("to_plant_id")
    needs_both = a.isNull() | b.isNull()
    broken = ((kind == "IN") & a.isNotNull()) | (kind.isin("TRANSFER", "Central_Movement") & needs_both)
    return [
        Rule("movement_semantics", "Business Logic", broken, on_breach=on_breach),
        Rule("units_positive", "Business Logic", get("units") <= 0, "violation", on_breach=on_breach),
    ]


def expiry_rules(get: Get = F.col, on_breach: str = "FAIL") -> list[Rule]:
    """A batch expires after it was made."""
    return [Rule("expiry_after_mfg", "Business Logic", get("expiry_date") <= get("mfg_date"), on_breach=on_breach)]


def positive_rules(get: Get, *names: str, on_breach: str = "FAIL") -> list[Rule]:
    return [Rule(f"positive:{n}", "Bounds", get(n) <= 0, on_breach=on_breach) for n in names]


def coordinate_rules(get: Get = F.col, on_breach: str = "FAIL") -> list[Rule]:
    return [
        Rule(f"bounds:{n}", "Bounds", ~get(n).between(-most, most), on_breach=on_breach) for n, most in (("latitude", 90), ("longitude", 180))
    ]


def domain_rule(get: Get, name: str, values) -> Rule:
    """Values outside a known list, whatever the case."""
    known = [str(v).lower() for v in values]
    return Rule(f"domain:{name}", "Domain", ~F.lower(get(name).cast("string")).isin(known), on_breach="WARN")


# Tolerance of a line price against its bounds and of recomputed amounts.
PRICE_TOLERANCE, AMOUNT_TOLERANCE = 0.05, 0.01


def order_rules(get: Get = F.col, on_breach: str = "FAIL") -> list[Rule]:
    """Order lines: price bounds, tax and total, batch link, status against quantities, order of dates, year.

    The order price is that of the whole line, so its bounds are those of one unit times the quantity. A comparison with a
    missing value is no violation, but amounts are compared with 0 for a missing one.
    """
    price, quantity = get("order_price").cast("double"), get("order_qty")
    floor, most = get("floor_price").cast("double") * quantity, get("mrp").cast("double") * quantity
    net, tax = get("net_line_amount").cast("double"), get("gst_amount").cast("double")
    status, delivered, invoiced = get("line_status"), get("delivery_qty"), get("invoice_qty")
    linked, shipped = get("batch_id").isNotNull(), F.coalesce(delivered > 0, F.lit(False))
    ordered_on, delivered_on, invoiced_on = get("order_date"), get("actual_delivery_date"), get("invoice_date")
    expected = {
        "tax": (get("gst_amount"), net * get("gst_rate").cast("double") / 100),
        "total": (get("total_line_amount_incl_gst"), net + tax),
    }
    rules = [
        ("price_bounds", "Price", (price < floor * (1 - PRICE_TOLERANCE)) | (price > most * (1 + PRICE_TOLERANCE))),
        *[(f"{n}_recomputed", "Price", ~close_to(actual, wanted, AMOUNT_TOLERANCE)) for n, (actual, wanted) in expected.items()],
        ("batch_without_delivery", "Linkage", linked & ~shipped),
        ("delivery_without_batch", "Linkage", shipped & ~linked),
        ("ordered_but_delivered", "Status", (status == "Ordered") & shipped),
        ("delivered_without_quantity", "Status", (status == "Delivered") & (delivered == 0)),
        ("invoiced_beyond_delivery", "Quantities", (status == "Invoiced") & (invoiced > delivered)),
        ("delivery_before_order", "Dates", delivered_on < ordered_on),
        ("invoice_before_delivery", "Dates", invoiced_on < delivered_on),
        ("order_year", "Dates", get("order_year") != F.year(ordered_on)),
    ]
    return [Rule(n, category, broken, on_breach=on_breach) for n, category, broken in rules]


def business_rules(spec: TableSpec) -> list[Rule]:
    """The rules of a catalog table, stated on its raw text; none for other tables."""
    get = lambda name: convert(spec.column(name), spec)
    found = {
        "product_batches": lambda: expiry_rules(get, "WARN") + positive_rules(get, "batch_size_units", "unit_mrp", on_breach="WARN"),
        "batch_allocator_central": lambda: expiry_rules(get, "WARN") + positive_rules(get, "units_allocated", on_breach="WARN"),
        "inventory_movements": lambda: movement_rules(get, "WARN") + expiry_rules(get, "WARN"),
        "orders": lambda: order_rules(get, "WARN"),
        "plant_warehouse": lambda: coordinate_rules(get, "WARN"),
        "product_manufacturer_bridge": lambda: positive_rules(get, "price", on_breach="WARN"),
        "products_master": lambda: positive_rules(get, "price", "pack_count", on_breach="WARN") + [
            domain_rule(get, "formulation", catalog.FORMULATIONS), domain_rule(get, "packing_type", catalog.PACKING_TYPES),
            Rule("domain:gst_rate", "Domain", ~get("gst_rate").isin([F.lit(r).cast("decimal(5,2)") for r in catalog.GST_RATES]), on_breach="WARN"),
        ],
    }
    own = {s.name: s for s in (*catalog.DIMENSIONS, *catalog.FACTS)}.get(spec.name)
    return found[spec.name]() if own is spec and spec.name in found else []
