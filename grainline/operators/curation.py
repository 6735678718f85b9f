"""Typed projection of an all-text table, and the conversion rules that go with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.functions import cleaning as c
from grainline.operators.rules import Rule
from grainline.spec import ColumnSpec, TableSpec


def convert(col: ColumnSpec, spec: TableSpec) -> Column:
    """The typed expression for one column."""
    raw = F.col(col.name)
    if col.kind in ("key", "partition"):
        return raw
    if col.kind == "text":
        return c.clean_text(raw)
    if col.kind == "enum":
        return c.canonical(raw, col.values)
    if col.kind == "int":
        number = c.to_int(raw)
        return c.within(number, *col.bounds) if col.bounds else number
    if col.kind == "decimal":
        return c.to_decimal(raw, col.type.precision, col.type.scale)
    if col.kind == "double":
        return c.to_double(raw)
    if col.kind == "date":
        return c.to_date(raw, spec.date_formats, spec.min_date_length)
    if col.kind == "flag":
        return c.to_flag(raw, col.encodings)
    raise ValueError(f"unknown kind {col.kind!r} of {spec.name}.{col.name}")


def typed(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """All columns of the specification, in order, in one projection. Keeps every row."""
    return raw.select(*[convert(col, spec).alias(col.name) for col in spec.columns])


def conversion_rules(spec: TableSpec) -> list[Rule]:
    """Rules on the raw frame: a value was present and the conversion lost it.

    They must see the raw text; after normalisation an invalid value is already NULL.
    """
    found: list[Rule] = []
    for col in spec.columns:
        raw = F.col(col.name)
        after = convert(col, spec)
        if col.kind == "enum":
            found.append(
                Rule(f"enum_invalid:{col.name}", "Domain", c.unlisted(raw, col.values), limit_pct=100.0, on_breach="WARN")
            )
        elif col.kind == "date":
            lost = c.date_text(raw, spec.min_date_length).isNotNull() & after.isNull()
            found.append(Rule(f"date_parse:{col.name}", "Conversion", lost, limit_pct=col.limit_pct))
        elif col.kind in ("int", "decimal", "double"):
            number = c.to_int(raw) if col.kind == "int" else after
            lost = c.clean_number(raw).isNotNull() & number.isNull()
            found.append(
                Rule(f"cast:{col.name}", "Conversion", lost, limit_pct=col.limit_pct, on_breach=col.on_breach)
            )
            if col.bounds:
                out = number.isNotNull() & after.isNull()
                found.append(Rule(f"out_of_range:{col.name}", "Domain", out, limit_pct=100.0, on_breach="WARN"))
        elif col.kind == "flag":
            lost = c.clean_text(raw).isNotNull() & after.isNull()
            found.append(Rule(f"cast:{col.name}", "Conversion", lost, limit_pct=col.limit_pct))
    return found


def table_rules(spec: TableSpec, critical_null_pct: float = 2.0, year_mismatch_pct: float = 1.0) -> list[Rule]:
    """Key, critical-date and partition rules, stated on the raw frame like the conversion rules."""
    found = [
        Rule(
            "key_null",
            "Grain",
            F.array_contains(F.array(*[c.clean_text(F.col(k)).isNull() for k in spec.key]), True),
        )
    ]
    if spec.critical_date:
        day = convert(spec.column(spec.critical_date), spec)
        found.append(
            Rule(f"critical_null:{spec.critical_date}", "Nulls", day.isNull(),
                 limit_pct=critical_null_pct, within_limit="PASS")
        )
    if spec.year_label:
        named, dated = spec.year_label
        day = convert(spec.column(dated), spec)
        wrong = day.isNotNull() & (F.col(named) != F.year(day).cast("string"))
        found.append(Rule(f"partition_year:{named}", "Partition", wrong,
                          limit_pct=year_mismatch_pct, within_limit="PASS"))
    return found
