"""Declarative table specifications."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from grainline.functions.cleaning import THREE_FORMATS


@dataclass(frozen=True)
class ColumnSpec:
    """One target column and the cleaning rule that fills it.

    ``kind`` is one of key, text, enum, int, decimal, double, date, flag, partition.
    ``limit_pct`` is the share of failed conversions that is tolerated.
    """

    name: str
    kind: str
    type: T.DataType
    nullable: bool = True
    values: tuple[str, ...] = ()
    bounds: tuple[int, int] | None = None
    encodings: tuple[str, ...] = ()
    limit_pct: float = 0.0
    on_breach: str = "FAIL"


@dataclass(frozen=True)
class Reference:
    """A foreign key. ``optional`` keys are checked only where they are filled."""

    column: str
    parent: str
    parent_column: str
    optional: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    role: str  # "dimension" or "fact"
    key: tuple[str, ...]
    columns: tuple[ColumnSpec, ...]
    partitions: tuple[str, ...] = ()
    date_formats: tuple[str, ...] = THREE_FORMATS
    min_date_length: int = 8
    critical_date: str | None = None
    year_label: tuple[str, str] | None = None  # (partition column, date column)
    alternate_keys: tuple[tuple[str, ...], ...] = ()
    references: tuple[Reference, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, c.nullable) for c in self.columns])

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T.StringType()) for c in self.columns])

    def column(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name == name)


def key(*names: str) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(n, "key", T.StringType(), nullable=False) for n in names)


def key_int(*names: str) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(n, "int", T.IntegerType(), nullable=False) for n in names)


def text(*names: str) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(n, "text", T.StringType()) for n in names)


def enum(name: str, *values: str) -> tuple[ColumnSpec, ...]:
    return (ColumnSpec(name, "enum", T.StringType(), values=values, on_breach="WARN"),)


def whole(*names: str, limit_pct: float = 1.0, bounds=None, on_breach="FAIL") -> tuple[ColumnSpec, ...]:
    return tuple(
        ColumnSpec(n, "int", T.IntegerType(), bounds=bounds, limit_pct=limit_pct, on_breach=on_breach)
        for n in names
    )


def ids(*names: str) -> tuple[ColumnSpec, ...]:
    """Whole-number identifiers: no failed conversion is tolerated."""
    return whole(*names, limit_pct=0.0)


def money(*names: str, precision: int = 18) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(n, "decimal", T.DecimalType(precision, 2), limit_pct=1.0) for n in names)


def real(*names: str) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(n, "double", T.DoubleType(), limit_pct=1.0) for n in names)


def date(*names: str, nullable: bool = True, limit_pct: float = 5.0) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(n, "date", T.DateType(), nullable, limit_pct=limit_pct) for n in names)


def flag(name: str, encoding: str) -> tuple[ColumnSpec, ...]:
    return (ColumnSpec(name, "flag", T.BooleanType(), encodings=(encoding,)),)


def label(*names: str) -> tuple[ColumnSpec, ...]:
    """Partition labels, taken from the path as text and never recalculated."""
    return tuple(ColumnSpec(n, "partition", T.StringType(), nullable=False) for n in names)
