"""Cleaning and casting rules for values that arrive as text.

Every cast is a ``try_`` cast: under ANSI mode a plain cast would fail the whole job on
one bad value, while here a bad value becomes NULL and is counted by a rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts accepted in the exports, in the order they are tried.
ISO, DAY_FIRST, SLASHED = "yyyy-MM-dd", "dd-MM-yyyy", "yyyy/MM/dd"
TWO_FORMATS = (ISO, DAY_FIRST)
THREE_FORMATS = (ISO, DAY_FIRST, SLASHED)

# Accepted spellings of true and false per encoding (compared in upper case).
FLAG_WORDS = {
    "yes_no": ("YES", "NO"),
    "zero_one": ("1", "0"),
    "true_false": ("TRUE", "FALSE"),
}

# Texts that stand for "no value" (compared trimmed, in lower case).
PLACEHOLDERS = ("na", "n/a", "none", "unknown", "as directed", "nan")

_WHOLE = r"^[+-]?[0-9]+(\.0+)?$"
_MEASURE = r"^([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z%]+)?(?:\s*/\s*([0-9]+(?:\.[0-9]+)?)?\s*([A-Za-z]+))?$"


def clean_text(c: Column) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def clean_number(c: Column) -> Column:
    """Trimmed digits without thousands commas; blank becomes NULL. Still text."""
    return F.nullif(F.trim(F.replace(c, F.lit(","), F.lit(""))), F.lit(""))


def to_int(c: Column) -> Column:
    """Whole number; an all-zero fraction such as ``1004.0`` is accepted."""
    digits = clean_number(c)
    return F.when(digits.rlike(_WHOLE), digits.try_cast("decimal(20,4)").try_cast("int"))


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    return clean_number(c).try_cast(f"decimal({precision},{scale})")


def to_double(c: Column) -> Column:
    return clean_number(c).try_cast("double")


def canonical(c: Column, values: tuple[str, ...]) -> Column:
    """The listed spelling of a value, matched without regard to case; NULL when unlisted."""
    spelling = F.create_map(*[F.lit(x) for v in values for x in (v.upper(), v)])
    return F.try_element_at(spelling, F.upper(F.trim(c)))


def unlisted(c: Column, values: tuple[str, ...]) -> Column:
    """True for a raw non-blank value outside the list. Must see the value before ``canonical``."""
    return clean_text(c).isNotNull() & ~F.upper(F.trim(c)).isin([v.upper() for v in values])


def within(c: Column, low, high) -> Column:
    """The value when low <= value <= high, otherwise NULL."""
    return F.when(c.between(low, high), c)


def date_text(c: Column, min_length: int = 1) -> Column:
    """Date text without its ISO time suffix; blank or too short becomes NULL."""
    t = F.trim(c)
    return F.when(F.length(t) >= max(min_length, 1), F.substring_index(t, "T", 1))


def to_date(c: Column, formats: tuple[str, ...] = TWO_FORMATS, min_length: int = 1) -> Column:
    """Date from text in any of the layouts of yyyy, MM and dd.

    Each layout is rewritten to the ISO one, then one strict match feeds one cast. A value
    that fits no layout costs no exception in the JVM, and the text is evaluated only once.
    """
    iso = date_text(c, min_length)
    for layout in formats:
        if layout != ISO:
            order = sorted((layout.index(p), p) for p in ("yyyy", "MM", "dd"))
            place = {p: n for n, (_, p) in enumerate(order, start=1)}
            shape = layout.replace("yyyy", "([0-9]{4})").replace("MM", "([0-9]{2})").replace("dd", "([0-9]{2})")
            iso = F.regexp_replace(iso, f"^{shape}$", f"${place['yyyy']}-${place['MM']}-${place['dd']}")
    return F.regexp_extract(iso, "^((?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2})$", 1).try_cast("date")


def to_flag(c: Column, encodings: tuple[str, ...] = tuple(FLAG_WORDS)) -> Column:
    """Boolean from any of the named encodings; everything else is NULL."""
    word = F.upper(F.trim(c))
    if "zero_one" in encodings:
        number = F.regexp_replace(word, r"^\+?([01])\.0+$", "$1")
        word = F.coalesce(number, word)
    yes = [FLAG_WORDS[e][0] for e in encodings]
    no = [FLAG_WORDS[e][1] for e in encodings]
    return F.when(word.isin(yes), F.lit(True)).when(word.isin(no), F.lit(False))


def is_placeholder(c: Column) -> Column:
    """True for NULL and for texts that stand for "no value"."""
    return c.isNull() | F.lower(F.trim(c)).isin(list(PLACEHOLDERS))


def exactly_one_present(a: Column, b: Column) -> Column:
    return a.isNull() != b.isNull()


def starts_with(code: Column, prefix: Column) -> Column:
    """Prefix test in which a NULL on either side means no match."""
    return F.coalesce(F.startswith(code, prefix), F.lit(False))


def split_measure(c: Column) -> Column:
    """``250mg/5ml`` as struct(amount, unit, per_amount, per_unit); all NULL when unreadable.

    ``per_amount`` is 1 for a bare ``mg/ml``.
    """
    t = F.trim(c)

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(t, _MEASURE, i), F.lit(""))

    per_unit = F.lower(part(4))
    per_amount = F.coalesce(part(3), F.when(per_unit.isNotNull(), F.lit("1")))
    return F.struct(
        part(1).try_cast("decimal(18,4)").alias("amount"),
        F.lower(part(2)).alias("unit"),
        per_amount.try_cast("decimal(18,4)").alias("per_amount"),
        per_unit.alias("per_unit"),
    )
