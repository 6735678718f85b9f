from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from grainline import catalog
from grainline.functions import cleaning as c
from grainline.functions.compare import close_to
from grainline.operators.curation import conversion_rules, typed
from grainline.operators.rules import evaluate
from grainline.spec import TableSpec, date as date_col, enum, flag, key, money, real, whole


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_text(spark):
    assert apply(spark, [" a ", "", "  ", None, "b c"], c.clean_text) == ["a", None, None, None, "b c"]


def test_thousands_commas(spark):
    assert apply(spark, [" 1,234.50 ", ",", "", None], c.clean_number) == ["1234.50", None, None, None]


def test_whole_numbers(spark):
    given = ["1004", "1004.0", "1004.000", "-7", "+7", "1004.5", "1e3", "abc", "", None, "99999999999", "1,000"]
    assert apply(spark, given, c.to_int) == [1004, 1004, 1004, -7, 7, None, None, None, None, None, None, 1000]


def test_decimal_follows_declared_scale(spark):
    assert apply(spark, ["12.345", "1,000", "x"], lambda v: c.to_decimal(v, 5, 2)) == [Decimal("12.35"), None, None]
    assert apply(spark, ["1,000.5"], lambda v: c.to_decimal(v, 18, 2)) == [Decimal("1000.50")]


def test_two_date_formats(spark):
    given = ["2022-03-04", "04-03-2022", "2022-03-04T10:11:12", "2022/03/04", "2022-02-30", "2022-3-4", "", None, "junk", "0000-01-01"]
    d = date(2022, 3, 4)
    assert apply(spark, given, c.to_date) == [d, d, d, None, None, None, None, None, None, None]


def test_three_date_formats_and_short_text(spark):
    def parse(v):
        return c.to_date(v, c.THREE_FORMATS, 8)

    given = ["2022/03/04", "04-03-2022", "2022", "1-1-22", "  2022-03-04  "]
    d = date(2022, 3, 4)
    assert apply(spark, given, parse) == [d, d, None, None, d]
    assert apply(spark, given, lambda v: c.date_text(v, 8))[2:4] == [None, None]


def test_date_layouts_agree_with_spark_formatter(spark):
    given = ["2024-02-29", "2023-02-29", "29-02-2024", "31-04-2022", "2022-13-01", "12-31-2022", "2022-12-31x", "x2022-12-31", "20-2-12-31"]
    ours = apply(spark, given, c.to_date)
    plain = apply(spark, given, lambda v: F.coalesce(F.try_to_date(v, "yyyy-MM-dd"), F.try_to_date(v, "dd-MM-yyyy")))
    assert ours == plain


def test_flags(spark):
    given = ["1", "0", "1.0", "yes", " No ", "TRUE", "false", "2", "maybe", "", None]
    assert apply(spark, given, c.to_flag) == [True, False, True, True, False, True, False, None, None, None, None]
    assert apply(spark, ["1", "Yes"], lambda v: c.to_flag(v, ("yes_no",))) == [None, True]


def test_enum_is_counted_on_the_raw_value(spark):
    values = ("Cash", "UPI")
    given = [" cash", "upi", "-", "", None]
    assert apply(spark, given, lambda v: c.canonical(v, values)) == ["Cash", "UPI", None, None, None]
    assert apply(spark, given, lambda v: c.unlisted(v, values)) == [False, False, True, False, False]


def test_placeholders_and_pairs(spark):
    assert apply(spark, ["N/A ", None, "as directed", "5"], c.is_placeholder) == [True, True, True, False]
    assert apply(spark, ["5", None], lambda v: c.exactly_one_present(v, F.lit("mg"))) == [False, True]
    assert apply(spark, ["AB-1", "B-1", None], lambda v: c.starts_with(v, F.lit("AB"))) == [True, False, False]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("250mg/5ml", (Decimal("250.0000"), "mg", Decimal("5.0000"), "ml")),
        ("2.5 MG/ml", (Decimal("2.5000"), "mg", Decimal("1.0000"), "ml")),
        ("500", (Decimal("500.0000"), None, None, None)),
        ("as directed", (None, None, None, None)),
    ],
)
def test_split_measure(spark, text, expected):
    assert tuple(apply(spark, [text], c.split_measure)[0]) == expected


def test_close_to_follows_the_expected_side(spark):
    df = spark.createDataFrame([(100.0, 101.0), (101.0, 100.0), (None, None), (None, 5.0)], "a double, b double")
    got = [r[0] for r in df.select(close_to(F.col("a"), F.col("b"))).collect()]
    assert got == [True, True, True, False]
    edge = spark.createDataFrame([(100.0, 101.005), (101.005, 100.0)], "a double, b double")
    assert [r[0] for r in edge.select(close_to(F.col("a"), F.col("b"))).collect()] == [True, False]


JUNK = TableSpec(
    "junk", "fact", ("id",),
    key("id") + whole("n", limit_pct=0.0) + money("m") + real("r") + date_col("d") + enum("e", "A") + flag("f", "yes_no")
    + whole("y", bounds=(2020, 2026)),
)


def test_junk_never_fails_the_job(spark):
    words = ["abc", "", None, "1e999", "--", "9" * 40, "NaN", "2022-99-99", "٣"]
    df = spark.createDataFrame([(str(i), *[w] * 7) for i, w in enumerate(words)], JUNK.raw_schema)
    out = typed(df, JUNK)
    assert out.count() == len(words)
    assert [f.dataType for f in out.schema] == [f.dataType for f in JUNK.schema]
    results = {r.rule_id: r.violations for r in evaluate(df, conversion_rules(JUNK), "junk").collect()}
    assert results["cast:n"] == 7
    assert results["enum_invalid:e"] == 7
    assert results["cast:f"] == 7


def test_year_bounds(spark):
    df = spark.createDataFrame([("1", "2019"), ("2", "2020"), ("3", "2027"), ("4", "x")], "id string, y string")
    spec = TableSpec("t", "fact", ("id",), key("id") + whole("y", bounds=(2020, 2026)))
    assert [r.y for r in typed(df, spec).orderBy("id").collect()] == [None, 2020, None, None]
    results = {r.rule_id: r.violations for r in evaluate(df, conversion_rules(spec)).collect()}
    assert results == {"cast:y": 1, "out_of_range:y": 2}


def test_catalog_shape():
    assert len(catalog.TABLES) == 11
    assert len(catalog.ORDERS.columns) == 44
    assert sum(len(t.references) for t in catalog.TABLES.values()) == 22  # 21 published keys and the parent plant
    assert catalog.ORDERS.schema["gst_rate"].dataType.simpleString() == "decimal(5,2)"
    assert set(catalog.ROW_COUNTS) == set(catalog.TABLES)
