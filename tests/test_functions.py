import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import (blank, canonical_label, code_lookup, first_of_month, format_money,
                                  format_percent, is_finite, lenient_double, month_label, month_number, ordinal,
                                  parse_date, serial_to_date, squish, tidy_name, year_token)
from ledgerlake.config import MONTH_NAMES, PROJECTION_HEADER_LEVELS, PROJECTION_HEADERS


@pytest.mark.parametrize("raw,tidy", [
    ("SubHeader", "sub_header"), ("Header", "header"), ("saldo_inicial_miles", "saldo_inicial_miles"),
    (" Region-Key ", "region_key"), ("enero", "enero"), ("Label", "label"), ("nationName", "nation_name"),
    ("__x__", "x"), ("A1b2C", "a1b2_c"),
])
def test_tidy_name(raw, tidy):
    assert tidy_name(raw) == tidy


def one(spark, expr, value=None, schema="v string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("out")).first()["out"]


def test_squish_and_canonical(spark):
    assert one(spark, squish("v"), "  a \t b   c ") == "a b c"
    assert one(spark, squish("v", null_as_empty=True), None) == ""
    assert one(spark, canonical_label("v"), "  OTROS   ingresos ") == "Otros Ingresos"
    assert one(spark, canonical_label("v"), "Ventas  netas") == "Ventas netas"
    assert one(spark, blank("v"), "   ") is True
    assert one(spark, blank("v"), None) is True
    assert one(spark, blank("v"), "x") is False


def test_month_number_vocabularies(spark):
    assert one(spark, month_number("v"), "SET") == 9
    assert one(spark, month_number("v"), "Sept") is None
    assert one(spark, month_number("v", MONTH_NAMES), "diciembre") == 12
    assert one(spark, month_number("v"), None) is None
    assert one(spark, month_label(F.lit(9))) == "Sept"
    assert one(spark, month_label(F.lit(13))) is None


def test_dates(spark):
    assert one(spark, serial_to_date("v"), "45292") == dt.date(2024, 1, 1)
    assert one(spark, serial_to_date("v"), "45292.75") == dt.date(2024, 1, 1)
    assert one(spark, serial_to_date("v"), "junk") is None
    assert one(spark, parse_date("v"), " 03-04-2020 ") == dt.date(2020, 4, 3)
    assert one(spark, parse_date("v"), "3/4/2020") == dt.date(2020, 4, 3)
    assert one(spark, parse_date("v"), "2020-04-03") == dt.date(2020, 4, 3)
    assert one(spark, parse_date("v"), "April 3") is None
    assert one(spark, first_of_month(F.lit(2025), F.lit(2))) == dt.date(2025, 2, 1)


def test_year_token_and_lenient_cast(spark):
    assert one(spark, year_token("v"), "IV 2024*") == 2024
    assert one(spark, year_token("v"), "I 2025") == 2025
    assert one(spark, year_token("v"), "Total") is None
    assert one(spark, lenient_double("v"), " 12.5 ") == 12.5
    assert one(spark, lenient_double("v"), "n/d") is None
    assert one(spark, is_finite("v"), float("inf"), "v double") is False
    assert one(spark, is_finite("v"), float("nan"), "v double") is False
    assert one(spark, is_finite("v"), None, "v double") is False
    assert one(spark, is_finite("v"), 1.0, "v double") is True


def test_lookups(spark):
    assert one(spark, code_lookup("v", PROJECTION_HEADERS), "E") == "Resultado"
    assert one(spark, code_lookup("v", PROJECTION_HEADERS), "Z") is None
    assert one(spark, code_lookup("v", PROJECTION_HEADERS), None) is None
    assert one(spark, ordinal("v", PROJECTION_HEADER_LEVELS), "Inversiones") == 6
    assert one(spark, ordinal("v", PROJECTION_HEADER_LEVELS), "Otro") is None


def test_display(spark):
    assert one(spark, format_money("v"), 1234567890.0, "v double") == "$ 1.235"
    assert one(spark, format_money("v", "US$ "), -2500000.0, "v double") == "-US$ 3"
    assert one(spark, format_percent("v"), 0.123456, "v double") == "12,35%"
    assert one(spark, format_money("v"), None, "v double") is None


def test_format_guard_regex():
    from ledgerlake.functions.dates import _format_regex
    assert _format_regex("d-M-yyyy") == r"^\d{1,2}\-\d{1,2}\-\d{4}"
    assert _format_regex("yyyy/MM/dd") == r"^\d{4}/\d{2}/\d{2}"
    assert _format_regex("MMM d") is None and _format_regex("d 'de' M") is None


def test_format_amount_by_unit(spark):
    from ledgerlake.functions import format_amount
    df = spark.createDataFrame([(1234567890.0,)], "v double")
    got = df.select(format_amount("v", "valor_usd").alias("a"), format_amount("v", "valor").alias("b"),
                    format_amount("v", "otra").alias("c")).first()
    assert (got["a"], got["b"], got["c"]) == ("US$ 1.235", "$ 1.235", "1.23456789E9")
