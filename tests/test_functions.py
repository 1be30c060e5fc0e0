from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbrow.functions.dates import (
    days_between,
    days_outside_year,
    disclosure_year,
    seconds_between,
    swapped_disclosure_year,
)
from plumbrow.functions.keys import join_same, row_hash
from plumbrow.functions.text import (
    blank_to_null,
    is_variance_like,
    join_labels,
    normalised_unit,
    number_text,
    text_to_double,
)


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return row.select(column).first()[0]


def text(spark, function, value):
    return one(spark, function(F.col("x").cast("string")), x=value)


def test_row_hash_sees_where_the_nulls_are(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), (None, None)], "x string, y string")
    assert rows.select(row_hash(["x", "y"]).alias("h")).distinct().count() == 3


def test_row_hash_is_equal_for_both_zeros(spark):
    rows = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert rows.select(row_hash(["x"]).alias("h")).distinct().count() == 1


def test_null_keys_join_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("b", 20)], "k string, w int")
    assert [tuple(r) for r in join_same(left, right, ["k"]).collect()] == [(None, 1, 10)]


@pytest.mark.parametrize(
    "unit, key",
    [
        ("$000s", "$000"),
        ("$000", "$000"),
        ("TJ.km", "tjkm"),
        ("TJ km", "tjkm"),
        ("Kilometres", "km"),
        ("metre", "m"),
        ("Ms", "ms"),
        ("$000 s.a_b-c", "$000sabc"),
        ("space", "space"),
        (None, None),
    ],
)
def test_normalised_unit(spark, unit, key):
    assert text(spark, normalised_unit, unit) == key


@pytest.mark.parametrize(
    "value, number",
    [
        ("1,234", 1234.0),
        (" 12.5 ", 12.5),
        ("-3e2", -300.0),
        ("abc", None),
        ("1d", None),
        ("0x1p3", None),
        ("", None),
        (None, None),
    ],
)
def test_text_to_double(spark, value, number):
    assert text(spark, text_to_double, value) == number


def test_labels(spark):
    assert text(spark, blank_to_null, "  ") is None
    assert text(spark, blank_to_null, " a ") == "a"
    parts = [F.lit("a"), F.lit(None).cast("string"), F.lit("b")]
    assert one(spark, join_labels(*parts)) == "a / b"
    assert one(spark, join_labels(F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize(
    "item, varies",
    [("Tax payable", True), ("net cost", True), ("Cabinet", False), ("Against", True)],
)
def test_variance_words_match_inside_words(spark, item, varies):
    assert text(spark, is_variance_like, item) is varies


@pytest.mark.parametrize(
    "value, shown",
    [
        (3.0, "3"),
        (0.0, "0"),
        (0.000123, "0.000123"),
        (0.1234567891, "0.1234567891"),
        (1e-7, "0.0000001"),
        (-2.5e-9, "-0.0000000025"),
        (120.0, "120"),
        (-1.5, "-1.5"),
        (125000000.5, "125000000.5"),
        (1.25e9, "1250000000"),
        (1e30, "1" + "0" * 30),
        (float("inf"), "Infinity"),
        (0.0012345678901234567, "0.0012345678901234567"),
        (1.2345678901234568e-5, "0.000012345678901234568"),
        (-1e-25, "-0." + "0" * 24 + "1"),
        (-1e22, "-1" + "0" * 22),
        (1e7, "10000000"),
    ],
)
def test_number_text(spark, value, shown):
    assert one(spark, number_text(F.col("x")), x=value) == shown


def ntz(value: str):
    return F.lit(value).cast("timestamp_ntz")


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Auckland"])
def test_differences_count_boundaries_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        tenths = seconds_between(ntz("2024-01-01 00:00:00.9"), ntz("2024-01-01 00:00:01.1"))
        # The clocks go back in Auckland in this night.
        night = seconds_between(ntz("2024-04-07 01:30:00"), ntz("2024-04-07 04:30:00"))
        midnight = days_between(ntz("2024-01-01 23:00:00"), ntz("2024-01-02 01:00:00"))
        row = spark.range(1).select(tenths, night, midnight).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (1, 10800, 1)


def test_disclosure_years(spark):
    march, april = ntz("2024-03-31 23:59:59"), ntz("2024-04-01 00:00:00")
    row = spark.range(1).select(
        disclosure_year(march),
        disclosure_year(april),
        swapped_disclosure_year(ntz("2024-01-05 00:00:00")),
        swapped_disclosure_year(ntz("2024-01-13 00:00:00")),
        days_outside_year(march, F.lit(2024)),
        days_outside_year(april, F.lit(2024)),
        days_outside_year(ntz("2023-03-30 12:00:00"), F.lit(2024)),
    )
    assert tuple(row.first()) == (2024, 2025, 2025, None, 0, 1, 2)
