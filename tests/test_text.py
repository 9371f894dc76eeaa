import pytest
from pyspark.sql import functions as F

from staylens.functions import geo, stay, text

NUMBERS = [
    ("120.50", 120.5),
    ("€ 120,50", 120.5),
    ("€\xa0120,50", 120.5),
    ("1.101", 1101.0),
    ("758.000", 758.0),
    ("1.234,56", 1234.56),
    ("1,234.56", 1234.56),
    ("1,101", 1101.0),
    ("1,000", 1000.0),
    ("8,50", 8.5),
    ("8.5", 8.5),
    ("1.000.500", 1000500.0),
    ("2.000.000", 2.0),
    ("-5", 5.0),
    ("1.2.3", None),
    ("", None),
    (None, None),
    ("abc", None),
]


def test_parse_number(spark):
    df = spark.createDataFrame([(t,) for t, _ in NUMBERS], "t string")
    got = [r.n for r in df.select(text.parse_number(F.col("t")).alias("n")).collect()]
    assert got == [n for _, n in NUMBERS]


def test_parse_digits(spark):
    df = spark.createDataFrame([("342 reviews",), ("26,485",), ("abc",), (None,)], "t string")
    got = [r.n for r in df.select(text.parse_digits(F.col("t")).alias("n")).collect()]
    assert got == [342, 26485, None, None]


def test_area_is_sanitised_and_split(spark):
    df = spark.createDataFrame(
        [("Tirana, Albania",), ("New York/Manhattan",), ("São Paulo, Brazil",), ("Amsterdam",)],
        "a string",
    )
    area = text.sanitise_area(F.col("a"))
    rows = df.select(
        area.alias("s"), text.city_of(area).alias("c"), text.country_of(area).alias("k")
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("Tirana__Albania", "Tirana", "Albania"),
        ("New_York_Manhattan", "New_York_Manhattan", ""),
        ("São_Paulo__Brazil", "São_Paulo", "Brazil"),
        ("Amsterdam", "Amsterdam", ""),
    ]


def test_strip_removes_every_unicode_blank(spark):
    df = spark.createDataFrame([("\xa0\n a b  ",)], "t string")
    assert df.select(text.strip(F.col("t")).alias("t")).first().t == "a b"


def test_round_places_scales_the_binary_value(spark):
    row = spark.range(1).select(
        stay.round_places(F.lit(1.005), 2).alias("a"), stay.round_places(F.lit(2.5), 0).alias("b")
    ).first()
    assert (row.a, row.b) == (1.0, 3.0)


def test_prices_are_null_for_zero_units(spark):
    row = spark.range(1).select(
        stay.price_per(F.lit(100.0), F.lit(0)).alias("a"),
        stay.price_per(F.lit(100.0), F.lit(3)).alias("b"),
        stay.num_nights(F.lit("2024-02-01"), F.lit("2024-02-03")).alias("n"),
        stay.num_nights(F.lit("not a date"), F.lit("2024-02-03")).alias("m"),
    ).first()
    assert (row.a, row.b, row.n, row.m) == (None, 33.33, 2, None)


def test_surrogate_key(spark):
    key = stay.surrogate_key(
        "BOOK",
        F.lit("Tirana"),
        F.lit("Albania"),
        F.lit("book-001"),
        F.lit("2026-06-01"),
        F.lit("2026-06-07"),
        F.lit("2026-05-01").cast("date"),
    )
    assert (
        spark.range(1).select(key.alias("k")).first().k
        == "BOOK/tiranaALBANIA/book_001/20260601_20260607/20260501"
    )


def test_haversine(spark):
    row = spark.range(1).select(
        geo.haversine_km(F.lit(60.0), F.lit(5.0), F.lit(60.0), F.lit(6.0)).alias("d"),
        geo.haversine_km(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("n"),
    ).first()
    assert row.d == pytest.approx(55.597, abs=0.01)
    assert row.n is None
