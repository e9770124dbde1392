"""Golden rows of the scalar rules."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from listing_lake import rules
from listing_lake.functions import casts, cleaning, naming

DAY = dt.date(2025, 3, 1)


def check(spark, rule, cases, columns=("text",)):
    rows = [(i, *(k if isinstance(k, tuple) else (k,))) for i, k in enumerate(cases)]
    schema = "i int, " + ", ".join(f"{c} string" for c in columns)
    df = spark.createDataFrame(rows, schema).select(
        "i", rule(*[F.col(c) for c in columns]).alias("value")
    )
    found = {r["i"]: r["value"] for r in df.collect()}
    got = {k: found[i] for i, k in enumerate(cases)}
    assert got == cases


def test_long(spark):
    check(spark, casts.lenient_long, {
        "42": 42, " 42 ": 42, "+5": 5, "3.7": 4, "2.5": 3, "-2.5": -3, "1e5": 100000,
        "12500000.0": 12500000, "1e-1": 0, ".5": 1, "5.": 5, "0.49999999999999": 0,
        "9223372036854775807": 2**63 - 1, "-9223372036854775808": -(2**63),
        "1,000": None, "": None, "abc": None, "NaN": None, "9223372036854775808": None,
        "1e30": None, None: None, "1_000": 1000, "1__0": None, "0x1F": 31, "0b11": 3, "-0x1F": None,
        "0.4999999999999999999999": 0, "-9223372036854775808.4": -(2**63), "9223372036854775807.5": None,
        "0xffffffffffffffff": None, "0b" + "1" * 63: 2**63 - 1, "1_0e1_0": 10**11,
    })


def test_int(spark):
    check(spark, casts.lenient_int, {
        "1.0": 1, "2.5": 3, "2147483647": 2147483647, "2147483648": None, "x": None,
    })


def test_double(spark):
    check(spark, casts.lenient_double, {
        "1.5": 1.5, " 1.5 ": 1.5, "1e3": 1000.0, "-.5": -0.5, "1.5f": None, "1d": None,
        "1,5": None, "": None, "n/a": None, "1_000": 1000.0, "0x1F": None, "inf": math.inf, "-Infinity": -math.inf, None: None,
    })
    one = spark.range(1).select(casts.lenient_double(F.lit("nan")).alias("v")).first()["v"]
    assert math.isnan(one)


def test_date(spark):
    good = ["2025-03-01", "2025-3-1", "2025/03/01", "2025 03 01", " 2025-03-01 ",
            "2025-03-01 10:00:00", "March 1, 2025", "MARCH 1, 2025", " March  01,  2025 ",
            "03-01-2025", "3-1-2025", "3/1/2025", "03/01/2025", "2025-03-01 1:30", "2025-03-01 24:00:00", "2025\\03\\01"]
    bad = ["2025", "2025-03", "20250301", "2025/3-1", "Mar 1, 2025", "13-01-2025",
           "February 30, 2025", "2025-02-30", "########", "2025-03-01#", "", "unknown", None,
           "2025-03-01 junk", "2025-03-01 10", "2025-03-01 24:00:01"]
    check(spark, casts.lenient_date, {**dict.fromkeys(good, DAY), **dict.fromkeys(bad)})
    check(spark, casts.lenient_date, {
        "3-1-25": dt.date(3, 1, 25), "3-13-25": dt.date(25, 3, 13), "3/1/125": dt.date(125, 3, 1),
        "March 1, 25": dt.date(25, 3, 1),
    })


def test_text_defaults(spark):
    check(spark, lambda c: cleaning.text_or(c, "D"), {
        None: "D", "": "D", "   ": "D", " X ": "X", "\t": "\t",
    })


def test_area(spark):
    check(spark, cleaning.area_in_marla, {
        ("Kanal", "2"): 40.0, ("kANAL", "2"): 40.0, ("Kanal ", "2"): 2.0, ("Marla", "5"): 5.0,
        (None, "5"): 5.0, ("Kanal", "n/a"): None, (None, None): None,
    }, ("unit", "size"))


def test_price_rules(spark):
    def cap(c):
        return cleaning.capped_price(c.cast("long"))

    check(spark, cap, {"500000000": 500000000, "500000001": 500000000, "7": 7, None: None})

    def ratio(p, a):
        return cleaning.price_per_area(p.cast("long"), a.cast("double"))

    check(spark, ratio, {
        ("600000000", "20"): 30000000.0, ("5", "0"): None, ("5", None): None, (None, "5"): None,
    }, ("price", "area"))


@pytest.mark.parametrize("bounds,cases", [
    (rules.LATITUDE_RANGE, {"24.0": 24.0, "37.0": 37.0, "23.9": None, "37.1": None, "NaN": None}),
    (rules.LONGITUDE_RANGE, {"61.0": 61.0, "78.0": 78.0, "78.1": None, None: None}),
])
def test_fence(spark, bounds, cases):
    check(spark, lambda c: cleaning.fenced(casts.lenient_double(c), bounds), cases)


def test_category_and_anomaly(spark):
    def category(b, t):
        return cleaning.property_category(b.cast("int"), t)

    check(spark, category, {
        ("0", "House"): "Plot/Land", ("3", "House"): "House", (None, "House"): "House",
    }, ("b", "t"))

    def anomaly(p, purpose):
        return cleaning.is_anomaly(p.cast("long"), purpose)

    check(spark, anomaly, {
        ("99999", "For Sale"): True, ("100000", "For Sale"): False, ("999", "For Rent"): True,
        ("1000", "For Rent"): False, (None, "For Sale"): False,
    }, ("p", "purpose"))


def test_names(spark):
    check(spark, naming.snapshot_date, {
        "p_2025-03-01_2025-04-01.x": DAY, "x": None, "p_2025-13-01.csv": None,
    })
    check(spark, naming.snapshot_text, {"x": "", "a2025-03-01b": "2025-03-01"})
    check(spark, naming.is_landing_name, {"a_1.csv": True, "010.jpg.csv": False, "a.csv.gz": False})
    check(spark, lambda n: naming.silver_name(naming.bronze_name(n)), {"a.csv": "a_clean.parquet"})
    check(spark, naming.unique_bronze_name, {
        ("property_1.csv", "0123456789ab"): "property_1_0123456789ab.parquet",
        ("010.jpg.csv", "0123456789ab"): "010.jpg_0123456789ab.parquet",
    }, ("name", "hash"))
    check(spark, lambda c: F.length(naming.error_text(c)), {"e" * 900: 500, "short": 5})
