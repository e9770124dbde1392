"""Single-column cleaning rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from listing_lake import rules
from listing_lake.functions.casts import lenient_double


def text_or(text: Column, default: str) -> Column:
    """Trimmed text, or the default where nothing is left."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(default))


def area_in_marla(unit: Column, size: Column) -> Column:
    amount = lenient_double(size)
    large = unit.ilike(rules.LARGE_AREA_UNIT)
    return F.when(large, amount * rules.MARLA_PER_LARGE_UNIT).otherwise(amount)


def capped_price(price: Column) -> Column:
    # not least(): it would turn a NULL price into the cap
    cap = F.lit(rules.PRICE_CAP).cast("long")
    return F.when(price > cap, cap).otherwise(price)


def price_per_area(raw_price: Column, area: Column) -> Column:
    return F.when(area > 0, raw_price / area)


def fenced(value: Column, bounds: tuple[float, float]) -> Column:
    return F.when(value.between(*bounds), value)


def url_digest(url: Column) -> Column:
    return F.sha2(url, 256)


def property_category(bedrooms: Column, property_type: Column) -> Column:
    return F.when(bedrooms == 0, F.lit(rules.PLOT_CATEGORY)).otherwise(property_type)


def _by_purpose(purpose: Column, values: dict) -> Column:
    branches = iter(values.items())
    name, value = next(branches)
    first = F.when(purpose == name, F.lit(value))
    return reduce(lambda case, kv: case.when(purpose == kv[0], F.lit(kv[1])), branches, first)


def is_anomaly(price: Column, purpose: Column) -> Column:
    floor = _by_purpose(purpose, rules.ANOMALY_BELOW)
    return F.coalesce(price < floor, F.lit(False))


def gold_table(purpose: Column) -> Column:
    """Name of the Gold table for a purpose, NULL where none takes it."""
    return _by_purpose(purpose, rules.GOLD_TABLES)
