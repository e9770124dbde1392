"""Profiles, integrity checks and reports over Silver and Gold.

All counts aggregate before they shuffle, so one city, id or day holding most
of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from listing_lake import rules

HISTORY_COLUMNS = (
    "property_id",
    "city",
    "location",
    "property_type",
    "price",
    "is_current",
    "valid_from",
    "valid_to",
)


def schema_check(df: DataFrame, expected: Sequence[str] = rules.SILVER_CONTRACT) -> DataFrame:
    """One row per expected column: is it there, and how many values has it."""
    counts = df.agg(
        *[F.count(F.col(c) if c in df.columns else F.lit(None)).alias(c) for c in expected]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(c in df.columns).alias("present"),
                F.col(c).alias("non_null"),
            )
            for c in expected
        ]
    )
    return counts.select(F.inline(rows))


def null_profile(
    df: DataFrame, columns: Sequence[str] = rules.CRITICAL_COLUMNS
) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )


def price_by_city(silver: DataFrame, top: int = 5) -> DataFrame:
    """The cities with most listings; averages round half to even."""
    return (
        silver.filter(F.col("city").isNotNull())
        .groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("total_properties"),
            F.bround(F.avg("price"), 0).cast("long").alias("avg_price"),
            F.max("price").alias("max_price"),
        )
        .orderBy(F.desc("total_properties"), "city")
        .limit(top)
    )


# `gold` below carries `table_name`, so that one pass reports on all tables.


def table_counts(gold: DataFrame) -> DataFrame:
    """Rows per table and their share of all rows, from one aggregation."""
    counts = gold.groupBy("table_name").agg(F.count(F.lit(1)).alias("total_rows"))
    # the window runs over one row per Gold table
    everything = F.sum("total_rows").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share_pct", F.round(F.col("total_rows") * 100.0 / everything, 1))


def anomaly_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy("table_name").agg(F.count_if("is_anomaly").alias("anomalies"))


def _by_table(gold: DataFrame, *keys: str) -> list[str]:
    """The keys, within a table where the rows say which; an id may be in both tables."""
    return [*[c for c in ("table_name",) if c in gold.columns], *keys]


def plot_count(gold: DataFrame) -> DataFrame:
    return gold.filter(
        (F.col("property_category") == rules.PLOT_CATEGORY) & (F.col("bedrooms") == 0)
    ).agg(F.count(F.lit(1)).alias("plots"))


def duplicate_active(gold: DataFrame) -> DataFrame:
    """Ids with more than one open version."""
    return (
        gold.filter("is_current")
        .groupBy(*_by_table(gold, "property_id"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .filter("cnt > 1")
    )


def date_type_check(gold: DataFrame, column: str = "date_added") -> DataFrame:
    return gold.groupBy(F.upper(F.typeof(column)).alias("type")).agg(
        F.count(column).alias("valid_dates")
    )


def changed_properties(gold: DataFrame) -> DataFrame:
    return gold.filter("NOT is_current").groupBy(*_by_table(gold)).agg(
        F.count(F.lit(1)).alias("expired_versions"),
        F.countDistinct("property_id").alias("properties_with_history"),
    )


def city_distribution(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy(*_by_table(gold, "city"))
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.sum(F.when(F.col("is_current"), 1).otherwise(0)).alias("active_rows"),
        )
        .orderBy(F.desc("total_rows"), "city")
    )


def versions_per_property(gold: DataFrame) -> DataFrame:
    return gold.groupBy(*_by_table(gold, "property_id")).agg(F.count(F.lit(1)).alias("changes"))


def history_export(gold: DataFrame) -> DataFrame:
    """All versions of ids that have several, ordered for reading."""
    ids = _by_table(gold, "property_id")
    several = versions_per_property(gold).filter("changes > 1").select(*ids)
    return (
        gold.select(*dict.fromkeys([*_by_table(gold), *HISTORY_COLUMNS]))
        .join(several, ids, "left_semi")
        .orderBy(*_by_table(gold, "city"), "property_id", "valid_from")
    )


def top_changed(gold: DataFrame, top: int = 2) -> DataFrame:
    return (
        versions_per_property(gold).orderBy(F.desc("changes"), "property_id").limit(top)
    )


def top_changed_history(gold: DataFrame, top: int = 2) -> DataFrame:
    """Histories of the most-changed ids; ``top`` bounds the broadcast side."""
    return (
        gold.select(
            *_by_table(gold, "property_id"), "valid_from", "valid_to", "is_current", "price", "city", "location"
        )
        .join(F.broadcast(top_changed(gold, top)), _by_table(gold, "property_id"))
        .orderBy(F.desc("changes"), "property_id", "valid_from")
    )


def sample_timeline(gold: DataFrame) -> DataFrame:
    """History of the smallest id (of each table) that has several versions."""
    several = versions_per_property(gold).filter("changes > 1")
    one = several.groupBy(*_by_table(gold)).agg(F.min("property_id").alias("property_id"))
    ids = _by_table(gold, "property_id")
    return (
        gold.select(*ids, "price", "is_current", "valid_from", "valid_to")
        .join(F.broadcast(one), ids, "left_semi")
        .orderBy("valid_from")
    )


def property_history(gold: DataFrame, property_id: int) -> DataFrame:
    return gold.filter(F.col("property_id") == property_id).orderBy("valid_from")


def chain_breaks(gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Starts whose versions do not end where the next version of the key begins.

    Versions are first folded into one row per key and start day, so the window
    over a key is bounded by the number of days, however many rows a key has.
    """
    by_start = gold.groupBy(*keys, "valid_from").agg(
        F.count(F.lit(1)).alias("versions"),
        F.count("valid_to").alias("ended"),
        F.min("valid_to").alias("first_end"),
        F.max("valid_to").alias("last_end"),
    )
    next_start = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from"))
    chained = reduce(
        lambda a, b: a & b,
        [
            F.col("first_end").eqNullSafe(F.col("next_start")),
            F.col("last_end").eqNullSafe(F.col("next_start")),
            (F.col("ended") == F.col("versions")) | (F.col("ended") == 0),
        ],
    )
    return by_start.withColumn("next_start", next_start).filter(~chained)


# What holds for every row of Gold, whatever the feed: a row for which one is not true must not be published.
EXPECTATIONS = {
    "known_table": f"table_name IN {tuple(rules.GOLD_TABLES.values())}",
    "has_a_start": "valid_from IS NOT NULL",
    "open_versions_have_no_end": "NOT coalesce(is_current, false) OR valid_to IS NULL",
    "closed_versions_have_an_end": "coalesce(is_current, false) OR valid_to IS NOT NULL",
    "price_within_the_cap": f"price IS NULL OR price <= {rules.PRICE_CAP}",
    "flagged_if_priced": "price IS NULL OR is_anomaly IS NOT NULL",
}


def _violations() -> list[Column]:
    return [F.count_if(~F.coalesce(F.expr(holds), F.lit(False))).alias(name) for name, holds in EXPECTATIONS.items()]


def expectations(gold: DataFrame) -> DataFrame:
    """Rows that break each expectation, in one pass."""
    counted = gold.agg(F.count(F.lit(1)).alias("_rows"), *_violations())
    each = [F.struct(F.lit(name).alias("expectation"), F.col(name).alias("violations")) for name in EXPECTATIONS]
    return counted.select("_rows", F.explode(F.array(*each)).alias("e")).select(
        "e.expectation", "e.violations", F.col("_rows").alias("rows")
    )


def expected(rows: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """The rows, observed while they are written, and a check to call when they are.

    The check raises an error if a row broke an expectation; it reads nothing.
    """
    observed = Observation()
    watched = rows.observe(observed, *_violations())

    def check() -> None:
        broken = {name: n for name, n in observed.get.items() if n}
        if broken:
            raise ValueError(f"rows that break expectations: {broken}")

    return watched, check
