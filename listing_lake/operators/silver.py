"""Bronze text rows to typed Silver rows: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_lake import rules, schemas
from listing_lake.functions import casts, cleaning
from listing_lake.session import RECOMMENDED


def silver_clean(
    bronze: DataFrame,
    run_id: str | None,
    transformed_at: str,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Clean and type every Bronze row; rows are neither dropped nor merged.

    ``carry`` names input columns (snapshot date, file hash, tie-breaks) that
    pass through behind the 23 Silver columns.
    """
    # as one generated method the projection is too long for the JVM to compile, and
    # would be interpreted; the limit makes Spark fall back to short methods
    bronze.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", RECOMMENDED["spark.sql.codegen.hugeMethodLimit"])
    typed = bronze.select(
        "*",
        casts.lenient_long(F.col("price")).alias("_raw_price"),
        cleaning.area_in_marla(F.col("Area Type"), F.col("Area Size")).alias("_area"),
        casts.lenient_double(F.col("latitude")).alias("_lat"),
        casts.lenient_double(F.col("longitude")).alias("_lon"),
    )
    raw_price, area = F.col("_raw_price"), F.col("_area")
    derived: dict[str, Column] = {
        "property_id": casts.lenient_long(F.col("property_id")),
        "location_id": casts.lenient_int(F.col("location_id")),
        "url_hash": cleaning.url_digest(F.col("page_url")),
        "price": cleaning.capped_price(raw_price),
        # the ratio is taken before the cap
        "price_per_marla": cleaning.price_per_area(raw_price, area),
        "latitude": cleaning.fenced(F.col("_lat"), rules.LATITUDE_RANGE),
        "longitude": cleaning.fenced(F.col("_lon"), rules.LONGITUDE_RANGE),
        "baths": casts.lenient_int(F.col("baths")),
        "bedrooms": casts.lenient_int(F.col("bedrooms")),
        "date_added": casts.lenient_date(F.col("date_added")),
        "agency": cleaning.text_or(F.col("agency"), rules.DEFAULT_AGENCY),
        "agent": cleaning.text_or(F.col("agent"), rules.DEFAULT_AGENT),
        "area_marla": area,
        "_bronze_run_id": F.col("_run_id"),
        "_transformed_at": F.lit(transformed_at),
        "_silver_run_id": F.lit(run_id).cast("string"),
    }
    columns = [
        derived.get(field.name, F.col(field.name)).alias(field.name)
        for field in schemas.SILVER
    ]
    return typed.select(*columns, *carry)
