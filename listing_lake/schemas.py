"""Explicit schemas of every layer; no read in this package infers types."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(columns: dict) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_S, _L, _I, _D = StringType(), LongType(), IntegerType(), DoubleType()

RAW_COLUMNS = (
    "property_id",
    "location_id",
    "page_url",
    "property_type",
    "price",
    "location",
    "city",
    "province_name",
    "latitude",
    "longitude",
    "baths",
    "bedrooms",
    "purpose",
    "date_added",
    "agency",
    "agent",
    "Area Type",
    "Area Size",
)

RAW = _struct({name: _S for name in RAW_COLUMNS})

# `_source_file` keeps the landing name, which carries the snapshot date.
BRONZE = _struct(
    {name: _S for name in (*RAW_COLUMNS, "_ingested_at", "_run_id", "_source_file")}
)

SILVER = _struct(
    {
        "property_id": _L,
        "location_id": _I,
        "url_hash": _S,
        "page_url": _S,
        "property_type": _S,
        "price": _L,
        "price_per_marla": _D,
        "location": _S,
        "city": _S,
        "province_name": _S,
        "latitude": _D,
        "longitude": _D,
        "baths": _I,
        "bedrooms": _I,
        "purpose": _S,
        "date_added": DateType(),
        "agency": _S,
        "agent": _S,
        "area_marla": _D,
        "_ingested_at": _S,
        "_bronze_run_id": _S,
        "_transformed_at": _S,
        "_silver_run_id": _S,
    }
)

GOLD = _struct(
    {
        "property_id": _L,
        "location_id": _I,
        "page_url": _S,
        "url_hash": _S,
        "property_type": _S,
        "property_category": _S,
        "price": _L,
        "price_per_marla": _D,
        "is_anomaly": BooleanType(),
        "location": _S,
        "city": _S,
        "province_name": _S,
        "latitude": _D,
        "longitude": _D,
        "baths": _I,
        "bedrooms": _I,
        "agency": _S,
        "agent": _S,
        "area_marla": _D,
        "date_added": DateType(),
        "is_current": BooleanType(),
        "valid_from": DateType(),
        "valid_to": DateType(),
        "_ingested_at": _S,
        "_bronze_run_id": _S,
        "_transformed_at": _S,
        "_silver_run_id": _S,
        "_gold_loaded_at": _S,
    }
)

LINEAGE = _struct(
    {
        "file_hash": _S,
        "layer": _S,
        "file_name": _S,
        "run_id": _S,
        "status": _S,
        "retry_count": _I,
        "row_count": _L,
        "file_size_bytes": _L,
        "error_message": _S,
        "created_at": TimestampType(),
        "updated_at": TimestampType(),
    }
)

# One outcome of handling one file, as handed to the lineage upsert.
OUTCOME = _struct(
    {
        "file_hash": _S,
        "layer": _S,
        "file_name": _S,
        "run_id": _S,
        "status": _S,
        "row_count": _L,
        "file_size_bytes": _L,
        "error_message": _S,
        "seq": _L,
    }
)

# One row per Gold table and committed version.
GOLD_COMMIT = _struct(
    {
        "version": _L,
        "table_name": _S,
        "mode": _S,
        "batch_key": _S,
        "committed_at": TimestampType(),
        "open_version": _L,
        "closed_versions": ArrayType(_L),
        "file_versions": ArrayType(_L),
        "open_rows": _L,
        "closed_rows": _L,
    }
)

GOLD_COMMIT_FILE = _struct({"version": _L, "file_hash": _S})
