"""Business rules of the feed: every value that decides a result.

Fixed values: results depend on them exactly, so they are stated here once,
as plain text, and nowhere else.
"""

FOR_SALE = "For Sale"
FOR_RENT = "For Rent"

# purpose -> Gold table that takes it; any other purpose is in neither table.
GOLD_TABLES = {FOR_SALE: "gold_sales", FOR_RENT: "gold_rentals"}

# purpose -> price below which a listing is flagged as an anomaly.
ANOMALY_BELOW = {FOR_SALE: 100_000, FOR_RENT: 1_000}

PRICE_CAP = 500_000_000
LATITUDE_RANGE = (24.0, 37.0)
LONGITUDE_RANGE = (61.0, 78.0)

LARGE_AREA_UNIT = "Kanal"
MARLA_PER_LARGE_UNIT = 20.0

DEFAULT_AGENCY = "Direct Listing"
DEFAULT_AGENT = "Not Specified"
PLOT_CATEGORY = "Plot/Land"

SNAPSHOT_DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"
LANDING_NAME_PATTERN = r"^[^.]+\.csv$"
ERROR_TEXT_LENGTH = 500

BRONZE, SILVER, GOLD = "BRONZE", "SILVER", "GOLD"
SUCCESS, FAILED, QUARANTINED = "SUCCESS", "FAILED", "QUARANTINED"

# Columns a Silver table must have, and those that must never be NULL.
SILVER_CONTRACT = (
    "url_hash",
    "price",
    "price_per_marla",
    "area_marla",
    "_transformed_at",
    "_silver_run_id",
)
CRITICAL_COLUMNS = ("property_id", "url_hash", "price", "area_marla")
