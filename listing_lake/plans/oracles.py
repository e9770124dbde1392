"""The registered queries once more, as plain SQL for a second engine.

Written against the same tables and rules but on their own: casts and dates use
that engine's native functions, the merge is spelled as joins.
"""

from __future__ import annotations

from listing_lake.operators.quality import EXPECTATIONS

FEED = """
feed AS (
  SELECT CAST(l_partkey AS VARCHAR) AS property_id,
    CAST(n_nationkey AS VARCHAR) AS location_id,
    'https://listing.example/' || l_partkey AS page_url,
    p_type AS property_type,
    CASE WHEN l_linenumber = 7 THEN 'N/A'
         ELSE CAST(CAST(floor(l_extendedprice / 20000.0) AS BIGINT)
                * (CASE WHEN l_returnflag = 'R' THEN 500 ELSE 200000000 END) AS VARCHAR)
              || (CASE WHEN l_linenumber = 6 THEN '.0' ELSE '' END) END AS price,
    p_name AS location,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE n_name END AS city,
    r_name AS province_name,
    CAST(20 + n_nationkey AS VARCHAR) AS latitude,
    CAST(58 + n_nationkey AS VARCHAR) AS longitude,
    CAST(p_size % 5 AS VARCHAR) AS baths,
    CAST(p_size % 4 AS VARCHAR) AS bedrooms,
    CASE WHEN l_returnflag <> 'R' THEN 'For Sale'
         WHEN l_linenumber = 5 THEN 'Short Stay' ELSE 'For Rent' END AS purpose,
    CASE l_orderkey % 6
      WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(l_shipdate, '%B %-d, %Y')
      WHEN 2 THEN strftime(l_shipdate, '%-m-%-d-%Y')
      WHEN 3 THEN strftime(l_shipdate, '%-m/%-d/%Y')
      WHEN 4 THEN '########' ELSE 'unknown' END AS date_added,
    CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN '  '
         ELSE ' ' || s_name || ' ' END AS agency,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE s_name END AS agent,
    CASE l_partkey % 3 WHEN 0 THEN 'Kanal' WHEN 1 THEN 'KANAL' ELSE 'Marla' END AS area_type,
    CASE WHEN l_partkey % 11 = 0 THEN '0' WHEN l_partkey % 13 = 0 THEN 'n/a'
         ELSE CAST(p_size AS VARCHAR) END AS area_size,
    CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
    l_orderkey, l_linenumber, l_suppkey
  FROM lineitem
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = CASE WHEN l_partkey % 50 = 0 THEN s_nationkey ELSE l_partkey % 25 END
  JOIN region ON r_regionkey = n_regionkey
)"""

SILVER = f"""{FEED},
silver AS (
  SELECT TRY_CAST(property_id AS BIGINT) AS property_id,
    TRY_CAST(location_id AS INTEGER) AS location_id,
    sha256(page_url) AS url_hash, page_url, property_type,
    CASE WHEN cost > 500000000 THEN 500000000 ELSE cost END AS price,
    CASE WHEN area > 0 THEN cost / area END AS price_per_marla,
    location, city, province_name,
    CASE WHEN lat BETWEEN 24 AND 37 THEN lat END AS latitude,
    CASE WHEN lon BETWEEN 61 AND 78 THEN lon END AS longitude,
    TRY_CAST(baths AS INTEGER) AS baths, TRY_CAST(bedrooms AS INTEGER) AS bedrooms, purpose,
    CASE WHEN date_added NOT LIKE '%#%' THEN COALESCE(
      TRY_CAST(date_added AS DATE),
      CAST(try_strptime(date_added, ['%B %d, %Y', '%m-%d-%Y', '%m/%d/%Y']) AS DATE)) END AS date_added,
    CASE WHEN trim(agency) <> '' THEN trim(agency) ELSE 'Direct Listing' END AS agency,
    CASE WHEN trim(agent) <> '' THEN trim(agent) ELSE 'Not Specified' END AS agent,
    area AS area_marla,
    '2025-01-01T00:00:00+00:00' AS _ingested_at, 'run-1' AS _bronze_run_id,
    '2025-01-02T00:00:00+00:00' AS _transformed_at, 'run-1' AS _silver_run_id,
    snapshot_date, l_orderkey, l_linenumber, l_suppkey
  FROM (SELECT *, TRY_CAST(price AS BIGINT) AS cost,
          TRY_CAST(area_size AS DOUBLE) * (CASE WHEN area_type ILIKE 'kanal' THEN 20.0 ELSE 1.0 END) AS area,
          TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon
        FROM feed) AS f
)"""

SILVER_COLUMNS = """property_id, location_id, url_hash, page_url, property_type, price, price_per_marla,
  location, city, province_name, latitude, longitude, baths, bedrooms, purpose, date_added, agency,
  agent, area_marla, _ingested_at, _bronze_run_id, _transformed_at, _silver_run_id"""

GOLD_COLUMNS = """property_id, location_id, page_url, url_hash, property_type, property_category, price,
  price_per_marla, is_anomaly, location, city, province_name, latitude, longitude, baths, bedrooms,
  agency, agent, area_marla, date_added, is_current, valid_from, valid_to, _ingested_at,
  _bronze_run_id, _transformed_at, _silver_run_id, _gold_loaded_at, table_name"""

OFFERS = f"""{SILVER},
offers AS (
  SELECT *, CASE purpose WHEN 'For Sale' THEN 'gold_sales' ELSE 'gold_rentals' END AS table_name,
    CASE WHEN bedrooms = 0 THEN 'Plot/Land' ELSE property_type END AS property_category,
    COALESCE(price < (CASE purpose WHEN 'For Sale' THEN 100000 ELSE 1000 END), FALSE) AS is_anomaly,
    '2025-01-03T00:00:00+00:00' AS _gold_loaded_at
  FROM silver WHERE purpose IN ('For Sale', 'For Rent')
)"""


def history(name: str, where: str = "TRUE", keys: str = "city, property_id", source: str = "offers") -> str:
    """CTEs for the whole price history of ``source``; the last one is ``name``."""
    per_key = f"PARTITION BY table_name, {keys} ORDER BY snapshot_date"
    return f"""
{name}_daily AS MATERIALIZED (
  SELECT * FROM {source} WHERE city <> '' AND ({where})
  QUALIFY row_number() OVER (PARTITION BY table_name, {keys}, snapshot_date
                             ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1),
{name}_points AS MATERIALIZED (
  SELECT * FROM (SELECT *, lag(price) OVER ({per_key}) AS before FROM {name}_daily) AS d
  WHERE before IS NULL OR before <> price),
{name} AS MATERIALIZED (
  SELECT *, lead(snapshot_date) OVER ({per_key}) IS NULL AS is_current,
    snapshot_date AS valid_from, lead(snapshot_date) OVER ({per_key}) AS valid_to
  FROM {name}_points)"""


def merged(name: str, before: str, batch: str, day: str, once: bool = False) -> str:
    """CTE ``name``: history ``before`` after the rows of ``batch``, dated ``day``.

    ``once``: an ended version is kept once, not for each row that ends it.
    """
    plain = [c.strip() for c in GOLD_COLUMNS.split(",")]
    closing = {"is_current": "FALSE", "valid_to": f"DATE '{day}'"}
    opening = {"is_current": "TRUE", "valid_from": f"DATE '{day}'", "valid_to": "CAST(NULL AS DATE)"}

    def listed(alias: str, changed: dict) -> str:
        return ", ".join(f"{changed[c]} AS {c}" if c in changed else f"{alias}.{c}" for c in plain)

    same_id = "b.table_name = g.table_name AND b.property_id = g.property_id AND g.is_current"
    return f"""
{name} AS MATERIALIZED (
  SELECT {listed("g", {})} FROM {before} AS g
  WHERE NOT EXISTS (SELECT 1 FROM {batch} AS b WHERE {same_id} AND b.price <> g.price)
  UNION ALL
  SELECT {listed("g", closing)} FROM {before} AS g
  {"SEMI" if once else ""} JOIN {batch} AS b ON {same_id} AND b.price <> g.price
  UNION ALL
  SELECT {listed("b", opening)} FROM {batch} AS b
  WHERE NOT EXISTS (SELECT 1 FROM {before} AS g WHERE {same_id} AND b.price = g.price))"""


def batch(name: str, where: str) -> str:
    return f"\n{name} AS MATERIALIZED (SELECT * FROM offers WHERE {where})"


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def months(first: str, last: str) -> list[str]:
    """First days of the months from ``first`` to ``last``."""
    year, month = int(first[:4]), int(first[5:7])
    found = []
    while (day := f"{year:04d}-{month:02d}-01") <= last:
        found.append(day)
        year, month = year + month // 12, month % 12 + 1
    return found


# Rows as the end-to-end runs see them: rejected records gone, and one row of a
# listing with a city per day, since files do not carry the order of rows.
REDUCED = OFFERS.replace("\noffers AS (", "\nall_offers AS (") + """,
offers AS (
  SELECT * FROM all_offers WHERE l_linenumber NOT IN (3, 4)
  QUALIFY city IS NULL OR city = '' OR row_number() OVER (
    PARTITION BY table_name, city, property_id, snapshot_date
    ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1)"""


def replayed(first: str, last: str, once: bool = False) -> tuple[list[str], str]:
    """CTEs that replay all snapshots from ``first`` on, and the final relation."""
    ctes, current = [OFFERS, history("g0", f"snapshot_date < DATE '{first}'")], "g0"
    for i, day in enumerate(months(first, last), start=1):
        ctes.append(batch(f"b{i}", f"snapshot_date = DATE '{day}'"))
        ctes.append(merged(f"g{i}", current, f"b{i}", day, once))
        current = f"g{i}"
    return ctes, current


ALL = [OFFERS, history("gold")]
SALES = [*ALL, "\nsales AS (SELECT * FROM gold WHERE table_name = 'gold_sales')"]

LINEAGE = """
lineage AS (
  SELECT sha256(url) AS file_hash, layer,
    'page_' || page_id || (CASE layer WHEN 'SILVER' THEN '_clean.parquet' ELSE '.parquet' END) AS file_name,
    'run-' || (page_id % 4) AS run_id,
    CASE WHEN page_id % 10 = 9 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CAST(CASE WHEN page_id % 10 = 9 THEN page_id % 7 ELSE 0 END AS INTEGER) AS retry_count,
    CASE WHEN page_id % 10 <> 9 THEN page_id END AS row_count,
    CASE WHEN page_id % 10 <> 9 THEN CAST(strlen(html) AS BIGINT) END AS file_size_bytes,
    CASE WHEN page_id % 10 = 9 THEN 'cannot read ' || url END AS error_message,
    strftime(TIMESTAMP '2025-01-01' + to_seconds(page_id), '%Y-%m-%d %H:%M:%S') AS created_at
  FROM pages
  CROSS JOIN (VALUES ('BRONZE', 10), ('SILVER', 8), ('GOLD', 5)) AS l(layer, below)
  WHERE page_id % 10 < below
)"""

LINEAGE_COLUMNS = """file_hash, layer, file_name, run_id, status, retry_count, row_count,
  file_size_bytes, error_message"""

NUMBERS = """
numbers AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE l_orderkey % 16
      WHEN 0 THEN CAST(l_partkey AS VARCHAR)
      WHEN 1 THEN ' ' || l_partkey || ' '
      WHEN 2 THEN '+' || l_partkey
      WHEN 3 THEN l_partkey || '.' || l_suppkey
      WHEN 4 THEN '-' || l_partkey || '.5'
      WHEN 5 THEN l_linenumber || 'e' || (l_partkey % 12)
      WHEN 6 THEN l_partkey || ',' || l_suppkey
      WHEN 7 THEN l_partkey || '99999999' || l_orderkey
      WHEN 8 THEN '.' || l_suppkey
      WHEN 9 THEN l_partkey || 'f'
      WHEN 10 THEN l_partkey || '_000'
      WHEN 11 THEN '0x' || hex(l_partkey)
      WHEN 12 THEN '0b' || bin(l_partkey)
      WHEN 13 THEN l_partkey || '.4999999999999999999999'
      WHEN 14 THEN l_partkey || '__' || l_suppkey || '.5'
      ELSE '-' || l_partkey || '_1.0_5e' || l_linenumber END AS text
  FROM lineitem
)"""

DATES = """
dates AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE l_orderkey % 18
      WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(l_shipdate, '%Y/%m/%d')
      WHEN 2 THEN strftime(l_shipdate, '%Y-%-m-%-d')
      WHEN 3 THEN strftime(l_shipdate, '%Y-%m-%d 10:00:00')
      WHEN 4 THEN strftime(l_shipdate, '%B %-d, %Y')
      WHEN 5 THEN upper(strftime(l_shipdate, '%B %d, %Y'))
      WHEN 6 THEN strftime(l_shipdate, '%m-%d-%Y')
      WHEN 7 THEN strftime(l_shipdate, '%-m/%-d/%Y')
      WHEN 8 THEN strftime(l_shipdate, '%-d-%-m-%Y')
      WHEN 9 THEN strftime(l_shipdate, '%Y%m%d')
      WHEN 10 THEN strftime(l_shipdate, '%Y-%m-%d#')
      WHEN 11 THEN strftime(l_shipdate, '%Y-%m')
      WHEN 12 THEN strftime(l_shipdate, '%Y-%m-%d junk')
      WHEN 13 THEN strftime(l_shipdate, '%Y-%m-%d 10')
      WHEN 14 THEN strftime(l_shipdate, '%-m-%-d-9%y')
      WHEN 15 THEN strftime(l_shipdate, '%-m/%-d/1') || right(strftime(l_shipdate, '%Y'), 1)
      WHEN 16 THEN strftime(l_shipdate, '%Y-%m-%d 1:30:00.5')
      ELSE strftime(l_shipdate, '%Y-%m-%d 24:00:00') END AS text
  FROM lineitem
)"""

FILE_NAMES = """
names AS (
  SELECT event_id,
    CASE event_id % 4
      WHEN 0 THEN 'export_' || user_id || '.csv'
      WHEN 1 THEN 'p_' || strftime(ts, '%Y-%m-%d') || '_2030-01-01.csv'
      ELSE 'property_data_' || strftime(ts, '%Y-%m-%d') || '_' || user_id || '.csv' END AS file_name
  FROM events
)"""

SPLIT, LAST, STORE_SPLIT, LATE = "2001-01-01", "2001-11-01", "2001-10-01", "1998-01-01"

_NULLS = ", ".join(
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}"
    for c in ("property_id", "url_hash", "price", "area_marla")
)
_KEYED = "l_orderkey, l_linenumber, l_suppkey, property_id"


def _cast(kind: str) -> str:
    return _with(
        NUMBERS,
        select=f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, text,"
        f" TRY_CAST(text AS {kind}) AS value FROM numbers",
    )


def _late_rebuilt() -> str:
    return _with(
        OFFERS,
        history("was", f"snapshot_date <> DATE '{LATE}'"),
        history("whole"),
        f"""
late_ids AS (
  SELECT DISTINCT b.table_name, b.property_id FROM offers AS b
  WHERE b.snapshot_date = DATE '{LATE}' AND b.city <> ''
    AND b.snapshot_date < (SELECT max(g.valid_from) FROM was AS g
                           WHERE g.table_name = b.table_name AND g.property_id = b.property_id))""",
        select=f"""SELECT {GOLD_COLUMNS} FROM was
WHERE (table_name, property_id) NOT IN (SELECT table_name, property_id FROM late_ids)
UNION ALL
SELECT {GOLD_COLUMNS} FROM whole
WHERE (table_name, property_id) IN (SELECT table_name, property_id FROM late_ids)""",
    )


def _stream_late(once: bool = False) -> str:
    """As the rebuild, then the on-time rows of the late batch are merged."""
    base = _late_rebuilt()
    body, last = base.rsplit("\nSELECT " + GOLD_COLUMNS + " FROM was", 1)
    on_time = f"""
on_time AS MATERIALIZED (
  SELECT b.* FROM offers AS b LEFT JOIN (SELECT table_name, property_id, max(valid_from) AS newest
                                         FROM was GROUP BY ALL) AS g USING (table_name, property_id)
  WHERE b.snapshot_date = DATE '{LATE}'
    AND (b.city IS NULL OR b.city = '' OR newest IS NULL OR newest <= b.snapshot_date))"""
    rebuilt = f"\nrebuilt AS MATERIALIZED (SELECT {GOLD_COLUMNS} FROM was{last})"
    return (
        body
        + ","
        + ",".join([rebuilt, on_time, merged("final", "rebuilt", "on_time", LATE, once)])
        + f"\nSELECT {GOLD_COLUMNS} FROM final"
    )


def _versions(select: str) -> str:
    """Contents of the store after bulk and two merges, per version and table."""
    ctes, _ = replayed(STORE_SPLIT, LAST)
    union = " UNION ALL ".join(
        f"SELECT CAST({v} AS BIGINT) AS version, '{mode}' AS mode, table_name, is_current FROM g{v - 1}"
        for v, mode in ((1, "bulk"), (2, "merge"), (3, "merge"))
    )
    return _with(*ctes, f"\ncontents AS ({union})", select=select)


def oracle_sql() -> dict[str, str]:
    replay, final = replayed(SPLIT, LAST)
    store, store_final = replayed(STORE_SPLIT, LAST)
    stages, stages_final = replayed(STORE_SPLIT, LAST, once=True)
    one_batch = [
        OFFERS,
        history("g0", f"snapshot_date < DATE '{SPLIT}'"),
        batch("b1", f"snapshot_date >= DATE '{SPLIT}'"),
        merged("g1", "g0", "b1", SPLIT),
    ]
    nothing = "\nnothing AS (SELECT *, FALSE AS is_current, snapshot_date AS valid_from, snapshot_date AS valid_to FROM offers WHERE FALSE)"
    first_load = [OFFERS, nothing, batch("b1", "TRUE"), merged("g1", "nothing", "b1", SPLIT)]
    raw = """property_id, location_id, page_url, property_type, price, location, city, province_name,
  latitude, longitude, baths, bedrooms, purpose, date_added, nullif(agency, '') AS agency, agent,
  area_type AS "Area Type", area_size AS "Area Size", snapshot_date"""
    return {
        # ---- casts and cleaning rules
        "cast_lenient_long": _cast("BIGINT"),
        "cast_lenient_int": _cast("INTEGER"),
        "cast_lenient_double": _cast("DOUBLE"),
        "parse_dates": _with(
            DATES,
            select="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, text,
  CAST(CASE WHEN text NOT LIKE '%#%' THEN COALESCE(TRY_CAST(text AS DATE),
    CAST(try_strptime(text, '%B %d, %Y') AS DATE), CAST(try_strptime(text, '%m-%d-%Y') AS DATE),
    CAST(try_strptime(text, '%m/%d/%Y') AS DATE)) END AS VARCHAR) AS value FROM dates""",
        ),
        "text_defaults": _with(SILVER, select=f"SELECT {_KEYED}, agency, agent FROM silver"),
        "area_to_marla": _with(SILVER, select=f"SELECT {_KEYED}, area_marla FROM silver"),
        "price_cap": _with(SILVER, select=f"SELECT {_KEYED}, price FROM silver"),
        "price_per_area": _with(SILVER, select=f"SELECT {_KEYED}, price_per_marla FROM silver"),
        "geo_fence": _with(SILVER, select=f"SELECT {_KEYED}, latitude, longitude FROM silver"),
        "file_content_hash": """SELECT 'page_' || page_id || '.csv' AS file_name,
  octet_length(encode(html)) AS length, sha256(html) AS file_hash FROM pages""",
        "url_hash": "SELECT page_id, url, sha256(url) AS url_hash FROM pages",
        "silver_clean": _with(SILVER, select=f"SELECT {SILVER_COLUMNS} FROM silver"),
        # ---- files and names
        "bronze_audit_columns": _with(
            FEED,
            select="""SELECT property_id, page_url, l_orderkey, l_linenumber, l_suppkey,
  '2025-01-01T00:00:00+00:00' AS _ingested_at, 'run-1' AS _run_id,
  'property_data_' || snapshot_date || '.csv' AS _source_file FROM feed""",
        ),
        "bronze_csv_roundtrip": _with(FEED, select=f"SELECT {raw} FROM feed"),
        "stream_bronze": _with(FEED, select=f"SELECT {raw} FROM feed"),
        "bronze_batch_limit": _with(FEED, select=f"SELECT {raw} FROM feed"),
        "pipeline_end_to_end": _with(
            REDUCED, *stages[1:], select=f"SELECT {GOLD_COLUMNS} FROM {stages_final}"
        ),
        "stream_end_to_end": _stream_late(once=True).replace(OFFERS, REDUCED),
        "quarantine_split": _with(
            FEED,
            select="""SELECT snapshot_date, COUNT(*) FILTER (WHERE l_linenumber NOT IN (3, 4)) AS clean_rows,
  COUNT(*) FILTER (WHERE l_linenumber IN (3, 4)) AS quarantined_rows FROM feed GROUP BY snapshot_date""",
        ),
        "file_row_counts": _with(
            FEED,
            select="""SELECT 'property_data_' || snapshot_date || '.csv' AS file_name, COUNT(*) AS row_count
FROM feed GROUP BY snapshot_date""",
        ),
        "layer_file_names": """SELECT page_id, 'page_' || page_id || '.csv' AS landing_name,
  'page_' || page_id || '.parquet' AS bronze_name, 'page_' || page_id || '_clean.parquet' AS silver_name,
  'page_' || page_id || '_' || sha256(url) || '.parquet' AS unique_name FROM pages""",
        "snapshot_date_from_name": _with(
            FILE_NAMES,
            select=r"""SELECT event_id, file_name, regexp_extract(file_name, '(\d{4}-\d{2}-\d{2})', 1) AS snapshot_text,
  COALESCE(TRY_CAST(regexp_extract(file_name, '(\d{4}-\d{2}-\d{2})', 1) AS DATE), DATE '2025-01-03') AS snapshot_date
FROM names""",
        ),
        "snapshot_dates": _with(FEED, select="SELECT DISTINCT snapshot_date FROM feed"),
        # ---- Gold steps
        "purpose_split": _with(
            OFFERS, select=f"SELECT {_KEYED}, purpose, table_name FROM offers"
        ),
        "gold_enrich": _with(
            OFFERS,
            select=f"""SELECT {_KEYED}, table_name, property_category, is_anomaly, TRUE AS is_current,
  snapshot_date AS valid_from, CAST(NULL AS DATE) AS valid_to, _gold_loaded_at FROM offers""",
        ),
        "dedup_per_day": _with(
            *ALL,
            select=f"SELECT {_KEYED}, table_name, city, snapshot_date, price FROM gold_daily",
        ),
        "price_change_points": _with(
            *ALL,
            select=f"SELECT {_KEYED}, table_name, city, snapshot_date, price FROM gold_points",
        ),
        "distinct_cities": _with(
            SILVER,
            select="SELECT DISTINCT city FROM silver WHERE purpose = 'For Sale' AND city <> ''",
        ),
        "scd2_bulk_timeline": _with(*ALL, select=f"SELECT {GOLD_COLUMNS} FROM gold"),
        "scd2_bulk_timeline_by_id": _with(
            OFFERS, history("gold", keys="property_id"), select=f"SELECT {GOLD_COLUMNS} FROM gold"
        ),
        "scd2_incremental_once": _with(
            *one_batch[:3],
            merged("g1", "g0", "b1", SPLIT, once=True),
            select=f"SELECT {GOLD_COLUMNS} FROM g1",
        ),
        "scd2_incremental": _with(*one_batch, select=f"SELECT {GOLD_COLUMNS} FROM g1"),
        "scd2_incremental_first_load": _with(*first_load, select=f"SELECT {GOLD_COLUMNS} FROM g1"),
        "scd2_replay": _with(*replay, select=f"SELECT {GOLD_COLUMNS} FROM {final}"),
        "scd2_replay_fold": _with(*replay, select=f"SELECT {GOLD_COLUMNS} FROM {final}"),
        "stream_gold": _with(*store, select=f"SELECT {GOLD_COLUMNS} FROM {store_final}"),
        "stream_gold_state": _with(*store, select=f"SELECT {GOLD_COLUMNS} FROM {store_final}"),
        "scd2_late_rebuild": _stream_late(),
        "stream_late": _stream_late(),
        "stream_silver": _with(SILVER, select=f"SELECT {SILVER_COLUMNS} FROM silver"),
        # ---- Gold reads, checks and reports
        "gold_current": _with(*ALL, select=f"SELECT {GOLD_COLUMNS} FROM gold WHERE is_current"),
        "gold_city_lookup": _with(
            *SALES, select=f"SELECT {GOLD_COLUMNS} FROM sales WHERE city = 'NATION_7'"
        ),
        "gold_as_of_join": """
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) = 1),
points AS (
  SELECT * FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY day) AS before FROM daily) AS d
  WHERE before IS NULL OR before <> value),
versions AS (
  SELECT user_id, value, day AS valid_from, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS valid_to
  FROM points),
asked AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id,
    CAST(ts AS DATE) - CAST(event_id % 5 AS INTEGER) AS asked
  FROM events)
SELECT a.event_id, a.user_id, a.asked, v.value, v.valid_from, v.valid_to
FROM asked AS a ASOF LEFT JOIN versions AS v ON a.user_id = v.user_id AND a.asked >= v.valid_from""",
        "gold_expectations": _with(
            *ALL,
            select=f"""SELECT e.expectation, CAST(count(*) FILTER (WHERE NOT coalesce(
    CASE e.expectation
      WHEN 'known_table' THEN table_name IN ('gold_sales', 'gold_rentals')
      WHEN 'has_a_start' THEN valid_from IS NOT NULL
      WHEN 'open_versions_have_no_end' THEN NOT is_current OR valid_to IS NULL
      WHEN 'closed_versions_have_an_end' THEN is_current OR valid_to IS NOT NULL
      WHEN 'price_within_the_cap' THEN price IS NULL OR price <= 500000000
      ELSE price IS NULL OR is_anomaly IS NOT NULL END, FALSE)) AS BIGINT) AS violations, count(*) AS rows
FROM gold CROSS JOIN (VALUES {", ".join(f"('{e}')" for e in EXPECTATIONS)}) AS e(expectation) GROUP BY e.expectation""",
        ),
        "lake_sql": _with(
            *ALL,
            select="""SELECT g.city, g.open_versions, g.closed_versions, s.silver_rows
FROM (SELECT city, count(*) FILTER (WHERE is_current) AS open_versions,
        count(*) FILTER (WHERE NOT is_current) AS closed_versions
      FROM gold WHERE table_name = 'gold_rentals' GROUP BY city) AS g
JOIN (SELECT city, count(*) AS silver_rows FROM silver GROUP BY city) AS s USING (city)""",
        ),
        "gold_as_of_date": _with(
            *ALL,
            select=f"""SELECT {GOLD_COLUMNS} FROM gold
WHERE valid_from <= DATE '1998-06-15' AND DATE '1998-06-15' < COALESCE(valid_to, DATE '9999-12-31')""",
        ),
        "gold_table_counts": _with(
            *ALL,
            select="""SELECT table_name, COUNT(*) AS total_rows,
  round(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM gold), 1) AS share_pct FROM gold GROUP BY table_name""",
        ),
        "gold_anomaly_counts": _with(
            *ALL,
            select="SELECT table_name, COUNT(*) FILTER (WHERE is_anomaly) AS anomalies FROM gold GROUP BY table_name",
        ),
        "gold_null_profile": _with(
            *SALES, select=f"SELECT COUNT(*) AS total_rows, {_NULLS} FROM sales"
        ),
        "silver_null_profile": _with(
            SILVER, select=f"SELECT COUNT(*) AS total_rows, {_NULLS} FROM silver"
        ),
        "silver_schema_check": _with(
            SILVER,
            select=" UNION ALL ".join(
                f"SELECT '{c}' AS column_name, TRUE AS present, COUNT({c}) AS non_null FROM silver"
                for c in (
                    "url_hash",
                    "price",
                    "price_per_marla",
                    "area_marla",
                    "_transformed_at",
                    "_silver_run_id",
                )
            ),
        ),
        "gold_plot_count": _with(
            *SALES,
            select="SELECT COUNT(*) AS plots FROM sales WHERE property_category = 'Plot/Land' AND bedrooms = 0",
        ),
        "date_type_check": _with(
            *SALES,
            select="SELECT typeof(date_added) AS type, COUNT(date_added) AS valid_dates FROM sales GROUP BY 1",
        ),
        "price_by_city_top5": _with(
            SILVER,
            select="""SELECT city, COUNT(*) AS total_properties, CAST(AVG(price) AS BIGINT) AS avg_price,
  CAST(MAX(price) AS BIGINT) AS max_price FROM silver WHERE city IS NOT NULL GROUP BY city
ORDER BY total_properties DESC, city LIMIT 5""",
        ),
        "city_distribution": _with(
            *SALES,
            select="""SELECT city, COUNT(*) AS total_rows,
  CAST(SUM(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) AS active_rows FROM sales GROUP BY city""",
        ),
        "scd2_duplicate_active": _with(
            *SALES,
            select="SELECT property_id, COUNT(*) AS cnt FROM sales WHERE is_current GROUP BY property_id HAVING COUNT(*) > 1",
        ),
        "scd2_changed_properties": _with(
            *SALES,
            select="""SELECT COUNT(*) AS expired_versions, COUNT(DISTINCT property_id) AS properties_with_history
FROM sales WHERE NOT is_current""",
        ),
        "scd2_top_changed": _with(
            *SALES,
            select="SELECT property_id, COUNT(*) AS changes FROM sales GROUP BY property_id ORDER BY changes DESC, property_id LIMIT 2",
        ),
        "scd2_top_changed_history": _with(
            *SALES,
            "\ntop AS (SELECT property_id, COUNT(*) AS changes FROM sales GROUP BY property_id ORDER BY changes DESC, property_id LIMIT 2)",
            select="""SELECT property_id, valid_from, valid_to, is_current, price, city, location, changes
FROM sales JOIN top USING (property_id)""",
        ),
        "scd2_sample_timeline": _with(
            *SALES,
            select="""SELECT property_id, price, is_current, valid_from, valid_to FROM sales
WHERE property_id = (SELECT property_id FROM sales GROUP BY property_id HAVING COUNT(*) > 1
                     ORDER BY property_id LIMIT 1)""",
        ),
        "scd2_history_export": _with(
            *SALES,
            select="""SELECT property_id, city, location, property_type, price, is_current, valid_from, valid_to
FROM sales WHERE property_id IN (SELECT property_id FROM sales GROUP BY property_id HAVING COUNT(*) > 1)""",
        ),
        "scd2_chain_check": _with(
            *SALES,
            """
starts AS (SELECT property_id, valid_from, COUNT(*) AS versions, COUNT(valid_to) AS ended,
    min(valid_to) AS first_end, max(valid_to) AS last_end FROM sales GROUP BY property_id, valid_from)""",
            select="""SELECT property_id, valid_from, versions, ended, first_end, last_end, next_start
FROM (SELECT *, lead(valid_from) OVER (PARTITION BY property_id ORDER BY valid_from) AS next_start FROM starts) AS s
WHERE first_end IS DISTINCT FROM next_start OR last_end IS DISTINCT FROM next_start
   OR ended NOT IN (0, versions)""",
        ),
        # ---- Gold store
        "gold_publish_versions": _versions(
            """SELECT version, table_name, mode, COUNT(*) FILTER (WHERE is_current) AS open_rows,
  COUNT(*) FILTER (WHERE NOT is_current) AS closed_rows FROM contents GROUP BY version, table_name, mode"""
        ),
        "gold_snapshots": _versions(
            """SELECT version, table_name, mode, COUNT(*) AS total_rows FROM contents
GROUP BY version, table_name, mode"""
        ),
        "gold_rollback": _with(
            *one_batch,
            select="""SELECT '1 bulk' AS state, COUNT(*) AS gold_rows FROM g0
UNION ALL SELECT '2 merged', COUNT(*) FROM g1 UNION ALL SELECT '3 restored', COUNT(*) FROM g0
UNION ALL SELECT '4 reset', COUNT(*) FROM g0 WHERE FALSE""",
        ),
        "gold_mode_selection": _with(
            *ALL,
            select="""SELECT 'before' AS moment, 'bulk' AS mode, COUNT(*) AS gold_rows FROM gold WHERE FALSE
UNION ALL SELECT 'after', 'merge', COUNT(*) FROM gold""",
        ),
        "gold_empty_bootstrap": _with(*first_load, select=f"SELECT {GOLD_COLUMNS} FROM g1"),
        # ---- lineage
        "lineage_unprocessed": _with(
            LINEAGE,
            select="""SELECT sha256(url) AS file_hash, page_id FROM pages
WHERE sha256(url) NOT IN (SELECT file_hash FROM lineage WHERE layer = 'SILVER' AND status = 'SUCCESS')""",
        ),
        "lineage_eligible": _with(
            LINEAGE,
            select="""SELECT file_hash, file_name, row_count FROM lineage WHERE layer = 'SILVER' AND status = 'SUCCESS'
  AND file_hash NOT IN (SELECT file_hash FROM lineage WHERE layer = 'GOLD' AND status = 'SUCCESS')""",
        ),
        "lineage_batch_limit": _with(
            LINEAGE,
            select="""SELECT file_hash, file_name, row_count FROM lineage WHERE layer = 'SILVER' AND status = 'SUCCESS'
  AND file_hash NOT IN (SELECT file_hash FROM lineage WHERE layer = 'GOLD' AND status = 'SUCCESS')
ORDER BY file_name LIMIT 20""",
        ),
        "lineage_upsert": """WITH records AS (
  SELECT sha256('file-' || user_id) AS file_hash,
    CASE user_id % 3 WHEN 0 THEN 'BRONZE' WHEN 1 THEN 'SILVER' ELSE 'GOLD' END AS layer,
    event_id, event_type, event_type = 'error' AS broken FROM events)
SELECT file_hash, layer, arg_max('out_' || event_id || '.parquet', event_id) AS file_name,
  arg_max('run-' || (event_id % 5), event_id) AS run_id,
  CASE WHEN arg_max(broken, event_id) THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CAST(COUNT(*) FILTER (WHERE broken) - CAST(arg_min(broken, event_id) AS INTEGER) AS INTEGER) AS retry_count,
  CASE WHEN arg_max(broken, event_id) THEN NULL ELSE max(event_id) END AS row_count,
  CASE WHEN arg_max(broken, event_id) THEN NULL ELSE max(event_id) * 10 END AS file_size_bytes,
  CASE WHEN arg_max(broken, event_id) THEN 'event ' || max(event_id) END AS error_message
FROM records GROUP BY file_hash, layer""",
        "lineage_release": _with(
            LINEAGE,
            """
aside AS (SELECT * REPLACE (CASE WHEN status = 'FAILED' AND retry_count >= 3 THEN 'QUARANTINED'
                                 ELSE status END AS status) FROM lineage)""",
            """
freed AS (SELECT min(file_hash) AS file_hash FROM aside WHERE status = 'QUARANTINED')""",
            select="""SELECT file_hash, layer, file_name,
  CASE WHEN status = 'QUARANTINED' AND file_hash = (SELECT file_hash FROM freed) THEN 'FAILED' ELSE status END AS status,
  CASE WHEN status = 'QUARANTINED' AND file_hash = (SELECT file_hash FROM freed) THEN 0 ELSE retry_count END AS retry_count
FROM aside""",
        ),
        "lineage_delete_layer": _with(
            LINEAGE, select=f"SELECT {LINEAGE_COLUMNS} FROM lineage WHERE layer <> 'SILVER'"
        ),
        "lineage_status_counts": _with(
            LINEAGE, select="SELECT layer, status, COUNT(*) AS files FROM lineage GROUP BY layer, status"
        ),
        "lineage_volume": _with(
            LINEAGE,
            select="""SELECT layer, CAST(SUM(row_count) AS BIGINT) AS total_rows,
  CAST(SUM(file_size_bytes) AS BIGINT) AS total_bytes, round(SUM(file_size_bytes) / 1e6, 1) AS total_mb
FROM lineage WHERE status = 'SUCCESS' GROUP BY layer""",
        ),
        "lineage_listing": _with(
            LINEAGE,
            select="""SELECT file_name, layer, status, row_count, file_size_bytes,
  round(file_size_bytes / 1e6, 1) AS size_mb, created_at FROM lineage""",
        ),
        "lineage_failed": _with(
            LINEAGE,
            select="SELECT file_name, layer, error_message, retry_count FROM lineage WHERE status = 'FAILED'",
        ),
        "lineage_by_run": _with(
            LINEAGE, select=f"SELECT {LINEAGE_COLUMNS} FROM lineage WHERE run_id = 'run-2'"
        ),
        "lineage_retry_watch": _with(
            LINEAGE,
            select="SELECT file_hash, layer, file_name, retry_count, error_message FROM lineage WHERE status = 'FAILED'",
        ),
    }
