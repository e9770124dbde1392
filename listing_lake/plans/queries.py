"""Every operator as a query over the test tables.

Queries that need storage (files, versions, streams) write what Spark derives
from the tables into a fresh folder below the shared one and read it back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_lake import rules, schemas
from listing_lake.functions import casts, cleaning, naming
from listing_lake.operators import lineage as lin
from listing_lake.operators import quality, scd2
from listing_lake.operators.silver import silver_clean
from listing_lake.plans import pipeline
from listing_lake.session import stored, work_dir
from listing_lake.sources import landing
from listing_lake.sources import testdata as td
from listing_lake.sources.lake import Lake
from listing_lake.streaming import history, streams

Query = Callable[[SparkSession, str], DataFrame]

NOW = dt.datetime(2025, 1, 3, tzinfo=dt.timezone.utc)
CLEANED = dt.datetime(2025, 1, 2, tzinfo=dt.timezone.utc)
ARRIVED = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
PER_MATCH = scd2.PER_MATCH
SPLIT, STORE_SPLIT, LATE = "2001-01-01", "2001-10-01", "1998-01-01"

BOTH_IDS = ("table_name", *scd2.MERGE_KEYS)
KEYED = (*td.TIE_BREAK, "property_id")
DAY = "snapshot_date"


# ---------------------------------------------------------------- shared views


def _history(silver: DataFrame, keys=scd2.BULK_KEYS) -> DataFrame:
    return scd2.bulk_history(silver, td.LOADED_AT, keys, tie_break=td.TIE_BREAK)


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    return _history(td.silver(spark, sf))


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    silver = td.silver(spark, sf).filter(F.col("purpose") == rules.FOR_SALE)
    return _history(silver).drop("table_name")


def _offers(spark: SparkSession, sf: str) -> DataFrame:
    rows = scd2.only_traded(td.silver(spark, sf))
    return scd2.enrich(rows, td.LOADED_AT, F.col(DAY))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    keys = ("table_name", *scd2.BULK_KEYS)
    rows = scd2.only_traded(scd2.has_city(td.silver(spark, sf)))
    return scd2.one_per_day(rows, keys, DAY, td.TIE_BREAK)


def silver_clean_of(bronze: DataFrame) -> DataFrame:
    """The Silver projection over any Bronze frame with the feed's extra columns."""
    return silver_clean(bronze, td.RUN_ID, td.TRANSFORMED_AT, carry=(DAY, *td.TIE_BREAK))


def _silver_columns(*columns: str) -> Query:
    return lambda spark, sf: td.silver(spark, sf).select(*KEYED, *columns)


# ---------------------------------------------------------------- casts


def _numbers(spark: SparkSession, sf: str) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    forms = [
        part.cast("string"),
        F.concat(F.lit(" "), part, F.lit(" ")),
        F.concat(F.lit("+"), part),
        F.concat(part, F.lit("."), supp),
        F.concat(F.lit("-"), part, F.lit(".5")),
        F.concat(F.col("l_linenumber"), F.lit("e"), part % 12),
        F.concat(part, F.lit(","), supp),
        F.concat(part, F.lit("99999999"), F.col("l_orderkey")),
        F.concat(F.lit("."), supp),
        F.concat(part, F.lit("f")),
        F.concat(part, F.lit("_000")),
        F.concat(F.lit("0x"), F.hex(part)),
        F.concat(F.lit("0b"), F.bin(part)),
        F.concat(part, F.lit(".4999999999999999999999")),
        F.concat(part, F.lit("__"), supp, F.lit(".5")),
        F.concat(F.lit("-"), part, F.lit("_1.0_5e"), F.col("l_linenumber")),
    ]
    return _line_texts(spark, sf, forms)


def _date_texts(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")

    def shown(pattern: str) -> Column:
        return F.date_format(day, pattern)

    forms = [
        shown("yyyy-MM-dd"),
        shown("yyyy/MM/dd"),
        shown("yyyy-M-d"),
        F.concat(shown("yyyy-MM-dd"), F.lit(" 10:00:00")),
        shown("MMMM d, yyyy"),
        F.upper(shown("MMMM dd, yyyy")),
        shown("MM-dd-yyyy"),
        shown("M/d/yyyy"),
        shown("d-M-yyyy"),
        shown("yyyyMMdd"),
        F.concat(shown("yyyy-MM-dd"), F.lit("#")),
        shown("yyyy-MM"),
        F.concat(shown("yyyy-MM-dd"), F.lit(" junk")),
        F.concat(shown("yyyy-MM-dd"), F.lit(" 10")),
        F.concat(shown("M-d-"), F.lit("9"), shown("yy")),
        F.concat(shown("M/d/"), F.lit("1"), F.substring(shown("yyyy"), 4, 1)),
        F.concat(shown("yyyy-MM-dd"), F.lit(" 1:30:00.5")),
        F.concat(shown("yyyy-MM-dd"), F.lit(" 24:00:00")),
    ]
    return _line_texts(spark, sf, forms)


def _line_texts(spark: SparkSession, sf: str, forms: list[Column]) -> DataFrame:
    pick = F.col("l_orderkey") % len(forms)
    text = F.when(pick == 0, forms[0])
    for i, form in enumerate(forms[1:], start=1):
        text = text.when(pick == i, form)
    return td.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.alias("text")
    )


def _cast(source: Query, rule: Callable[[Column], Column]) -> Query:
    return lambda spark, sf: source(spark, sf).withColumn("value", rule(F.col("text")))


# ---------------------------------------------------------------- names


def _layer_file_names(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("landing_name")
    return (
        td.table(spark, sf, "pages")
        .withColumn("landing_name", F.concat(F.lit("page_"), "page_id", F.lit(".csv")))
        .select(
            "page_id",
            "landing_name",
            naming.bronze_name(name).alias("bronze_name"),
            naming.silver_name(naming.bronze_name(name)).alias("silver_name"),
            naming.unique_bronze_name(name, F.sha2("url", 256)).alias("unique_name"),
        )
    )


def _snapshot_date_from_name(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd")
    form = F.col("event_id") % 4
    name = (
        F.when(form == 0, F.concat(F.lit("export_"), "user_id", F.lit(".csv")))
        .when(form == 1, F.concat(F.lit("p_"), day, F.lit("_2030-01-01.csv")))
        .otherwise(F.concat(F.lit("property_data_"), day, F.lit("_"), "user_id", F.lit(".csv")))
    )
    return (
        td.table(spark, sf, "events")
        .select("event_id", name.alias("file_name"))
        .withColumns(
            {
                "snapshot_text": naming.snapshot_text(F.col("file_name")),
                "snapshot_date": naming.snapshot_date(F.col("file_name"), F.lit(NOW.date())),
            }
        )
    )


def _file_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return (
        td.bronze(spark, sf)
        .groupBy(F.col("_source_file").alias("file_name"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def _snapshot_dates(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("_source_file")
    return td.bronze(spark, sf).select(naming.snapshot_date(name).alias(DAY)).distinct()


# ---------------------------------------------------------------- history


def _split_silver(spark: SparkSession, sf: str, split: str) -> tuple[DataFrame, DataFrame]:
    """The Silver rows of the snapshots before a date, and those from it on."""
    silver, day = td.silver(spark, sf), F.lit(split).cast("date")
    return silver.filter(F.col(DAY) < day), silver.filter(F.col(DAY) >= day)


def _split_gold(spark: SparkSession, sf: str, split: str) -> tuple[DataFrame, DataFrame]:
    """History of the snapshots before a date, and the Silver rows from it on."""
    early, rest = _split_silver(spark, sf, split)
    return _history(early), rest


def _merged(gold: DataFrame, silver: DataFrame, day: dt.date | str, copies: str = PER_MATCH) -> DataFrame:
    incoming = scd2.incoming_versions(silver, F.lit(day), td.LOADED_AT)
    return scd2.merge(gold, incoming, F.lit(day), td.LOADED_AT, BOTH_IDS, copies=copies)


def _held(rows: DataFrame) -> DataFrame:
    """The rows as a written table, without what follows from other columns."""
    return scd2.restored(stored(scd2.lean(rows)), rows.columns)


def _scd2_incremental(copies: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        gold, rest = _split_gold(spark, sf, SPLIT)
        return _merged(_held(gold), _held(rest), SPLIT, copies)

    return query


def _scd2_first_load(spark: SparkSession, sf: str) -> DataFrame:
    empty = spark.createDataFrame([], schemas.GOLD).withColumn(
        "table_name", F.lit(None).cast("string")
    )
    return _merged(empty, stored(td.silver(spark, sf)), SPLIT)


def _scd2_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Merge date after date; only open versions travel from step to step.

    They travel as ids, values and lifetimes with the number of their row, and
    meet the wide rows once, after the last date.
    """
    gold, rest = _split_gold(spark, sf, SPLIT)
    number = F.monotonically_increasing_id()
    start = stored(gold.withColumn("_row", number))
    rest = stored(rest.withColumn("_row", -1 - number))
    narrow = (*BOTH_IDS, "price", *scd2.LIFETIME, "_row")
    still_open, steps = scd2.current_rows(start).select(*narrow), []
    for (day,) in rest.select(DAY).distinct().orderBy(DAY).collect():
        incoming = scd2.incoming_versions(
            rest.filter(F.col(DAY) == day), F.lit(day), td.LOADED_AT, "_row"
        )
        step = stored(
            scd2.merge_open(
                still_open, incoming.select(*narrow), F.lit(day), td.LOADED_AT, BOTH_IDS, copies=PER_MATCH
            )
        )
        steps.append(scd2.closed_rows(step))
        still_open = scd2.current_rows(step)
    moved = still_open
    for closed in steps:
        moved = moved.unionByName(closed)
    begun = scd2.incoming_versions(rest, F.col(DAY), td.LOADED_AT, "_row")
    wide = scd2.current_rows(start).unionByName(begun)
    return scd2.closed_rows(start).drop("_row").unionByName(scd2.described(moved, wide, "_row"))


def _scd2_replay_fold(spark: SparkSession, sf: str) -> DataFrame:
    """The same in one pass over all dates."""
    gold, rest = _split_gold(spark, sf, SPLIT)
    incoming = scd2.incoming_versions(_held(rest), F.col(DAY), td.LOADED_AT)
    return scd2.replay(_held(gold), incoming, td.LOADED_AT, BOTH_IDS, copies=PER_MATCH)


def _scd2_late_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    silver = _held(td.silver(spark, sf))
    is_late = F.col(DAY) == F.lit(LATE).cast("date")
    gold = _held(_history(silver.filter(~is_late)))
    # one month: read several times
    batch = _held(scd2.incoming_versions(silver.filter(is_late), F.lit(LATE), td.LOADED_AT))
    late, on_time = scd2.split_late(batch, gold, BOTH_IDS)
    affected, on_time = stored(late.select(*BOTH_IDS).distinct()), _held(on_time)
    rebuilt = _held(
        scd2.rebuild_late(gold, silver, affected, td.LOADED_AT, BOTH_IDS, tie_break=td.TIE_BREAK)
    )
    return scd2.merge(rebuilt, on_time, F.lit(LATE), td.LOADED_AT, BOTH_IDS, copies=PER_MATCH)


# ---------------------------------------------------------------- files


def _landing(spark: SparkSession, sf: str, broken: bool = False) -> Lake:
    """A lake whose landing folder holds the feed as CSV files."""
    lake = Lake(spark, work_dir(spark, "lake"))
    rows = td.facts(spark, sf)
    td.write_landing(rows, lake.landing, judge=_broken if broken else None, show=td.listed)
    return lake


def _broken(rows: DataFrame) -> DataFrame:
    """Line ends that make some records longer than the header."""
    number = F.col("l_linenumber")
    end = F.when(number == 3, ",surplus").when(number == 4, ',"a,b",c').otherwise("")
    return rows.withColumn("_line_end", end)


def _raw(lake: Lake) -> DataFrame:
    return lake.bronze().select(
        *schemas.RAW_COLUMNS, naming.snapshot_date(F.col("_source_file")).alias(DAY)
    )


def _bronze_batch_limit(spark: SparkSession, sf: str) -> DataFrame:
    """Runs with a limit of a third of the files; each takes the next ones in."""
    lake = Lake(spark, work_dir(spark, "lake"))
    files = td.write_landing(td.facts(spark, sf), lake.landing, show=td.listed)
    for _ in range(3):
        pipeline.bronze_ingest(lake, td.RUN_ID, ARRIVED, batch_limit=-(-files // 3))
    return _raw(lake)


def _one_a_day(rows: DataFrame) -> DataFrame:
    """Of facts, one row of a listing per day, and records that do not fit the header."""
    broken = _broken(rows)
    named = broken.withColumns({c: td.listing()[c] for c in ("purpose", "city", "property_id")})
    judged = (F.col("_line_end") == "") & F.coalesce(F.col("city") != "", F.lit(False))
    # the other rows, bad or without a city, have a key of their own and all stay
    alone = named.withColumn("_alone", F.when(~judged, F.monotonically_increasing_id()))
    keys = ("purpose", "city", "property_id", "_alone")
    return scd2.one_per_day(alone, keys, DAY, td.TIE_BREAK).select(*broken.columns)


def _land_days(lake: Lake, rows: DataFrame) -> None:
    """A landing file for each date of the facts, with one row of a listing."""
    td.write_landing(rows, lake.landing, split_days=False, judge=_one_a_day, show=td.listed)


def _pipeline_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """All batch steps on files of the early snapshots, then again with the later ones."""
    lake, rows = Lake(spark, work_dir(spark, "lake")), td.facts(spark, sf)
    early = F.col(DAY) < F.lit(STORE_SPLIT).cast("date")
    for part in (rows.filter(early), rows.filter(~early)):
        _land_days(lake, part)
        pipeline.bronze_ingest(lake, td.RUN_ID, ARRIVED)
        pipeline.silver_transform(lake, td.RUN_ID, CLEANED)
        pipeline.gold_publish(lake, td.RUN_ID, NOW)
    return lake.gold.read()


def _stream_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """All but one early snapshot is streamed in and published; then that file arrives."""
    lake, rows = Lake(spark, work_dir(spark, "lake")), td.facts(spark, sf)
    is_late = F.col(DAY) == F.lit(LATE).cast("date")
    for part in (rows.filter(~is_late), rows.filter(is_late)):
        _land_days(lake, part)
        streams.stream_bronze(lake, td.RUN_ID, ARRIVED)
        streams.stream_silver(lake, td.RUN_ID, CLEANED)
        if lake.gold.is_empty():
            pipeline.gold_publish(lake, td.RUN_ID, NOW)
        else:
            streams.stream_gold(lake, lake.silver_dir, NOW, late=pipeline.REBUILD)
    return lake.gold.read()


def _bronze_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    lake = _landing(spark, sf)
    pipeline.bronze_ingest(lake, td.RUN_ID, ARRIVED)
    return _raw(lake)


def _stream_bronze(spark: SparkSession, sf: str) -> DataFrame:
    lake = _landing(spark, sf)
    streams.stream_bronze(lake, td.RUN_ID, ARRIVED)
    return _raw(lake)


def _file_content_hash(spark: SparkSession, sf: str) -> DataFrame:
    """One file for each web page, with the page as its bytes."""
    folder = work_dir(spark, "pages")
    named = F.concat(F.lit("page_"), "page_id", F.lit(".csv")).alias("file_name")
    td.write_files(td.table(spark, sf, "pages").select(named, F.col("html").alias("content")), folder)
    return landing.fingerprints(landing.list_files(spark, folder)).select(
        "file_name", "length", "file_hash"
    )


def _quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    lake = _landing(spark, sf, broken=True)
    pipeline.bronze_ingest(lake, td.RUN_ID, ARRIVED)
    kept = lake.bronze().select("_source_file", F.lit(True).alias("clean"))
    rejected = lake.quarantine().select("_source_file", F.lit(False).alias("clean"))
    return (
        kept.unionByName(rejected)
        .groupBy(naming.snapshot_date(F.col("_source_file")).alias(DAY))
        .agg(
            F.count_if("clean").alias("clean_rows"),
            F.count_if(~F.col("clean")).alias("quarantined_rows"),
        )
    )


# ---------------------------------------------------------------- Gold store


def _published(lake: Lake, silver: DataFrame, tie_break=td.TIE_BREAK) -> int:
    """The history of the rows as a version of the store."""
    gold = scd2.bulk_history_by_city(silver, td.LOADED_AT, tie_break=tie_break)
    return lake.gold.publish(gold, pipeline.BULK, NOW, by_city=True)


def _stored_gold(spark: SparkSession, sf: str) -> Lake:
    """Bulk history up to a date, then one merge per later snapshot."""
    lake = Lake(spark, work_dir(spark, "lake"))
    early, rest = _split_silver(spark, sf, STORE_SPLIT)
    _published(lake, early)
    rest = stored(rest)
    for (day,) in rest.select(DAY).distinct().orderBy(DAY).collect():
        pipeline.merge_batch(lake, rest.filter(F.col(DAY) == day), day, NOW, copies=PER_MATCH)
    return lake


def _gold_publish_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _stored_gold(spark, sf).gold.log().select(
        "version", "table_name", "mode", "open_rows", "closed_rows"
    )


def _gold_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return _stored_gold(spark, sf).gold.snapshots().drop("committed_at")


def _counted(lake: Lake, **labels: str) -> DataFrame:
    # counted from the rows themselves, not from the log
    total = lake.gold.read().agg(F.count(F.lit(1)).alias("gold_rows"))
    return total.select(*[F.lit(v).alias(k) for k, v in labels.items()], "gold_rows")


def _gold_rollback(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake(spark, work_dir(spark, "lake"))
    early, rest = _split_silver(spark, sf, SPLIT)
    bulk = _published(lake, early)
    states = _counted(lake, state="1 bulk")
    pipeline.merge_batch(lake, stored(rest), dt.date.fromisoformat(SPLIT), NOW, copies=PER_MATCH)
    states = states.unionByName(_counted(lake, state="2 merged"))
    lake.gold.restore(bulk, NOW)
    states = states.unionByName(_counted(lake, state="3 restored"))
    pipeline.rollback_layer(lake, rules.GOLD, NOW)
    return states.unionByName(_counted(lake, state="4 reset"))


def _gold_mode_selection(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake(spark, work_dir(spark, "lake"))
    lake.gold.create_if_missing(NOW)
    before = _counted(lake, moment="before", mode=pipeline.select_mode(lake))
    _published(lake, td.silver(spark, sf))
    return before.unionByName(_counted(lake, moment="after", mode=pipeline.select_mode(lake)))


def _gold_empty_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    """Create empty tables twice, then merge the whole feed into them."""
    lake = Lake(spark, work_dir(spark, "lake"))
    lake.gold.create_if_missing(NOW)
    lake.gold.create_if_missing(NOW)
    whole = td.silver(spark, sf)  # read once: nothing is there to compare it with
    pipeline.merge_batch(lake, whole, dt.date.fromisoformat(SPLIT), NOW, copies=PER_MATCH)
    return lake.gold.read()


def _lake_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Reads Silver and Gold of a lake by SQL."""
    lake, silver = Lake(spark, work_dir(spark, "lake")), stored(td.silver(spark, sf))
    lake.write_silver(
        silver.drop(*td.TIE_BREAK).withColumn("file_hash", F.sha2(F.col(DAY).cast("string"), 256))
    )
    _published(lake, silver)
    lake.register_views("lake")
    return spark.sql("""
        SELECT g.city, g.open_versions, g.closed_versions, s.silver_rows
        FROM (SELECT city, count_if(is_current) AS open_versions, count_if(NOT is_current) AS closed_versions
              FROM lake_gold_rentals GROUP BY city) AS g
        JOIN (SELECT city, count(*) AS silver_rows FROM lake_silver GROUP BY city) AS s ON g.city = s.city""")


def _event_versions(spark: SparkSession, sf: str) -> DataFrame:
    """History of each user's value, one row a day."""
    events = td.table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return scd2.timeline(events, ["user_id"], "day", "value", ["event_id"])


def _gold_as_of_join(spark: SparkSession, sf: str) -> DataFrame:
    """For each event, its user's value as it was some days before; the ids are skewed."""
    user = F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id"))
    asked = td.table(spark, sf, "events").select(
        "event_id",
        user.cast("long").alias("user_id"),
        F.date_sub(F.col("ts").cast("date"), (F.col("event_id") % 5).cast("int")).alias("asked"),
    )
    return scd2.as_of_join(asked, _event_versions(spark, sf), ["user_id"], "asked", ["value"])


# ---------------------------------------------------------------- streams


def _silver_files(spark: SparkSession, silver: DataFrame) -> str:
    folder = work_dir(spark, "silver")
    silver.drop(*td.TIE_BREAK).write.parquet(folder)
    return folder


def _stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake(spark, work_dir(spark, "lake"))
    rows = td.bronze(spark, sf).select(*schemas.BRONZE.names)
    # a rejected record of each file stays behind
    refused = rows.select("_source_file").distinct().withColumn("quarantined", F.lit(True))
    lake.write_bronze(
        rows.withColumn("quarantined", F.lit(False))
        .unionByName(refused, allowMissingColumns=True)
        .withColumn("file_hash", F.sha2("_source_file", 256))
    )
    streams.stream_silver(lake, td.RUN_ID, CLEANED)
    return lake.silver().select(*schemas.SILVER.names)


def _stream_gold(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake(spark, work_dir(spark, "lake"))
    gold, rest = _split_gold(spark, sf, STORE_SPLIT)
    lake.gold.publish(gold, pipeline.BULK, NOW)
    streams.stream_gold(lake, _silver_files(spark, rest), NOW, copies=PER_MATCH)
    return lake.gold.read()


def _stream_gold_state(spark: SparkSession, sf: str) -> DataFrame:
    """Bulk history, then the later snapshots by a stream with keyed state, in two runs."""
    gold, rest = _split_gold(spark, sf, STORE_SPLIT)
    gold, rest = stored(gold), stored(rest.drop(*td.TIE_BREAK))
    place, last = work_dir(spark, "versions"), rest.agg(F.max(DAY)).first()[0]
    for part in (rest.filter(F.col(DAY) < last), rest.filter(F.col(DAY) == last)):
        part.write.mode("append").parquet(f"{place}/silver")
        history.stream_versions(spark, f"{place}/silver", f"{place}/events", f"{place}/position", gold)
    events = spark.read.schema(history.EVENTS).parquet(f"{place}/events")
    silver = rest.withColumn("file_hash", F.lit(None).cast("string"))
    return history.history(gold, silver, events, td.LOADED_AT, PER_MATCH)


def _stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Everything but one early snapshot is loaded; then that snapshot arrives.

    Silver is reduced to one row per day first, with the feed's own tie-break,
    because files do not carry the tie-break columns a rebuild would need.
    """
    lake = Lake(spark, work_dir(spark, "lake"))
    silver = td.silver(spark, sf)
    is_late = F.col(DAY) == F.lit(LATE).cast("date")
    daily = scd2.one_per_day(
        scd2.lean(scd2.only_traded(scd2.has_city(silver))), ("table_name", *scd2.BULK_KEYS), DAY, td.TIE_BREAK
    )
    lake.write_silver(
        scd2.restored(daily, silver.columns)
        .drop(*td.TIE_BREAK)
        .withColumn("file_hash", F.sha2(F.col(DAY).cast("string"), 256))
    )
    # one row a day is left, so no tie is to be broken
    _published(lake, lake.silver().filter(~is_late), (DAY,))
    streams.stream_gold(
        lake, _silver_files(spark, silver.filter(is_late)), NOW, late=pipeline.REBUILD, copies=PER_MATCH
    )
    return lake.gold.read()


# ---------------------------------------------------------------- lineage


def _lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Lineage of the web pages: all in Bronze, most in Silver, half in Gold."""
    rest = F.col("page_id") % 10
    failed = rest == 9
    layer = F.explode(
        F.when(rest < 5, F.array(F.lit("BRONZE"), F.lit("SILVER"), F.lit("GOLD")))
        .when(rest < 8, F.array(F.lit("BRONZE"), F.lit("SILVER")))
        .otherwise(F.array(F.lit("BRONZE")))
    )
    suffix = F.when(F.col("layer") == "SILVER", "_clean.parquet").otherwise(".parquet")
    at = F.timestamp_seconds(F.lit(1735689600) + F.col("page_id"))
    columns = {
        "file_hash": F.sha2("url", 256),
        "layer": F.col("layer"),
        "file_name": F.concat(F.lit("page_"), "page_id", suffix),
        "run_id": F.concat(F.lit("run-"), F.col("page_id") % 4),
        "status": F.when(failed, rules.FAILED).otherwise(rules.SUCCESS),
        "retry_count": F.when(failed, F.col("page_id") % 7).otherwise(0),
        "row_count": F.when(~failed, F.col("page_id")),
        "file_size_bytes": F.when(~failed, F.octet_length("html")),
        "error_message": F.when(failed, F.concat(F.lit("cannot read "), "url")),
        "created_at": at,
        "updated_at": at,
    }
    return (
        td.table(spark, sf, "pages")
        .select("*", layer.alias("layer"))
        .select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.LINEAGE])
    )


def _on_lineage(report: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return report(_lineage(spark, sf)).drop("updated_at")

    return query


def _lineage_unprocessed(spark: SparkSession, sf: str) -> DataFrame:
    files = td.table(spark, sf, "pages").select(F.sha2("url", 256).alias("file_hash"), "page_id")
    return lin.unprocessed(files, _lineage(spark, sf), rules.SILVER)


def _lineage_listing(lineage: DataFrame) -> DataFrame:
    text = F.to_utc_timestamp("created_at", F.current_timezone())
    return lin.listing(lineage).withColumn(
        "created_at", F.date_format(text, "yyyy-MM-dd HH:mm:ss")
    )


def _lineage_release(spark: SparkSession, sf: str) -> DataFrame:
    aside = lin.set_aside(_lineage(spark, sf), 3)
    held = aside.filter(F.col("status") == rules.QUARANTINED)
    freed = held.agg(F.min("file_hash")).first()[0] or ""
    released = lin.release(aside, freed, F.lit(NOW).cast("timestamp"))
    return released.select("file_hash", "layer", "file_name", "status", "retry_count")


def _lineage_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """First half of the events makes the lineage, second half updates it."""
    events = td.table(spark, sf, "events")
    user, event = F.col("user_id"), F.col("event_id")
    broken = F.col("event_type") == "error"
    columns = {
        "file_hash": F.sha2(F.concat(F.lit("file-"), user), 256),
        "layer": F.when(user % 3 == 0, rules.BRONZE).when(user % 3 == 1, rules.SILVER).otherwise(rules.GOLD),
        "file_name": F.concat(F.lit("out_"), event, F.lit(".parquet")),
        "run_id": F.concat(F.lit("run-"), event % 5),
        "status": F.when(broken, rules.FAILED).otherwise(rules.SUCCESS),
        "row_count": F.when(~broken, event),
        "file_size_bytes": F.when(~broken, event * 10),
        "error_message": F.when(broken, F.concat(F.lit("event "), event)),
        "seq": event,
    }
    records = events.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.OUTCOME]
    )
    half = events.agg((F.max("event_id") / 2).alias("half")).first()["half"]
    empty = spark.createDataFrame([], schemas.LINEAGE)
    at = F.lit(NOW).cast("timestamp")
    existing = lin.upsert(empty, records.filter(F.col("seq") <= half), at)
    return lin.upsert(existing, records.filter(F.col("seq") > half), at).drop(
        "created_at", "updated_at"
    )


# ---------------------------------------------------------------- registry


def _of(view: Query, report: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf: report(view(spark, sf), *args)


def queries() -> dict[str, Query]:
    daily_columns = (*KEYED, "table_name", "city", DAY, "price")
    enriched = (
        *KEYED, "table_name", "property_category", "is_anomaly", "is_current", "valid_from",
        "valid_to", "_gold_loaded_at",
    )
    return {
        "scd2_bulk_timeline": _gold,
        "scd2_bulk_timeline_by_id": lambda spark, sf: _history(
            td.silver(spark, sf), scd2.MERGE_KEYS
        ),
        "scd2_incremental": _scd2_incremental(PER_MATCH),
        "scd2_incremental_once": _scd2_incremental(scd2.ONCE),
        "scd2_incremental_first_load": _scd2_first_load,
        "scd2_replay": _scd2_replay,
        "scd2_replay_fold": _scd2_replay_fold,
        "scd2_late_rebuild": _scd2_late_rebuild,
        # casts and cleaning rules
        "cast_lenient_long": _cast(_numbers, casts.lenient_long),
        "cast_lenient_int": _cast(_numbers, casts.lenient_int),
        "cast_lenient_double": _cast(_numbers, casts.lenient_double),
        # as text: some of the days lie before the years that all clients can hold
        "parse_dates": _cast(_date_texts, lambda text: casts.lenient_date(text).cast("string")),
        "text_defaults": _silver_columns("agency", "agent"),
        "area_to_marla": _silver_columns("area_marla"),
        "price_cap": _silver_columns("price"),
        "price_per_area": _silver_columns("price_per_marla"),
        "geo_fence": _silver_columns("latitude", "longitude"),
        "url_hash": lambda spark, sf: td.table(spark, sf, "pages").select(
            "page_id", "url", cleaning.url_digest(F.col("url")).alias("url_hash")
        ),
        "silver_clean": lambda spark, sf: td.silver(spark, sf).select(*schemas.SILVER.names),
        # files and names
        "bronze_audit_columns": lambda spark, sf: td.bronze(spark, sf).select(
            "property_id", "page_url", *td.TIE_BREAK, "_ingested_at", "_run_id", "_source_file"
        ),
        "bronze_csv_roundtrip": _bronze_csv_roundtrip,
        "bronze_batch_limit": _bronze_batch_limit,
        "pipeline_end_to_end": _pipeline_end_to_end,
        "stream_end_to_end": _stream_end_to_end,
        "file_content_hash": _file_content_hash,
        "quarantine_split": _quarantine_split,
        "file_row_counts": _file_row_counts,
        "layer_file_names": _layer_file_names,
        "snapshot_date_from_name": _snapshot_date_from_name,
        "snapshot_dates": _snapshot_dates,
        # Gold steps
        "purpose_split": lambda spark, sf: scd2.only_traded(td.silver(spark, sf)).select(
            *KEYED, "purpose", "table_name"
        ),
        "gold_enrich": lambda spark, sf: _offers(spark, sf).select(*enriched),
        "dedup_per_day": lambda spark, sf: _daily(spark, sf).select(*daily_columns),
        "price_change_points": lambda spark, sf: scd2.change_points(
            _daily(spark, sf), ("table_name", *scd2.BULK_KEYS), DAY, "price"
        ).select(*daily_columns),
        "distinct_cities": lambda spark, sf: scd2.has_city(
            td.silver(spark, sf).filter(F.col("purpose") == rules.FOR_SALE)
        ).select("city").distinct(),
        # reads, checks and reports
        "gold_current": _of(_gold, scd2.current_rows),
        "gold_city_lookup": lambda spark, sf: _gold(spark, sf).filter(
            (F.col("table_name") == "gold_sales") & (F.col("city") == "NATION_7")
        ),
        "gold_as_of_date": _of(_gold, lambda gold: scd2.as_of(gold, F.lit("1998-06-15"))),
        "gold_as_of_join": _gold_as_of_join,
        "gold_expectations": _of(_gold, quality.expectations),
        "gold_table_counts": _of(_gold, quality.table_counts),
        "gold_anomaly_counts": _of(_gold, quality.anomaly_counts),
        "gold_null_profile": _of(_sales, quality.null_profile),
        "gold_plot_count": _of(_sales, quality.plot_count),
        "silver_null_profile": _of(td.silver, quality.null_profile),
        "silver_schema_check": _of(td.silver, quality.schema_check),
        "date_type_check": _of(_sales, quality.date_type_check),
        "price_by_city_top5": _of(td.silver, quality.price_by_city),
        "city_distribution": _of(_sales, quality.city_distribution),
        "scd2_duplicate_active": _of(_sales, quality.duplicate_active),
        "scd2_changed_properties": _of(_sales, quality.changed_properties),
        "scd2_top_changed": _of(_sales, quality.top_changed),
        "scd2_top_changed_history": _of(_sales, quality.top_changed_history),
        "scd2_sample_timeline": _of(_sales, quality.sample_timeline),
        "scd2_history_export": _of(_sales, quality.history_export),
        "scd2_chain_check": _of(_sales, quality.chain_breaks, ("property_id",)),
        # Gold store
        "gold_publish_versions": _gold_publish_versions,
        "gold_snapshots": _gold_snapshots,
        "gold_rollback": _gold_rollback,
        "gold_mode_selection": _gold_mode_selection,
        "gold_empty_bootstrap": _gold_empty_bootstrap,
        "lake_sql": _lake_sql,
        # streams
        "stream_bronze": _stream_bronze,
        "stream_silver": _stream_silver,
        "stream_gold": _stream_gold,
        "stream_gold_state": _stream_gold_state,
        "stream_late": _stream_late,
        # lineage
        "lineage_unprocessed": _lineage_unprocessed,
        "lineage_eligible": _on_lineage(lambda l: lin.eligible(l, rules.GOLD, rules.SILVER)),
        "lineage_batch_limit": _on_lineage(
            lambda l: lin.first_files(lin.eligible(l, rules.GOLD, rules.SILVER), 20, "file_name")
        ),
        "lineage_upsert": _lineage_upsert,
        "lineage_release": _lineage_release,
        "lineage_delete_layer": _on_lineage(
            lambda l: lin.delete_layer(l, rules.SILVER).drop("created_at")
        ),
        "lineage_status_counts": _on_lineage(lin.status_counts),
        "lineage_volume": _on_lineage(lin.volume),
        "lineage_listing": _on_lineage(_lineage_listing),
        "lineage_failed": _on_lineage(lin.failed),
        "lineage_by_run": _on_lineage(lambda l: lin.of_run(l, "run-2").drop("created_at")),
        "lineage_retry_watch": _on_lineage(lin.retry_watch),
    }
